"""Table operators by layer: bronze, silver, gold (+ ranking), features,
segmentation, serving."""
