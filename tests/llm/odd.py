from __future__ import annotations

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
for path in (HERE, os.path.dirname(os.path.dirname(HERE))):
    if path not in sys.path:
        sys.path.insert(0, path)

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, anchor long, row long, start long"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, extra
    columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 97} tale{i % 31}" for i in range(6000))
    base = "the quick brown fox jumps over the lazy dog while many people watch it go by the river in spring"
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, base, "en", None, len(base)), (4, base, None, "b", None),
        (5, base + " again and again", "de", "b", 3), (6, long, "fr", "c", len(long)), (6, long, "fr", "c", len(long)),
        (7, "it's 'quoted' été \U0001F600 <|endoftext|> end", "es", "c", 9),
        (None, "a text without an id", "en", "d", 1), (8, "MIT License, CC-BY 4.0 ©", "en", "d", 2),
        (9, "write to a.b@mail.example.com or 4111 1111 1111 1111", "en", "e", 5), (10, "   \n\t ", None, None, None),
    ]
    return spark.createDataFrame([(*r, 5, 6, 7) for r in rows], ODD_SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
