"""tillroll — retail invoice-line analytics as lazy Spark DataFrame operators.

Layers (each a plain ``DataFrame -> DataFrame`` function, nothing runs until the
caller takes an action):

* ``tillroll.sources``    schema, readers/writers, driver-table adapter
* ``tillroll.functions``  column expressions (parsing, flags, calendar, guards)
* ``tillroll.operators``  bronze / silver / gold / features / segmentation / serving
* ``tillroll.plans``      the batch chain over stored tables and the query registry
"""

from tillroll.session import ensure_checkpoint_dir, local_session, pin_session

__all__ = ["ensure_checkpoint_dir", "local_session", "pin_session"]
