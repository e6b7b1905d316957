"""The batch chain (``pipeline``) and the registered queries (``registry``) with
their DuckDB SQL (``oracle``)."""
