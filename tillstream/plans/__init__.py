"""Registered queries (``queries.QUERIES``) and their DuckDB oracles
(``oracle.ORACLE``)."""
