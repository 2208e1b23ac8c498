"""Compositions: Bronze/Silver/Gold (``layers``), the end-to-end run (``run``),
record lineage (``lineage``), and the registered queries with their DuckDB
oracles (``queries``, ``files``, ``oracle``)."""
