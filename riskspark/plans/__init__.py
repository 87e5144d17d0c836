"""Named end-to-end queries (``registry.QUERIES``) and their DuckDB oracles (``oracle``)."""
