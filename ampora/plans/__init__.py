"""Plans: fixture bindings on the driver tables, the end-to-end batch flow and
the registered queries with their DuckDB oracles."""
