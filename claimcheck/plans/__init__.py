"""Stage drivers, the demo projection, the queries and their oracles."""
