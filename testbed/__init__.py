"""Stand-in feeds over the given test tables, the registered queries and their oracles."""
