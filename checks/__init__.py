"""The checked queries, their SQL counterparts, and the mapping of the given tables."""
