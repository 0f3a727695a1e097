"""The registered queries: library operators applied to the test tables, each with its reference SQL."""
