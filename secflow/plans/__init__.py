"""Plan-level helpers, test-data frames and the query registry."""
