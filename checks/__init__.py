"""Driver-table views, the query registry and its reference SQL."""
