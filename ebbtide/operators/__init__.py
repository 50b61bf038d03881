"""DataFrame-level operators: joins, aggregations, distributed ranks."""
