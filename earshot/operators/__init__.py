"""DataFrame operators: joins, indexing, sampling, models, metrics, exact and approximate top-k."""
