"""DataFrame operators: prepare, quality, aggregate, order, benchmark, sample."""
