"""Table operators: quality checks, upserts, history, surrogate keys, audit columns."""
