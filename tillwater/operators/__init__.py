"""Table operators: keys, upsert, shape, aggregation and sampling."""
