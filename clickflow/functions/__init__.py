"""Column-expression helpers: time formats, text, key=value records, ratios, aggregates, SQL functions."""
