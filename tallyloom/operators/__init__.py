"""Table-level operators: lookups, ordering keys, transforms, star schema, checks, merge, audit."""
