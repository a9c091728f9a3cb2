"""DataFrame -> DataFrame operators: reshape, keys, dimensions, star joins,
quality checks and marts."""
