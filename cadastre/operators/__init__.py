"""Table operators: keys, lookups, routes, layers and ordered lists."""
