"""DataFrame operators: prep, graph building, counts and graph algorithms."""
