"""DataFrame operators: change filter, reference lookup, merge."""
