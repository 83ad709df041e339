"""Column-level helpers: predicates, scalar functions, XML, SQL routines."""
