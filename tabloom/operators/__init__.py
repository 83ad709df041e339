"""DataFrame operators: joins, aggregates, ordering, table changes, rules, profiles."""
