"""DataFrame operators: cleaning, joining, pre-aggregating, ranking."""
