"""DataFrame operators: joins, groupings, rankings, text and key checks."""
