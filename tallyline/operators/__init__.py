"""DataFrame operators: joins, cleaning, ranking, trends, layout."""
