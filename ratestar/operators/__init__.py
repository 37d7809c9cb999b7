"""DataFrame operators: metric views, ranking, trends, checks, changes, masking."""
