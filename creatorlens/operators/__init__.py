"""Reusable relational operators: joins, ranking, quality checks, reshaping."""
