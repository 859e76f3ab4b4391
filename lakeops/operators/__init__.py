"""Relational operators: DataFrame in, DataFrame out, no job triggered unless stated."""
