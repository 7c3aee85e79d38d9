"""Relational and statistical operators: DataFrame in, lazy DataFrame out."""
