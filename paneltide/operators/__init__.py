"""Relational and panel operators: DataFrame in, DataFrame out."""
