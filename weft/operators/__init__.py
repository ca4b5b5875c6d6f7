"""Operators on DataFrames; vocabularies are parameters, and plans stay lazy but where a docstring says that tables are written."""
