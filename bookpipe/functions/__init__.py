"""Column functions: every parser is a Catalyst expression, none is a UDF."""
