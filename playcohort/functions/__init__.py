"""Column expressions; all of them run inside generated code, none is a Python UDF."""
