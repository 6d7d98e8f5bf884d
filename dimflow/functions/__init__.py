"""Column expressions: every function takes and returns Spark columns; none runs Python on rows."""
