"""Table schemas, readers and writers, and bindings of the given tables."""
