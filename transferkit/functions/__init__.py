"""Column expressions: values to text and back, SQL literals, identifiers."""
