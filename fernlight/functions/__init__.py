"""Column builders: text, numbers, features, routing."""
