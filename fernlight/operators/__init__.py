"""DataFrame operators: signals, dedupe, sampling, vectors, search."""
