"""DataFrame → DataFrame building blocks."""
