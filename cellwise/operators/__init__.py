"""DataFrame → DataFrame operators on cells and typed rows."""
