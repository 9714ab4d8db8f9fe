"""Name rules and column expressions."""
