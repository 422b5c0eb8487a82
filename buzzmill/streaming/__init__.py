"""streaming of the mention engine."""
