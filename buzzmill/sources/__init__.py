"""sources of the mention engine."""
