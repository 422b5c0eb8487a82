"""operators of the mention engine."""
