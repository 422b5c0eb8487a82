"""functions of the mention engine."""
