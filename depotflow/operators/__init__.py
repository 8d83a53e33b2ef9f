"""DataFrame operators: lazy functions from frames to frames."""
