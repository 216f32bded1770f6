"""The same analyses on sessions that arrive over time."""
