"""DataFrame operators: parse, normalise, detect, correlate, alarm, profile."""
