"""Column helpers: durations, event time, tokens, hashing, severity labels."""
