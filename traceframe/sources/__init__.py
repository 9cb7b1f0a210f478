"""Where raw records and reference texts come from."""
