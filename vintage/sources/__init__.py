"""Reading landed records, and the tables that loads, logs and flags are written to."""
