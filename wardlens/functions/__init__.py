"""Column-level building blocks: calendar windows, name matching, numeric rules."""
