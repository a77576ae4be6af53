"""Column helpers: names, types, time zones, holidays."""
