"""Column helpers: calendar months and rate factors."""
