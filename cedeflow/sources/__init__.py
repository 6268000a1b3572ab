"""Where the reports read from."""
