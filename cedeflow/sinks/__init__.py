"""Where the reports are written."""
