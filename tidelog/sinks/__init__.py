"""Publishing data frames as messages."""
