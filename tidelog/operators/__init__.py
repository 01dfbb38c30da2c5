"""Table operators over message logs."""
