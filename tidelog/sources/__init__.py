"""Message logs on storage."""
