"""adloom sources."""
