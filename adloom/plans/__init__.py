"""adloom plans."""
