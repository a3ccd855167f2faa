"""adloom streaming."""
