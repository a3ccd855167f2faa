"""adloom functions."""
