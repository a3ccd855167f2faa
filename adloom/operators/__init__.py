"""adloom operators."""
