"""adloom: a PySpark-native engine for listing feeds, pages and review data."""
