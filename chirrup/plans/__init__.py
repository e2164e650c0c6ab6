"""The pipeline over all tables."""
