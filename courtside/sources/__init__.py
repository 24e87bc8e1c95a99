"""Reading, writing and copying tables."""
