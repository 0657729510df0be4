"""Long-running queries."""
