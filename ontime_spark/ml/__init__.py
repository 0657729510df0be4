"""The delay model."""
