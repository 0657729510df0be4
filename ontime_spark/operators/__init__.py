"""Transformations of whole frames, for batch and streaming alike."""
