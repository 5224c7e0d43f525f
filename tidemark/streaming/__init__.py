"""Streaming forms of the merge and of resampling."""
