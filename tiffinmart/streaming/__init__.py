"""Structured Streaming drivers over the batch operators."""
