"""Structured Streaming: tails and routes."""
