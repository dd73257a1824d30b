"""Structured Streaming: scoring arriving line items with a fitted model."""
