"""Structured Streaming: live captures, replay, changing rules, sinks."""
