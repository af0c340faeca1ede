"""Structured Streaming forms: replay, stateful processors, runners, runtime."""
