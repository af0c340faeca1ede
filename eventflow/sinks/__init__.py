"""Sinks (K1-K8)."""
