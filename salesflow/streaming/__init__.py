"""Sinks and the stateful streaming operators."""
