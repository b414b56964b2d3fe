"""Stateful stream operators, sinks, and the job runner."""
