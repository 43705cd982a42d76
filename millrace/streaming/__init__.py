"""Streaming sources, monitors, sinks and the runner."""
