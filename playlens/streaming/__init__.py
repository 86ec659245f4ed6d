"""Structured Streaming jobs on the play-event topic."""
