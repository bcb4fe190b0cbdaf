"""Structured Streaming jobs: the ad-click stream."""
