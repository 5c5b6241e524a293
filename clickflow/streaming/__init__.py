"""Structured Streaming: line sources, the ad stream job and its state tables."""
