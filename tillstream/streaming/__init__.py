"""Structured Streaming forms: stateful processors, pipelines, replay helper."""
