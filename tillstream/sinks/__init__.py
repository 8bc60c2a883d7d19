"""Sinks: JSON topics, routed outputs, idempotent appends, versioned upserts."""
