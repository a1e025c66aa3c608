"""Structured Streaming jobs. Sources are folders; sinks are replay-safe."""
