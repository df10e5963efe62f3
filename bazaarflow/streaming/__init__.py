"""Streaming queries and the sinks they feed."""
