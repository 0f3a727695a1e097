"""Structured Streaming: parse state payloads, land them, keep silver and latest state up to date."""
