"""Structured Streaming: incremental corpus merge (append / replace by key)."""
