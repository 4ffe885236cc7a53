"""The same insights as Structured Streaming queries."""
