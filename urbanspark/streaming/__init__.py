"""Count windows, running state and online clustering on Structured Streaming."""
