"""Detection, windows, spikes and replay as Structured Streaming queries."""
