"""The incremental jobs, each on Structured Streaming with a checkpoint."""
