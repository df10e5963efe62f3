"""DataFrame to DataFrame operators; usable in batch and in a stream."""
