"""Streaming forms of the recency operators; an extension, for the batch jobs only knew periodic increments."""
