"""Live feed: decoding, raw event tables and running totals with Structured Streaming."""
