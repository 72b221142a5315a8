"""coact.sources."""
