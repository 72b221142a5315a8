"""coact.functions."""
