"""coact.operators."""
