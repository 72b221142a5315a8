"""coact.plans."""
