"""Training-data operators and their registered queries (``queries.py``).

Nothing outside this subpackage imports it; the repository works without it.
"""
