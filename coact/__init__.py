"""coact — co-activity analytics on Spark.

From a log of ``(author, score, subreddit)`` events (neutral names: user,
score, item) the library builds activity tables, picks the most active items
and the users inside an activity band, forms a sparse item x user matrix held
as an ordinary DataFrame ``(i, j, value)`` and offers sparse-matrix algebra,
log-entropy weighting, cosine similarity, truncated SVD, rating prediction,
top-k related items, user recommendations and a 2-D map of items.

Everything is declared with the DataFrame / SQL / MLlib APIs so Catalyst plans
the work and executors do it; the driver only ever holds bounded things
(parameters, per-partition counts, the items x k factor matrix).
"""

from coact.session import get_session, scratch_dir, ensure_checkpoint_dir

__all__ = ["get_session", "scratch_dir", "ensure_checkpoint_dir"]
