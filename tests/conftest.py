import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from coact.session import get_session
    s = get_session("local[4]", 8, app_name="coact-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="coact-test-ckpt-"))
    yield s
    s.stop()


def to_dense(df, shape=None):
    """Collect a small COO DataFrame into a numpy array (test helper only)."""
    import numpy as np
    rows = df.select("i", "j", "value").collect()
    if shape is None:
        shape = (max([r.i for r in rows] + [-1]) + 1, max([r.j for r in rows] + [-1]) + 1)
    out = np.zeros(shape)
    for r in rows:
        out[r.i, r.j] += r.value
    return out


def from_dense(spark, arr):
    """Sparse COO DataFrame from a numpy array, zeros dropped (test helper only)."""
    from coact.operators import matrix as mx
    import numpy as np
    arr = np.asarray(arr, dtype=float)
    ii, jj = np.nonzero(arr)
    return mx.from_rows(spark, [(int(a), int(b), float(arr[a, b])) for a, b in zip(ii, jj)])
