"""Dense cells are never the broadcast side of a join, whatever size the planner guesses for them."""
import random

import pytest

from coact.operators import matrix as mx
from coact.operators import predict as pr
from coact.session import staged


def _broadcast_parts(plan: str) -> list[str]:
    """The subtree text of every broadcast exchange of a simple plan string."""
    lines, out = plan.split("\n"), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((m for m in range(k + 1, len(lines)) if depth(lines[m]) <= depth(line)), len(lines))
            out.append("\n".join(lines[k:end]))
    return out


@pytest.mark.parametrize("kind", ["user", "item"])
@pytest.mark.parametrize("predict", [pr.predict_bias_corrected, lambda r, s, kind: pr.predict_topk(r, s, kind, 5)])
def test_cells_are_not_broadcast(spark, kind, predict):
    rng = random.Random(1)
    cells = {(rng.randint(0, 60), rng.randint(0, 20)) for _ in range(300)}
    r = staged(mx.from_rows(spark, [(i, j, rng.randint(1, 5)) for i, j in sorted(cells)]), "ratings")
    pred = predict(r, pr.similarity_for(r, kind), kind)
    shape = mx.shape(r).first()
    rows = r.select("i" if kind == "user" else "j").distinct().count()
    assert len(pred.collect()) == rows * (shape.n_cols if kind == "user" else shape.n_rows)
    plan = pred._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Generate" in plan
    assert not any("Generate" in part for part in _broadcast_parts(plan))
