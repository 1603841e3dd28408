"""Embedding links against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import embedding_dedup as e


def brute(rows):
    x = {}
    for r, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            x[r] = np.array(v, dtype=np.float64) / np.linalg.norm(v)
    links = {r: [s for s in x if s != r and len(x[s]) == len(x[r]) and x[r] @ x[s] >= e.COSINE] for r in x}
    out = []
    for r, (k, _) in enumerate(rows):
        seen, queue = {r}, [r]
        while queue:
            for s in links.get(queue.pop(), []):
                if s not in seen:
                    seen.add(s)
                    queue.append(s)
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        out.append((k, len(links.get(r, [])), min(ids) if ids else None))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (3, [1.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]),
        (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, -1.0]), (11, [-1.0, 0.0]), (12, [1e-30, 0.0]), (13, [3e38, 0.0]), (14, [-0.0, 1.0]), (15, [0.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, node string")
    assert found(e.near_vectors(df)) == brute(rows)
    assert e.near_vectors(df.limit(0)).count() == 0
    assert found(e.near_vectors(df.where(F.col("vec_id").isin(4, 6)))) == [(4, 0, 4), (6, 0, 6)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_groups_larger_than_window_and_block(spark, kind):
    rnd = np.random.default_rng(3)
    rows = []
    for size, noise in ((90, 0.02), (40, 0.05), (2, 0.03), (2, 0.01), (2, 0.05), (1, 0)):
        centre = rnd.standard_normal(64)
        rows += [(centre + noise * rnd.standard_normal(64)) for _ in range(size)]
    rows += list(rnd.standard_normal((60, 64)))
    rows = [(i, np.asarray(v, np.float32).tolist()) for i, v in enumerate(rows)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert found(e.near_vectors(df, window=8, block=16)) == brute(rows)


def test_pairs_at_the_threshold_in_a_hot_cluster(spark):
    """A third of the vectors share a direction (cosine 0.7); partners at 0.90 to 0.92 are planted."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(rng.standard_normal((20_000, 64)))
    hot = len(x) // 3
    x[:hot] = unit(np.sqrt(0.7) * unit(rng.standard_normal(64)) + np.sqrt(0.3) * x[:hot])
    picked = rng.choice(len(x), 400, replace=False)
    away = rng.standard_normal((400, 64))
    away = unit(away - (away * x[picked]).sum(1, keepdims=True) * x[picked])
    cosine = rng.uniform(0.901, 0.92, (400, 1))
    y = cosine * x[picked] + np.sqrt(1 - cosine * cosine) * away
    rows = [(i, v) for i, v in enumerate(np.concatenate([x, y]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    named = {r.vec_id: r.component_id for r in e.near_vectors(df).collect()}
    missed = sum(named[len(x) + k] != named[i] for k, i in enumerate(picked.tolist()))
    assert len(named) == len(rows) and missed <= 2
