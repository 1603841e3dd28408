"""Nearest vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import neighbours as nn
from eventloom.llm.common import table
from eventloom.llm.queries import QUERIES
from tests.conftest import SF


def brute(rows, asked, k):
    """query -> [(score, id)] over distinct usable (id, vector) rows."""
    seen = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            seen[i, tuple(v)] = np.array(v, dtype=np.float64)
    out = []
    for (i, v), x in seen.items():
        if asked(i):
            found = sorted((-(y * x).sum(), j) for (j, w), y in seen.items() if len(w) == len(v) and (j, w) != (i, v))
            out.append((i, [(j, -s) for s, j in found[:k]]))
    return sorted(out)


def listed(df):
    got = {}
    for r in df.orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append((r.rank, r.vec_id, r.score))
    assert all([r for r, _, _ in rows] == list(range(1, len(rows) + 1)) for rows in got.values())
    return sorted((q, [(i, s) for _, i, s in rows]) for q, rows in got.items())


def recall(got, want):
    hits = [len({i for i, _ in dict(got)[q]} & {i for i, _ in rows}) / max(1, len(rows)) for q, rows in want]
    return sum(hits) / len(hits)


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (3000, nn.TABLES), dtype=np.uint16)
    codes[1000:2000] = codes[0] ^ (np.uint16(1) << rng.integers(0, 16, (1000, nn.TABLES), dtype=np.uint16)) * (rng.random((1000, nn.TABLES)) < 0.4)
    shard = nn.Shard(codes, np.zeros((3000, 1)), np.arange(3000))
    away = nn.population(codes ^ codes[0])
    for radius in (0, 1, 2, 5, 15, 16, 17, 31, 32, 60, 100, 127, 255, 256):
        assert shard.within(codes[0], radius).tolist() == np.flatnonzero(away <= radius).tolist()


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (3, [1.0, 0.1]), (3, [0.5, 0.5]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]),
        (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e-30, 0.0]), (13, [3e30, 0.0]), (14, [-0.0, 1.0]), (15, [0.0, 1.0]), (16, [1.0, 0.0]),
        *[(100 + i, [1.0, 0.0]) for i in range(40)], (200, [5.0]), (201, [0.0, 2.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, rank int").repartition(3)
    for k in (3, 20, 100):
        got, want = listed(nn.nearest(df, F.col("vec_id") != 3, k)), [x for x in brute(rows, lambda i: i != 3, k) if x[1]]
        assert [(q, len(f)) for q, f in got] == [(q, len(f)) for q, f in want]
        assert recall(got, want) >= 0.95
        assert dict(got)[1] == dict(want)[1] and dict(got)[16] == dict(want)[16]  # ties go by id, the own row is left out
    assert got == want  # as many as there are
    twice = nn.nearest(df, F.col("vec_id") == 3, 2).collect()
    assert sorted((r.rank, r.vec_id) for r in twice) == [(1, 13), (1, 13), (2, 2), (2, 2)]
    every = F.lit(True)
    assert nn.nearest(df.limit(0), every).count() == 0
    assert nn.nearest(df.where("vec_id in (4, 6, 200)"), every).count() == 0
    assert nn.nearest(df, F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("case", ["isotropic", "hot cluster", "lengths"])
def test_recall_over_several_shards(spark, monkeypatch, case):
    monkeypatch.setattr(nn, "SHARD_ROWS", 500)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((4000, 32))
    if case == "hot cluster":
        x[:1500] = 3 * rng.standard_normal(32) + 0.5 * x[:1500]
        x[1500:2500] = x[1500]  # one vector many times
    if case == "lengths":
        x *= np.exp2(rng.uniform(-6, 6, (4000, 1)))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = listed(nn.nearest(df, F.col("vec_id") % 40 == 0))
    want = []
    for q in range(0, 4000, 40):
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        top = np.lexsort((np.arange(4000), -s))[:20]
        want.append((q, [(i, s[i]) for i in top.tolist()]))
    assert [q for q, _ in got] == [q for q, _ in want] and all(len(f) == 20 for _, f in got)
    assert all(s == (x[i] * x[q]).sum() for q, f in got for i, s in f)
    assert recall(got, want) >= 0.95


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = listed(QUERIES["op12_nearest_vectors"](spark, SF).withColumnRenamed("query_id", "query"))
    assert [q for q, _ in got] == [q for q, _ in want]
    assert recall(got, want) >= 0.95
