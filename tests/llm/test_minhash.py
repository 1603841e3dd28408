"""Near-copy groups against all pairs on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import graph, minhash
from eventloom.llm.shingles import Shingler


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """component per row: links by the full sets, smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            r = root(i)
            least[r] = min(k, least.get(r, k))
    return sorted(((k, len(s), least.get(root(i))) if s else (k, 0, k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_awkward_rows(spark, docs, no_docs):
    clashing = docs.withColumns({c: F.lit("x") for c in ("kept", "node", "component_id", "_hash", "_key", "signature")})
    result = minhash.near_duplicates(clashing)
    assert found(result) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())
    assert minhash.near_duplicates(no_docs).count() == 0


def near_copies(seed, groups=4, copies=30):
    """Groups around one text each with similarities on both sides of the threshold."""
    rnd = random.Random(seed)
    rows, vocabulary = [], [f"v{i}" for i in range(3000)]
    for g in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice((12, 80, 200)))]
        for c in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + len(words) // 30)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join(rnd.choice(vocabulary) for _ in range(50))) for i in range(40)]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_random_groups_with_small_blocks(spark, monkeypatch, block):
    """Blocks of seven send every larger group over the second level."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)
    rows = near_copies(block)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(minhash.near_duplicates(df)) == brute(rows)


def test_one_row_of_each_group_stays(spark, docs):
    kept = minhash.deduplicated(docs.withColumn("extra", F.lit(1)))
    assert kept.columns == [*docs.columns, "extra"]
    ids = sorted((r.doc_id, r.text is not None) for r in kept.collect() if r.doc_id is not None)
    # 2, the NULL-id copy and both rows of 3 belong to 1; 7 to 6; "One  TWO" to "one two".
    assert [i for i, _ in ids] == [1, 4, 5, 6, 8, 9, 11, 12, 13, 14, 15, 16]
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, ""), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.deduplicated(df).collect()) == [(1, "a b c d e f"), (2, ""), (2, "")]


def test_components_of_a_chain(spark):
    n = 40
    names = [bytes([7 * i % n]) for i in range(n)]
    edges = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in zip(names, names[1:])], "a binary, b binary")
    rows = graph.components(edges, "chain").collect()
    assert {bytes(r.component) for r in rows} == {bytes([0])} and len(rows) == n
    assert graph.components(edges.limit(0), "none").count() == 0


def test_collisions_needed_hardly_ever_fail():
    from math import comb

    k, t = minhash.COORDINATES, minhash.MATCHES
    assert sum(comb(k, i) * 0.75**i * 0.25 ** (k - i) for i in range(t)) < 1e-8


def test_shingles_are_word_sequences():
    s = Shingler()
    assert len(s.hashes("A b c d e f")) == 2 and np.array_equal(s.hashes("A b c d e f"), s.hashes("a  B\tc\nd e f"))
    assert not np.array_equal(s.hashes("a b"), s.hashes("a b c")) and not np.array_equal(s.hashes("a b"), s.hashes("b a"))
    assert len(s.hashes("É é")) == 1 and not np.array_equal(s.hashes("É"), s.hashes("é"))
