"""Periodic runs against a scan of every start and period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import runs
from eventloom.llm.queries import QUERIES
from eventloom.llm.common import table
from tests.conftest import SF


def brute(words):
    """Every maximal stretch of every period, kept if the period is the smallest of the stretch."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)  # periods come rising
            i = j
    return sorted((s, length, q) for (s, length), q in out.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


@given(st.lists(st.integers(0, 2), max_size=60))
@settings(max_examples=300, deadline=None)
def test_runs_of_small_alphabets(word):
    got = runs.runs(np.array([*word, 9])).tolist()
    assert sorted(map(tuple, got)) == brute(word)


def test_trees_give_suffix_order_and_extensions():
    rnd = random.Random(4)
    for _ in range(60):
        s = [rnd.randrange(3) for _ in range(rnd.randrange(1, 40))] + [7]
        tree = runs.SuffixTree(s)
        up, down = runs.Extensions(*tree.tour()), runs.Extensions(*tree.tour(falling=True))
        assert np.argsort(up.rank).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        assert np.argsort(down.rank).tolist() == sorted(range(len(s)), key=lambda i: [-x for x in s[i:]])
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        want = [next(k for k in range(len(s)) if s[i + k] != s[j + k]) for i, j in pairs]
        i, j = (np.array(x) for x in zip(*pairs))
        assert up.of(i, j).tolist() == want == down.of(i, j).tolist()


def test_documents_keep_apart_and_cutting_loses_nothing(monkeypatch):
    rnd = random.Random(5)
    monkeypatch.setattr(runs, "BLOCK_WORDS", 50)  # several blocks
    docs = []
    for _ in range(80):
        words = [rnd.randrange(30) for _ in range(rnd.randrange(0, 40))]
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = [rnd.randrange(30) for _ in range(rnd.randrange(1, 4))] * rnd.randrange(1, 9)
        docs.append(words)
    ids = np.array([w for d in docs for w in d])
    home = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    begin = np.cumsum([0, *map(len, docs)])
    want = [(s + begin[i], length, q) for i, d in enumerate(docs) for s, length, q in brute(d)]
    assert [tuple(r) for r in runs.runs_of(ids, home).tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def awkward():
    base = "a b c d"
    rows = [(i, " ".join(f"w{k % (3 + i % 7)}" for k in range(5 + i))) for i in range(120)]
    return rows + [
        (1000, None), (1001, ""), (1002, " \t\n "), (1003, "x " * 6), (1004, "x x x x x"), (1005, (base + "\x0b") * 3), (1006, base + " " + (base + "\n") * 4),
        (1007, "é é " * 8), (None, "y z " * 9), (None, None), (3, "w0 w1 w2"), (3, "w0 w1 w2"), (1008, "q r " * 60_000 + "s"), (1009, "A a " * 5),
    ]


def test_awkward_documents(spark):
    rows = awkward()
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in rows], "doc_id long, text string, collapsed string, runs array<int>").repartition(3)
    got = runs.digest(runs.periodic_runs(df, echo=True)).collect()
    small = [r for r in rows if r[0] != 1008]
    assert sorted((tuple(r) for r in got if r.doc_id != 1008), key=repr) == sorted((brute_row(*r) for r in small), key=repr)
    long = next(r for r in got if r.doc_id == 1008)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 120_000, 2)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    plain = {r.doc_id: r for r in runs.periodic_runs(df.where("doc_id > 1002")).collect()}
    assert plain[1006].collapsed == base_text(plain[1006].runs) and [tuple(r) for r in plain[1003].runs] == [(0, 6, 1)]


def base_text(found):
    assert [tuple(r) for r in found] == [(0, 20, 4)]
    return "a b c d"


@pytest.mark.parametrize("name", ["op13_periodic_runs"])
def test_query_against_brute_force(spark, name):
    want = sorted((brute_row(r.doc_id, r.text) for r in table(spark, SF, "documents").collect() if len(r.text or "") < 40_000), key=repr)
    got = {r.doc_id: tuple(r) for r in QUERIES[name](spark, SF).collect()}
    assert [got[r[0]] for r in want] == want
