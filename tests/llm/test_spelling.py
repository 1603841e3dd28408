"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventloom.llm import spelling
from eventloom.llm.common import table
from eventloom.llm.queries import QUERIES
from tests.conftest import SF

UP = {ord(a): b for a, b in zip(spelling.UPPER, spelling.LOWER, strict=True)}


def edits(w, alphabet):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
    return (out | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}) - {w}


def brute(counts):
    alphabet = sorted({c for w in counts for c in w})
    form, near = {}, {}
    for w, n in counts.items():
        found = [v for v in edits(w, alphabet) if v in counts]
        near[w] = len(found)
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], form[w] and counts[form[w]]))
    return sorted(out, key=lambda r: r[0])


def counted(rows, typos):
    n = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(UP)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if typos and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += len(w) >= 7
    return {w: k for w, k in n.items() if k >= 2}


def listed(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.mark.parametrize("block", [4, 1024])
def test_random_vocabulary(spark, monkeypatch, block):
    """Two letters only: almost every word has near ones, halves are shared by many."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    rnd = random.Random(block)
    counts = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(7, 11))): rnd.choice([2, 3, 20, 30, 200, 3000, 40_000]) for _ in range(700)}
    counts |= {"a" * k: 2 for k in range(7, 40)} | {"abcdefg" * 400: 5, "abcdefg" * 400 + "x": 50, "b" * 7: 10**9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert listed(spelling.variants(df)) == brute(counts)


def test_words_of_awkward_documents(spark):
    rows = [(i, "Building builds  buïldings ÉtÉETEÉ " * (i % 5) + "building buildings buildong builidng x×y÷zÿabc") for i in range(60)]
    rows += [(1, None), (2, ""), (None, "nothing nothing something something"), (3, rows[3][1]), (3, rows[3][1]), (4, "42 !!"), (5, "longword" * 30_000 + " building " * 5_000)]
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    for typos in (False, True):
        want = counted(rows, typos)
        words = spelling.vocabulary(df, typos=typos)
        assert {r.word: r.n for r in words.collect()} == want
        assert listed(spelling.variants(words)) == brute({w: n for w, n in want.items() if len(w) < 1000}) + [x for x in brute({}) if x]
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0
    assert spelling.variants(spelling.vocabulary(df.where(F.col("doc_id") == 4).limit(1))).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert listed(QUERIES["op11_spelling_variants"](spark, SF)) == brute(counted(rows, True))
