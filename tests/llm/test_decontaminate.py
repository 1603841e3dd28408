"""Leaks against a window-by-window comparison."""

import math
import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from eventloom.llm import decontaminate as d


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    out, texts = {}, {}
    for i, t in items:
        texts.setdefault(tuple(tokens(t)), []).append(i)
    for w, ids in texts.items():
        item = min((i for i in ids if i is not None), default=None)
        need = math.ceil(min(len(w), d.REACH) * d.SHARE - 1e-9)
        for key, text in docs:
            doc, best = tokens(text), 0
            for p in range(len(doc) - d.SPAN + 1):
                for q in range(len(w) - d.SPAN + 1):
                    if any(all(doc[p + k] == w[q + k] for k in m) for m in d.MASKS):
                        same = [0 <= p + k < len(doc) and 0 <= q + k < len(w) and doc[p + k] == w[q + k] for k in range(-d.BEFORE, d.REACH)]
                        best = max(best, *(sum(same[i : i + d.REACH]) for i in range(d.BEFORE + 1)))
            if best >= need and best:
                out[key, item] = max(best, out.get((key, item), 0))
    return out


def found(df):
    return {(r.doc_id, r.item_id): r.matched_tokens for r in df.collect()}


def corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((15, 20, 40, 60, 12, 9, 8, 0))]
    docs = []
    for k in range(60):
        text = [word() for _ in range(rnd.randrange(5, 60))]
        if k % 2:
            _, item = items[rnd.randrange(len(items))]
            part = item.split()
            for _ in range(rnd.randrange(0, 1 + len(part) // 4)):
                part[rnd.randrange(len(part))] = word().upper()
            text[3:3] = part
        docs.append((k, ", ".join(text)))
    return docs, items


def test_substitutions(spark):
    docs, items = corpus()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert len(expected) > 15
    assert found(d.leaks(df, bench)) == expected
    assert found(d.leaks(df, bench, seed_rows=40)) == expected  # several broadcast blocks


def test_awkward_rows(spark, docs, no_docs):
    from tests.llm.conftest import PASSAGE

    items = [(1, PASSAGE), (2, PASSAGE.upper()), (3, None), (4, ""), (5, "too short"), (None, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11 word12 word13 word14 word15")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    result = d.leaks(docs.withColumns({"item_id": F.lit(1), "_item": F.lit(2), "_words": F.lit(3)}), bench)
    assert found(result) == brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert {k for k, _ in found(result)} == {1, 2, 3, None, 11}
    assert d.leaks(no_docs, bench).count() == 0 and d.leaks(docs, bench.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    plan = d.leaks(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_substitution_the_rule_accepts(spark):
    """All ways to change as many tokens as the 80 % rule allows, without looking at masks."""
    items = [(n, " ".join(f"t{n}x{i}" for i in range(n))) for n in (9, 10, 11, 12, 13, 14, 15, 18)]
    docs = []
    for n, text in items:
        stretch = min(n, d.REACH)
        for changed in combinations(range(stretch), stretch - math.ceil(stretch * d.SHARE - 1e-9)):
            words = [f"other{i}" if i in changed else w for i, w in enumerate(text.split()[:stretch])]
            docs.append((n, " ".join(["before", *words, "after"])))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string")
    got = found(d.leaks(df, spark.createDataFrame(items, "item_id long, text string")))
    assert set(got) == {(i, n) for i, (n, _) in enumerate(docs)}


def test_one_pass_however_many_items(spark):
    """Beyond seed_rows hashes the documents are still split once, and only the filter is broadcast."""
    docs, items = corpus()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for seed_rows, broadcasts in ((40, 1), (d.SEED_ROWS, 3)):
        execution = d.leaks(df, bench, seed_rows=seed_rows)._jdf.queryExecution()
        assert execution.optimizedPlan().toString().count("regexp_extract_all") == 1
        assert execution.executedPlan().toString().count("BroadcastExchange") == broadcasts


def test_a_crowded_filter_loses_nothing(spark, monkeypatch):
    docs, items = corpus(2)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seeds = d._seeds(d._hashed(d.item_windows(bench), "_around"), F.lit(d.BEFORE)).select("_seed")
    others = spark.range(20_000).select(F.xxhash64("id").alias("_seed"))
    n = seeds.count()
    assert d._passing(others, seeds, n).count() < 200
    monkeypatch.setattr(d, "FILTER_BITS", 1)
    assert d._passing(seeds, seeds, n).count() == n
    assert found(d.leaks(df, bench)) == brute(docs, items)
