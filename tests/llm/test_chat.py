"""Snapshots collapse; the rest is rendered whole."""

from collections import defaultdict

from eventloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, h1 long"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """conv -> its distinct rows in order; proper prefixes and all but the smallest of equal ones go."""
    by = defaultdict(lambda: defaultdict(set))
    for c, t, r, x in rows:
        by[c][t].add((r, x))
    order = lambda t: (t is not None, t or 0)
    said = {c: [(t, frozenset(v[t])) for t in sorted(v, key=order)] for c, v in by.items()}
    kept = {}
    for c, s in said.items():
        if any(len(o) > len(s) and o[: len(s)] == s for o in said.values()):
            continue
        same = [k for k, o in said.items() if o == s]
        kept[min((k for k in same if k is not None), default=None)] = len(same)
    out = {}
    for c, copies in kept.items():
        lines = sorted(((t is not None, t or 0, r or "", x or "") for t, v in by[c].items() for r, x in v))
        out[c] = (copies, len(lines), "".join(f"<|{r}|>\n{x}\n<|end|>\n" for *_, r, x in lines))
    return out


def found(df):
    parts = defaultdict(list)
    for r in df.collect():
        parts[r.conv_id].append(r)
    return {c: (p[0].copies, sum(x.n_turns for x in p), "".join(x.chat for x in sorted(p, key=lambda x: x.part))) for c, p in parts.items()}


def test_awkward_conversations(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "bot", "b"), (3, 2, "user", "c"),
        (4, 0, "user", "a"), (4, 1, "bot", "b"), (4, 2, "user", "c"), (5, 0, "user", None), (6, 0, None, "user"), (7, 0, "user", ""), (7, 0, "user", ""),
        (8, None, "user", "x"), (8, 0, None, None), (9, None, "user", "x"), (None, 0, "user", "q"), (None, 1, "bot", "long " * 50_000),
        (10, 3, "user", "tie 2"), (10, 3, "user", "tie 1"), (10, 4, "bot", "z"), (11, 3, "user", "tie 1"), (12, 3, "user", "tie 1"), (12, 3, "user", "tie 2"), (13, -5, "user", "neg"), (13, 200, "bot", "far"),
    ]
    assert found(chat.formatted(make(spark, rows))) == brute(rows)
    assert chat.formatted(make(spark, rows).limit(0)).count() == 0


def test_snapshots_across_blocks(spark):
    turns = [(t, "user" if t % 2 == 0 else "bot", f"turn {t % 5}") for t in range(200)]
    rows = [(c, *t) for c, n in ((1, 1), (2, 63), (3, 64), (4, 65), (5, 199), (6, 200), (7, 200)) for t in turns[:n]]
    result = chat.formatted(make(spark, rows))
    assert found(result) == brute(rows)
    assert sorted((r.conv_id, r.part, r.n_turns) for r in result.collect()) == [(6, 0, 64), (6, 1, 64), (6, 2, 64), (6, 3, 8)]


def test_no_python_in_the_plan(spark):
    plan = chat.formatted(make(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
