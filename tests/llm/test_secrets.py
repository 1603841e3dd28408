"""Fixed patterns against plain regular expressions; learned formats on their own kind."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries
from eventloom.llm import secrets as s
from eventloom.llm.common import table

KEYWORD = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"


def brute(text):
    found = []
    for m in re.finditer(KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text or ""):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text or ""):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(found)]


def test_query_against_patterns(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    total = 0
    for r in queries.QUERIES["op10_secret_spans"](spark, folder).collect():
        base = brute(texts[r.doc_id])
        total += len(base)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("grammar")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))
    assert total > 10


def test_random_texts():
    rnd = random.Random(4)
    bits = ["password", "Secret", "API_KEY", "apikey", "toKen", " ", "=", ":", '"', "'", "  ", "abc", "ABCDEF", "0123456789abcdef01234567", "AKIA", "ABCDEFGHIJKLMNOP", "ſecret", "toKen", "é", "\U0001f642", "\n", ".", "-"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
        assert s.digest(s.base_spans(text)).split(",") == (brute(text) or [""])


def test_awkward_rows(spark, docs, no_docs):
    clashing = docs.withColumns({"found": F.lit("mine"), "redacted": F.lit("mine"), "_text": F.lit(1)})
    rows = s.scan(clashing, s.learned(clashing), carry=("doc_id", "found", "text"), prefix="p_").collect()
    assert len(rows) == docs.count() and all(r.found == "mine" for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[4].p_found == [] and by[4].p_redacted is None and by[5].p_redacted == ""
    for r in rows:
        assert [f"{x.kind}:{x.start}:{x.end}" for x in r.p_found if x.kind != "grammar"] == brute(r.text)
    assert by[15].p_redacted == "[access secret] and [hex secret] and AKIASHORT"
    assert s.scan(no_docs, s.learned(no_docs)).count() == 0
    assert s.scan(docs, s.learned(no_docs)).count() == docs.count()


def credentials(rnd, n):
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(32)) for _ in range(n)]
    keys = ["AKIA" + "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(n)]
    words = ["".join(rnd.choice(("th", "er", "on", "ing", "tion", "ment", "ed")) for _ in range(8)) for _ in range(n)]
    return hexes, keys, words


def test_formats_generalise():
    hexes, keys, words = credentials(random.Random(1), 300)
    formats = s.Formats.learn([("hex", h) for h in hexes] + [("access", k) for k in keys], words)
    hexes, keys, words = credentials(random.Random(2), 200)
    score = lambda runs: sum(formats.score(r) >= formats.threshold for r in runs) / len(runs)
    assert score(hexes) > 0.95 and score(keys) > 0.95 and score(words) == 0
    assert score([h[:20] for h in hexes]) > 0.9  # too short for the fixed pattern
    text = f"see {hexes[0][:22]} here"
    assert s.spans(text, formats) == [(4, 26, "grammar")] and s.base_spans(text) == []


@pytest.mark.parametrize("share", [0, 0.005, 0.01, 0.05])
def test_bare_credentials_among_ordinary_runs(spark, share):
    """Labelled 32-digit ones; unseen ones of 20 digits in prose, some of them met in training."""
    rnd = random.Random(8)
    hexes, _, words = credentials(rnd, 800)
    bare = [h[:20] for h in credentials(rnd, int(800 * share))[0]]
    prose = words[: 800 - len(bare)] + bare
    rnd.shuffle(prose)
    texts = [f"key {h} end" for h in hexes[:400]] + [" ".join(prose[i : i + 8]) for i in range(0, 800, 8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    formats = s.learned(docs)
    unseen, _, plain = credentials(random.Random(9), 300)
    assert sum(bool(s.spans(f"see {h[:20]} here", formats)) for h in unseen) > 0.9 * len(unseen)
    assert not any(s.spans(w, formats) for w in plain)
    rows = {r.doc_id: r.found for r in s.scan(docs, formats).collect()}
    assert sum(x.kind == "grammar" for f in rows.values() for x in f) >= 0.9 * len(bare)


def test_short_and_dotted_credentials():
    rnd = random.Random(6)
    part = lambda n: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    formats = s.Formats.learn([("assign", f"{part(5)}.{part(5)}") for _ in range(400)], credentials(rnd, 800)[2])
    assert s.spans(f"so {(run := part(5) + '.' + part(5))}. Then", formats) == [(3, 3 + len(run), "grammar")]
    assert s.spans("so thermenting. Then", formats) == []


def walk(automaton, run):
    """The probability of a run by a plain walk with shares, without logarithms."""
    state, p = 0, 1.0
    for c in [*run, None]:
        kind = "$" if c is None else "0" if c.isdigit() else c if not c.isalpha() else ("A" if c in "ABCDEF" else "G") if c.isupper() else ("a" if c in "abcdef" else "g")
        seen = automaton.count[state] if state is not None else {}
        size = {"0": 10, "a": 6, "A": 6, "g": 20, "G": 20}.get(kind, 1)
        p *= (seen[kind] + 0.05) / (sum(seen.values()) + 0.8) / size if kind in seen else 1e-4
        state = None if state is None or c is None else automaton.step[state].get(kind)
    return p


def test_scores_against_a_plain_walk():
    rnd = random.Random(12)
    hexes, keys, words = credentials(rnd, 200)
    formats = s.Formats.learn([("hex", h) for h in hexes] + [("access", k) for k in keys], words + ["10.5-a=", "2024-01-05"])
    assert formats.least == pytest.approx(math.log(202 / s.FALSE))
    for run in [*credentials(rnd, 20)[0], *keys[:20], *words[:20], "2024-01-05", "a.b.c+d", "Zz9_/="]:
        run = run[: rnd.randrange(6, 30)]
        ratio = math.log(max(walk(a, run) for a in formats.known.values()) / walk(formats.background, run))
        assert formats.score(run) == pytest.approx(ratio / max(len(run), formats.least / s.THRESHOLD))


def test_merging_shrinks_the_tree():
    hexes, _, _ = credentials(random.Random(3), 300)
    automaton = s.infer(hexes)
    assert len(automaton.step) < 60
    assert automaton.log_likelihood(s.classes(hexes[0])) > automaton.log_likelihood(s.classes("thermentinging" * 2))
    assert s.infer([]).log_likelihood("0") < 0
