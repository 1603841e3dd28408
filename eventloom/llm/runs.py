"""Periodic runs of words by suffix trees.

A run is a stretch of words that repeats itself with its smallest period at least LEAST_EXPONENT
times and that no neighbouring word extends.  Runs come from the runs theorem: under one of the two
orders of the symbols, every run holds a Lyndon root that is the longest Lyndon word at its start.
So each position gives one candidate root per order (the next smaller suffix ends it), and the root
is extended in both directions by longest common extensions.  These are constant-time: Ukkonen's
suffix trees of the text and of its reversal are toured once, and the extension of two positions is
the least string depth that the Euler tour meets between their leaves, read off a sparse table.

Before the trees are built, words that cannot lie in any run are cut away: inside a run every word
and every three consecutive words recur.  That is exact, and ordinary prose is left without a symbol.
What remains of several documents is laid end to end behind symbols that occur once, so a tree
holds BLOCK_WORDS symbols, or one document's, if those are more.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_EXPONENT = 4
LEAST_LENGTH = 6
BLOCK_WORDS = 20_000
BATCH_WORDS = 1_000_000  # words of several documents looked at together
_BUCKETS = 1 << 22
_SHIFT = 40  # edges are keyed by node and symbol in one integer
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


class SuffixTree:
    """Ukkonen's tree of a sequence whose last symbol occurs once; leaf k is the suffix at k."""

    def __init__(self, symbols: list[int]):
        n = len(symbols)
        self.n = n
        start, end, link, suffix = [0], [0], [0], [-1]
        edges: dict[int, int] = {}
        node = first = length = waiting = leaves = 0
        for i, c in enumerate(symbols):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    first = i
                key = node << _SHIFT | symbols[first]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(leaves)
                    leaves += 1
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = start[child]
                    span = end[child] - begin
                    if length >= span:
                        node, first, length = child, first + span, length - span
                        continue
                    if symbols[begin + length] == c:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle = len(start)
                    edges[key] = middle
                    edges[middle << _SHIFT | c] = middle + 1
                    edges[middle << _SHIFT | symbols[begin + length]] = child
                    start += (begin, i)
                    end += (begin + length, n)
                    link += (0, 0)
                    suffix += (-1, leaves)
                    leaves += 1
                    start[child] = begin + length
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    first = i - waiting + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        children = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        self._parents, self._children = keys[order] >> _SHIFT, children[order]
        self._spans = (np.array(end) - np.array(start)).tolist()
        self._suffix = suffix

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(leaves, low): the suffixes in the order of an Euler tour that takes children by rising (or
        falling) symbols, and the least string depth met since the leaf before."""
        children = self._children if falling else self._children[::-1]  # the stack turns them round
        parents = self._parents if falling else self._parents[::-1]
        bounds = np.flatnonzero(np.diff(parents)) + 1
        heads = parents[np.concatenate(([0], bounds))].tolist()
        below = dict(zip(heads, [part.tolist() for part in np.split(children, bounds)], strict=True))
        spans, suffix = self._spans, self._suffix
        leaves, low = [], []
        stack, least = [(child, 0) for child in below[0]], 0
        while stack:
            node, above = stack.pop()
            if above < least:
                least = above
            k = suffix[node]
            if k >= 0:
                leaves.append(k)
                low.append(least)
                least = self.n
            else:
                depth = above + spans[node]
                stack += [(child, depth) for child in below[node]]
        return np.array(leaves), np.array(low, dtype=np.int32)


class Extensions:
    """Longest common extensions of pairs of positions, from one tour of a tree."""

    def __init__(self, leaves: np.ndarray, low: np.ndarray):
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        levels, width = [low], 1
        while 2 * width <= len(low):
            last = levels[-1]
            levels.append(np.concatenate((np.minimum(last[:-width], last[width:]), last[len(last) - width :])))
            width *= 2
        self.levels = np.stack(levels)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For i != j: how many symbols the suffixes at i and j share."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        return np.minimum(self.levels[level, a], self.levels[level, b - (1 << level) + 1]).astype(np.int64)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix the next one behind it that is smaller; the length if there is none."""
    r, n = rank.tolist(), len(rank)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, mine = i + 1, r[i]
        while j < n and r[j] > mine:
            j = out[j]
        out[i] = j
    return np.array(out, dtype=np.int64)


def runs(symbols: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence whose last symbol occurs once."""
    n = len(symbols)
    tree = SuffixTree(symbols.tolist())
    ahead = Extensions(*tree.tour())
    behind = Extensions(*SuffixTree([*symbols[::-1].tolist(), int(symbols.max()) + 1]).tour())
    found = []
    for rank in (ahead.rank, Extensions(*tree.tour(falling=True)).rank):
        j = next_smaller(rank)
        i = np.flatnonzero(j < n)
        j = j[i]
        end = j + ahead.of(i, j)
        start = i.copy()
        inner = i > 0
        start[inner] -= behind.of(n - i[inner], n - j[inner])
        length, period = end - start, j - i
        good = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
        found.append(np.stack((start[good], length[good], period[good]), axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _counts(keys: np.ndarray) -> np.ndarray:
    _, where, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[where]


def _stretches(good: np.ndarray, parts: np.ndarray, least: int) -> np.ndarray:
    """Rows (begin, end) of the longest stretches of good positions within one part, ``least`` long."""
    edge = np.diff(np.concatenate(([0], good.astype(np.int8), [0])))
    cut = np.flatnonzero(np.diff(parts) != 0) + 1
    cut = cut[good[cut - 1] & good[cut]]
    begin = np.sort(np.concatenate((np.flatnonzero(edge == 1), cut)))
    end = np.sort(np.concatenate((np.flatnonzero(edge == -1), cut)))
    return np.stack((begin, end), axis=1)[end - begin >= least]


def recurring(ids: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Rows (begin, end) of the stretches outside which no run of any document has a word.

    A run of period q holds LEAST_EXPONENT whole periods, so each of its words occurs that often in it
    and any three consecutive ones at least once less.  Hashes that collide only keep more words.
    """
    if len(ids) < LEAST_LENGTH:
        return np.empty((0, 2), dtype=np.int64)
    x, d = ids.astype(np.uint64), docs.astype(np.uint64)
    mixed = x[:-2] * _FACTORS[0] + x[1:-1] * _FACTORS[1] + x[2:] * _FACTORS[2] + d[:-2] * _FACTORS[3]
    bucket = ((mixed ^ (mixed >> np.uint64(29))) * _FACTORS[1] >> np.uint64(42)).astype(np.int64)
    often = np.bincount(bucket, minlength=_BUCKETS)[bucket] >= LEAST_EXPONENT - 1
    kept = _stretches(often & (docs[:-2] == docs[2:]), docs[:-2], LEAST_LENGTH - 2) + [0, 2]
    while len(kept):
        size = kept[:, 1] - kept[:, 0]
        part = np.repeat(np.arange(len(kept)), size)
        at = np.arange(len(part)) - np.repeat(np.cumsum(size) - size - kept[:, 0], size)
        good = _counts(part * (int(ids.max()) + 1) + ids[at]) >= LEAST_EXPONENT
        if good.all():
            break
        inside = _stretches(good, part, LEAST_LENGTH)
        kept = np.stack((at[inside[:, 0]], at[inside[:, 1] - 1] + 1), axis=1) if len(inside) else kept[:0]
    return kept


def runs_of(ids: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Rows (begin in ``ids``, length, period) of the runs of all documents, by begin and period.

    ``docs`` numbers the document of each word, rising.
    """
    kept, out = recurring(ids, docs), []
    ends = np.cumsum(kept[:, 1] - kept[:, 0])
    row = 0
    while row < len(kept):
        base = ends[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(ends, base + BLOCK_WORDS, side="right")))
        block = kept[row:last]
        # Stretches of one block may share words, never a run: a symbol that occurs once ends each.
        marks = int(ids.max()) + 1 + np.arange(len(block))
        text = np.concatenate([x for (b, e), m in zip(block.tolist(), marks, strict=True) for x in (ids[b:e], [m])])
        starts = np.cumsum(block[:, 1] - block[:, 0] + 1) - (block[:, 1] - block[:, 0] + 1)
        found = runs(text)
        home = np.searchsorted(starts, found[:, 0], side="right") - 1
        found[:, 0] += block[home, 0] - starts[home]
        out.append(found)
        row = last
    found = np.concatenate(out) if out else np.empty((0, 3), dtype=np.int64)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def echoed(words: list[bytes], key: str | None) -> list[bytes]:
    """The words of one document in ten with a repeated tail, fixed by the key; a NULL key changes nothing."""
    n, h = len(words), 1 if key is None else zlib.crc32(key.encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", echo: bool = False) -> DataFrame:
    """(key, runs, collapsed) of every row: all runs as (start, length, period) by start and period, and
    the words that no run repeats, joined by one space.

    Words are runs of anything but blanks and the control characters 9 to 13, numbered from 0.  A
    word is left out of ``collapsed`` if a run holds it behind the run's first period.  NULL, empty
    and word-less texts have no runs and collapse to the empty string.  Repeated rows each give a row,
    a NULL key is handed on, an empty table gives an empty one, other columns are ignored whatever
    their names.  Equal runs found from several roots stand once.  A text of any length is one
    document: memory is a few hundred bytes for each of its words that recur.  ``echo`` first
    repeats the tail of some documents (see ``echoed``).
    """
    kind = docs.schema[key].dataType.simpleString()
    outcome = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judged(words: list[list[bytes]]):
        numbers: dict[bytes, int] = {}
        sizes = [len(w) for w in words]
        flat = [numbers.setdefault(x, len(numbers)) for w in words for x in w]
        home = np.repeat(np.arange(len(words)), sizes)
        found = runs_of(np.array(flat, dtype=np.int64), home)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        parts = np.searchsorted(found[:, 0], begins)
        for i, w in enumerate(words):
            mine = found[parts[i] : parts[i + 1]] - [begins[i], 0, 0]
            gone = np.zeros(len(w) + 1, dtype=np.int64)
            np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
            np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
            keep = np.cumsum(gone[:-1]) == 0
            rest = b" ".join(w) if keep.all() else b" ".join([x for x, k in zip(w, keep.tolist(), strict=True) if k])
            yield [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()], rest.decode("utf-8", "surrogatepass")

    def run(batches):
        for batch in batches:
            keys, names = batch.column("_key"), batch.column("_name").to_pylist()
            texts = batch.column("_text")
            held, size, first = [], 0, 0
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                words = t.encode("utf-8", "surrogatepass").split() if t else []
                held.append(echoed(words, names[i]) if echo else words)
                size += len(words)
                if size >= BATCH_WORDS or i + 1 == batch.num_rows:
                    rows, rests = zip(*judged(held), strict=True)
                    yield pa.RecordBatch.from_arrays([keys.slice(first, len(held)), pa.array(rows, outcome), pa.array(rests, pa.string())], names=[key, "runs", "collapsed"])
                    held, size, first = [], 0, i + 1

    rows = docs.select(F.col(key).alias("_key"), F.col(key).cast("string").alias("_name"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: the number of runs, the longest one (of equal ones the first, then that of
    the smaller period) and digests of all runs and of the collapsed text."""
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    length, period = -best["shorter"], best["period"]
    return found.select(
        key, F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
