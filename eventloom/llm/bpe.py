"""Byte-level BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a block of a partition are laid out in one array of symbols with links
to their neighbours.  An index maps every mergeable pair to all its positions.  Ranks are then
taken in ascending order: all positions of the pair merge at once, and only the lists of the pairs
that the merge creates are extended.  A merge can only create pairs of a higher rank, because the
symbol it makes is part of them, so one ascending pass is exact.  Entries that an earlier merge
made stale are recognised when their turn comes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import numbered

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK_CHARS = 4_000_000  # text held at a time
CACHE_WORDS = 150_000  # encoded pre-tokens kept between blocks


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Pool:
    """Byte strings by number, joined by array indexing."""

    def __init__(self, strings: list[bytes]):
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length

    def join(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        ends = np.cumsum(length)
        if not len(ids):
            return b""
        return self.bytes[np.repeat(self.start[ids] - ends + length, length) + np.arange(ends[-1])].tobytes()


class Vocabulary:
    """Merge ranks and token bytes of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        back = {c: b for b, c in symbols.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = np.array([ids[symbols[b]] for b in range(256)], dtype=np.int64)
        self.token_bytes = {i: bytes(back[c] for c in t) for t, i in ids.items() if t not in self.special}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        top = max(self.token_bytes) + 1
        self.pool = Pool([self.token_bytes.get(i, b"") for i in range(top)])
        self.decimal = Pool([b"%d," % i for i in range(top)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        keys = self.left << 32 | self.right
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]
        marks = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({marks})").split if marks else None
        self.words = regex.compile(PATTERN).findall

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where it never merges."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], -1)

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens; special tokens stand as pieces of their own."""
        if self.split is None or not any(t in text for t in self.special):
            return self.words(text)
        parts = self.split(text)
        return list(chain.from_iterable([p] if p in self.special else self.words(p) for p in parts))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_words(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Token ids of each word as packed 32-bit integers, all words merged together."""
    if not words:
        return []
    lengths = np.array([len(w) for w in words])
    symbol = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbol)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # -1: none
    after[np.concatenate((first[1:], [n])) - 1] = -1
    before[first] = -1

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def post(at: np.ndarray) -> None:
        """Add the pairs that begin at these positions to the index."""
        rank = vocab.ranks(symbol[at], symbol[after[at]])
        known = rank >= 0
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        edges = [0, *cuts.tolist(), len(at)]
        for r, i, j in zip(rank[np.array(edges[:-1])].tolist(), edges, edges[1:]):
            if r in index:
                index[r].append(at[i:j])
            else:
                index[r] = [at[i:j]]
                heapq.heappush(active, r)

    post(np.flatnonzero(after >= 0))
    while active:
        r = heapq.heappop(active)
        a, b, new = vocab.left[r], vocab.right[r], vocab.made[r]
        lists = index.pop(r)
        at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
        at = at[(symbol[at] == a) & (after[at] >= 0)]
        at = at[symbol[after[at]] == b]
        if not len(at):
            continue
        if a == b:  # in a run of equal symbols every second pair merges, from the left
            at = np.sort(at)
            fresh = np.concatenate(([True], after[at[:-1]] != at[1:]))
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
        gone = after[at]
        symbol[at], symbol[gone] = new, -1
        follow = after[gone]
        after[at], after[gone] = follow, -1
        linked = follow >= 0
        before[follow[linked]] = at[linked]
        lead = before[at]
        post(np.unique(np.concatenate((lead[lead >= 0], at[linked]))))

    kept = symbol >= 0
    flat = symbol[kept].astype(np.int32).tobytes()
    ends = (4 * np.cumsum(np.add.reduceat(kept, first))).tolist()
    return [flat[i:j] for i, j in zip([0, *ends[:-1]], ends)]


class Encoder:
    """Encodes blocks of texts; pre-tokens seen before are taken from a bounded cache."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        if not self.cache:
            self.cache.update({t: np.int32(i).tobytes() for t, i in self.vocab.special.items()})
        cache = self.cache
        pieces = [self.vocab.pieces(t or "") for t in texts]
        new = list({w for p in pieces for w in p if w not in cache})
        cache.update(zip(new, encode_words([w.encode("utf-8", "replace") for w in new], self.vocab)))
        return [np.frombuffer(b"".join(map(cache.__getitem__, p)), np.int32) for p in pieces]

    def decode(self, ids: np.ndarray) -> str:
        return self.vocab.pool.join(ids).decode("utf-8", "replace")

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.vocab.decimal.join(ids)[:-1]


def blocks(batches: Iterable[pa.RecordBatch], column: str, chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``chars`` characters, one row at least."""
    for batch in batches:
        sizes = np.cumsum([len(t) if t else 0 for t in batch.column(column).to_pylist()])
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def decoded(encodings: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids)."""
    kind = encodings.schema[key].dataType.simpleString()

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            texts = [encoder.decode(np.array(i or [], dtype=np.int32)) for i in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], names=[key, "text"])

    return encodings.select(F.col(key).alias("_key"), F.col("ids").alias("_ids")).mapInArrow(run, f"{key} {kind}, text string")


OUTPUTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "array<int>", "decoded": "string"}


def round_trip(docs: DataFrame, path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), outputs: tuple[str, ...] = tuple(OUTPUTS), prefix: str = "") -> DataFrame:
    """Encode every whole text and decode it again, in one pass over the data.

    Returns the ``carry`` columns and any of ``n_tokens``, ``ids``, ``ids_sha256`` (of the decimal ids
    joined by commas), ``decoded`` and ``decoded_sha256``; ``prefix`` is put before these names where
    carried columns may have them already.  NULL counts as the empty text, which has no ids; repeated
    rows and NULLs in other columns are kept as they are.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([*[f"`{c}` {fields[c]}" for c in carry], *[f"`{prefix}{o}` {OUTPUTS[o]}" for o in outputs]])

    def run(batches):
        encoder = Encoder(path)
        make = {
            "n_tokens": lambda ids, backs: pa.array([len(i) for i in ids], pa.int64()),
            "ids": lambda ids, backs: pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), pa.array(np.concatenate(ids) if ids else [], pa.int32())),
            "ids_sha256": lambda ids, backs: pa.array([hashlib.sha256(encoder.decimals(i)).hexdigest() for i in ids], pa.string()),
            "decoded": lambda ids, backs: pa.array(backs, pa.string()),
            "decoded_sha256": lambda ids, backs: pa.array([hashlib.sha256(b.encode("utf-8", "replace")).hexdigest() for b in backs], pa.string()),
        }
        for block in blocks(batches, "_text"):
            ids = encoder.encode(block.column("_text").to_pylist())
            backs = [encoder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [block.column(i) for i in range(1, block.num_columns)] + [make[o](ids, backs) for o in outputs],
                names=[*carry, *[f"{prefix}{o}" for o in outputs]],
            )

    return numbered(docs, text, carry).mapInArrow(run, out)
