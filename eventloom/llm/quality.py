"""Document quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed words, word shapes, pairs of neighbouring shapes and repetitions.  A truncated
singular value decomposition of a bounded sample of labelled documents gives the latent space.  The
labelled vectors are broadcast (their number is bounded); every document is projected, its cosines
with all of them are computed exactly in blocks, and the nearest vote with their similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import held_out, numbered

WORDS, SHAPES, PAIRS = 2048, 512, 1536  # hashed terms per kind
REPEATS = 3  # a word like the one before, a line seen before, a word seen before
TERMS = WORDS + SHAPES + PAIRS + REPEATS
WEIGHTS = (0.5, 1.0, 1.0, 1.0)
RANK = 64
TRAIN_ROWS = 6000  # bound of the labelled sample
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.3
BLOCK = 2048  # documents whose products are held at a time
_CACHE_WORDS = 100_000
_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_EDGES = re.compile(r"^\W+|\W+$")


def shape(word: str) -> str:
    """Upper, lower and digit runs as one X, x or 0 each; other characters stand for themselves."""
    kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word[:64])
    return _RUNS.sub(r"\1", kinds)


class Featurizer:
    """Term shares of whole texts; the word cache only saves hashing."""

    def __init__(self) -> None:
        self.cache: dict[str, int] = {}

    def _code(self, word: str) -> int:
        core = _EDGES.sub("", word.lower()) or word
        mark = xxhash.xxh3_64_intdigest(core.encode("utf-8", "replace"))
        return (mark % (1 << 31)) << 16 | xxhash.xxh3_64_intdigest(shape(word).encode("utf-8", "replace")) % SHAPES

    def terms(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of the terms that occur; none for a text without words."""
        words = text.split() if text else []
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        cache = self.cache
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = self._code(w)
        codes = np.array([cache[w] for w in words], dtype=np.int64)
        n = len(codes)
        word, form = codes >> 16, codes & 0xFFFF
        parts = [(np.bincount(word % WORDS, minlength=WORDS), n, WEIGHTS[0]), (np.bincount(form, minlength=SHAPES), n, WEIGHTS[1])]
        pairs = (form[:-1] * 1_000_003 + form[1:] * 7919) % PAIRS
        parts.append((np.bincount(pairs, minlength=PAIRS), max(1, n - 1), WEIGHTS[2]))
        lines = [x for x in text.split("\n") if x.strip()]
        repeats = np.array([(word[1:] == word[:-1]).sum() / n, 1 - len(set(lines)) / max(1, len(lines)), 1 - len(np.unique(word)) / n])
        row = np.concatenate([np.sqrt(c / total) * w for c, total, w in parts] + [np.sqrt(repeats) * WEIGHTS[3]])
        at = np.flatnonzero(row)
        return at.astype(np.int32), row[at].astype(np.float32)


@dataclass(frozen=True)
class Model:
    """The projection, the labelled vectors of length 1, their labels, and the share of label 1."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @classmethod
    def learn(cls, rows: list[tuple[list[int], list[float], float]], rank: int = RANK, seed: int = 5) -> Model:
        prior = float(np.mean([r[2] for r in rows])) if rows else 0.5
        rows = [r for r in rows if len(r[0])]
        table = np.zeros((len(rows), TERMS), np.float32)
        for i, (at, value, _) in enumerate(rows):
            table[i, at] = value
        if not len(rows):
            return cls(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior)
        seen = (table > 0).sum(axis=0)
        weight = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
        table *= weight
        basis = np.random.default_rng(seed).standard_normal((len(rows), min(rank + 16, len(rows)))).astype(np.float32)
        for _ in range(4):  # subspace iteration
            basis, _ = np.linalg.qr(table @ (table.T @ basis))
        _, _, right = np.linalg.svd(basis.T @ table, full_matrices=False)
        projection = weight[:, None] * right[:rank].T
        vectors = _unit(table @ right[:rank].T)
        return cls(projection.astype(np.float32), vectors, np.array([r[2] for r in rows]), prior)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the prior where nothing is near."""
        out = np.full(len(rows), self.prior)
        if not len(self.vectors):
            return out
        near = _unit(rows @ self.projection) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(near, top, axis=1), 0, None).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        known = total > 1e-12
        out[known] = (weight * self.labels[top]).sum(axis=1)[known] / total[known]
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def learned(docs: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """The model from at most ``rows`` labelled documents of the training folds, chosen by hash.

    Labels that are NULL are left out; a document labelled several times counts with the mean.
    """
    train = ~held_out(F.col("doc_id")) if train is None else train
    known = labels.where(train & F.col(label).isNotNull()).groupBy("doc_id").agg(F.avg(label).alias("_y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))

    def run(batches):
        featurizer = Featurizer()
        for batch in batches:
            found = [featurizer.terms(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_y"), pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=["_id", "_y", "at", "value"],
            )

    kind = labels.schema["doc_id"].dataType.simpleString()
    terms = texts.select("_id", "_y", "_text").mapInArrow(run, f"_id {kind}, _y double, at array<int>, value array<float>")
    one = terms.dropDuplicates(["_id", "at", "value"])
    return Model.learn([(r["at"], r["value"], r["_y"]) for r in one.orderBy("_id", "at").limit(rows).collect()])


def scored(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), text: str = "text", prefix: str = "") -> DataFrame:
    """The ``carry`` columns with score (0 to 1, higher: label 1 likelier) of every whole text.

    A text that is NULL or has no words gets the share of label 1 in the training rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([*[f"`{c}` {fields[c]}" for c in carry], f"`{prefix}score` double"])

    def run(batches):
        featurizer = Featurizer()
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(i, BLOCK)
                rows = np.zeros((batch.num_rows, TERMS), np.float32)
                for r, t in enumerate(batch.column("_text").to_pylist()):
                    at, value = featurizer.terms(t)
                    rows[r, at] = value
                scores = shared.value.scores(rows)
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(1, batch.num_columns)] + [pa.array(scores, pa.float64())], names=[*carry, f"{prefix}score"])

    return numbered(docs, text, carry).mapInArrow(run, out)
