"""Toxicity by a classifier chain.

The categories are columns of the label table, predicted one after the other by linear models over word
occurrences: quality first, then toxic.  The later model also sees the probabilities of all earlier
categories.  In training these are out-of-fold predictions, so that it learns from probabilities as good
as those it will meet.  The threshold is the one with the best F1 among the out-of-fold predictions of
the last category; rows outside the training folds have no part in it.

NULL and empty texts have no words and get what the models say of such a text.  Very long texts are read
whole.  A document labelled several times belongs to a category if any label says so; a NULL earlier
label counts as no.  Repeated rows are each scored; one of them trains.  Without labels, or with one
value only, a model is a constant.  An empty table gives no rows.  Carried columns keep their names:
``prefix`` is put before the new ones where they would clash.
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

CATEGORIES = ("quality", "toxic")  # columns of the labels, in chain order
TRAIN_ROWS = 8000  # bound of the labelled sample
FOLDS = 5
TERMS = 200  # words and word beginnings a model may use
BEGINNINGS = (4, 5)  # letters; they find inflected and compound words
LEAST_DOCS = 8  # documents of the sample a word must occur in
PENALTY = 0.2
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 100_000


def word_set(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def _mark(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) >> 1


def terms(text: str | None) -> set[int]:
    """Marks of the words of a text, and of the beginnings of its longer words."""
    words = word_set(text)
    begun = {w[:n] + "-" for w in words for n in BEGINNINGS if len(w) > n}
    return {_mark(w) for w in words | begun}


@dataclass(frozen=True)
class Linear:
    """A logistic model over selected words and the probabilities of earlier categories."""

    words: np.ndarray  # sorted marks
    weights: np.ndarray
    chain: np.ndarray
    bias: float

    def probability(self, logits: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits + earlier @ self.chain + self.bias, -40, 40)))


def _present(rows: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Which of the sorted words occur in each row."""
    out = np.zeros((len(rows), len(words)), np.float32)
    if len(words):
        for i, row in enumerate(rows):
            at = np.minimum(np.searchsorted(words, row), len(words) - 1)
            out[i, at[words[at] == row]] = 1.0
    return out


def fit(rows: list[np.ndarray], y: np.ndarray, earlier: np.ndarray) -> Linear:
    """Words by their chi-square with the label, then penalised logistic regression by Newton steps."""
    n, positive = len(rows), float(y.sum())
    if positive == 0 or positive == n:  # nothing to learn: a constant
        return Linear(np.empty(0, np.int64), np.empty(0), np.zeros(earlier.shape[1]), 40.0 if positive else -40.0)
    flat, owner = np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows])
    words, inverse = np.unique(flat, return_inverse=True)
    total = np.bincount(inverse, minlength=len(words)).astype(np.float64)
    hits = np.bincount(inverse, weights=y[owner], minlength=len(words))
    expected = total * positive / n
    chi = (hits - expected) ** 2 / np.maximum(expected, 1e-9) / (1 - positive / n)
    able = np.flatnonzero((total >= LEAST_DOCS) & (chi >= 15))
    able = able[np.lexsort((words[able], -chi[able]))][:TERMS]
    chosen = np.sort(words[able])
    x = np.hstack([_present(rows, chosen), earlier, np.ones((n, 1))]).astype(np.float64)
    penalty = np.full(x.shape[1], PENALTY)
    penalty[-1] = 1e-4
    w = np.zeros(x.shape[1])
    w[-1] = np.log(positive / (n - positive))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * penalty @ (w * w))

    at = loss(w)
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty), gradient)
        while (new := loss(w - step)) > at and np.abs(step).max() > 1e-6:
            step /= 2
        w, gain, at = w - step, at - new, new
        if gain < 1e-4 * n**0.5:
            break
    k = len(chosen)
    return Linear(chosen, w[:k], w[k:-1], float(w[-1]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Between the two probabilities where F1 is best; one half where nothing can be told."""
    at = np.argsort(-p, kind="stable")
    p, y = p[at], y[at]
    hits, n = np.cumsum(y), np.arange(1, len(y) + 1)
    ends = np.append(p[1:] < p[:-1], False)  # rows of equal probability fall on one side
    if not ends.any() or not y.any():
        return 0.5
    f1 = np.where(ends, 2 * hits / (n + y.sum()), -1.0)
    cut = int(f1.argmax())
    return float((p[cut] + p[cut + 1]) / 2)


@dataclass(frozen=True)
class Chain:
    """Final models in chain order, over one table of words."""

    models: tuple[Linear, ...]
    marks: np.ndarray
    table: np.ndarray  # weight of each word in each model
    threshold: float  # of the last category

    @classmethod
    def learn(cls, rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> Chain:
        """``labels`` has a column per category; rows of one fold are predicted by the others' model."""
        earlier = np.zeros((len(rows), 0))
        models = []
        threshold = 0.5
        for c in range(labels.shape[1]):
            y = labels[:, c].astype(np.float64)
            out = np.zeros(len(rows))
            for f in sorted(set(folds.tolist())):
                inside, rest = np.flatnonzero(folds == f), np.flatnonzero(folds != f)
                if len(rest):
                    model = fit([rows[i] for i in rest], y[rest], earlier[rest])
                    out[inside] = model.probability(_present([rows[i] for i in inside], model.words) @ model.weights, earlier[inside])
            models.append(fit(rows, y, earlier) if len(rows) else fit([], np.zeros(0), earlier))
            earlier = np.hstack([earlier, out[:, None]])
            threshold = best_threshold(out, y)
        marks = np.unique(np.concatenate([m.words for m in models])) if models else np.empty(0, np.int64)
        table = np.zeros((len(marks), len(models)))
        for c, m in enumerate(models):
            table[np.searchsorted(marks, m.words), c] = m.weights
        return cls(tuple(models), marks, table, threshold)

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        """A column per category from the summed word weights, each fed to the next."""
        out = np.zeros((len(logits), 0))
        for c, model in enumerate(self.models):
            out = np.hstack([out, model.probability(logits[:, c], out)[:, None]])
        return out


def learned(docs: DataFrame, labels: DataFrame, train: Column | None = None, rows: int = TRAIN_ROWS) -> Chain:
    """The chain from at most ``rows`` labelled documents of the training folds, chosen by hash.

    Rows without a label of the last category are left out.  Copies of a text share a fold.
    """
    train = ~held_out(F.col("doc_id")) if train is None else train
    # Bit c says whether any label puts the document into category c.
    bits = [F.when(F.max(F.col(c).cast("double")) != 0, 1 << i).otherwise(0) for i, c in enumerate(CATEGORIES)]
    known = labels.where(train & F.col(CATEGORIES[-1]).isNotNull()).groupBy("doc_id").agg(sum(bits[1:], bits[0]).alias("_y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))

    def run(batches):
        for batch in batches:
            sets = [np.array(sorted(terms(t)), dtype=np.int64).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), batch.column("_fold"), pa.array(sets, pa.binary())], names=["_id", "_y", "_fold", "marks"])

    fold = F.pmod(F.xxhash64("_text"), F.lit(FOLDS)).cast("int").alias("_fold")
    kinds = f"_id {labels.schema['doc_id'].dataType.simpleString()}, _y int, _fold int, marks binary"
    found = texts.select("_id", "_y", fold, "_text").mapInArrow(run, kinds).dropDuplicates(["_id", "_fold"]).orderBy("_id", "_fold").limit(rows).collect()
    sets = [np.frombuffer(r["marks"], dtype=np.int64) for r in found]  # packed: a list of numbers takes several times the memory
    y = np.array([[r["_y"] >> c & 1 for c in range(len(CATEGORIES))] for r in found], dtype=bool).reshape(-1, len(CATEGORIES))
    return Chain.learn(sets, y, np.array([r["_fold"] for r in found], dtype=np.int64))


def scored(docs: DataFrame, chain: Chain, carry: tuple[str, ...] = ("doc_id",), text: str = "text", prefix: str = "") -> DataFrame:
    """The ``carry`` columns with the probability of each category for every whole text.

    A text that is NULL or has no words gets what the models say of a text without any known word.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = [f"{prefix}p_{c}" for c in CATEGORIES]
    out = ", ".join([*[f"`{c}` {fields[c]}" for c in carry], *[f"`{n}` double" for n in names]])
    row_of = {m: i for i, m in enumerate(chain.marks.tolist())}

    def known(word: str) -> tuple[int, ...]:
        begun = [word[:n] + "-" for n in BEGINNINGS if len(word) > n]
        return tuple(row_of[m] for m in map(_mark, (word, *begun)) if m in row_of)

    def run(batches):
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            logits = np.zeros((batch.num_rows, len(CATEGORIES)))
            for i, t in enumerate(batch.column("_text").to_pylist()):
                words = word_set(t)
                if len(cache) > _CACHE_WORDS:
                    cache.clear()
                cache.update((w, known(w)) for w in words if w not in cache)
                hits = set().union(*filter(None, map(cache.__getitem__, words)))
                if hits:
                    logits[i] = chain.table[sorted(hits)].sum(axis=0)
            p = chain.probabilities(logits)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(1, batch.num_columns)] + [pa.array(p[:, c], pa.float64()) for c in range(len(CATEGORIES))], names=[*carry, *names])

    return numbered(docs, text, carry).mapInArrow(run, out)
