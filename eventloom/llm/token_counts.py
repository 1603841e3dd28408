"""Token counts from an exact length histogram.

Documents are aggregated by encoded length; the histogram is all that later questions need.  Its
suffix sums give, for every context limit, the documents and tokens above it and so the truncated
total; its prefix counts give exact quantiles.  The sums are taken in two levels, so that no task
reads more lengths than one bucket holds.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.bpe import PATTERN, blocks

BUCKET = 4096
BLOCK_CHARS = 4_000_000
_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file; text that looks like a special token is ordinary text."""
    if path not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def lengths(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(n_tokens): the encoded length of every whole text; NULL counts as the empty text."""

    def run(batches: Iterable[pa.RecordBatch]):
        encoder = encoding(path)
        for block in blocks(batches, "_text", BLOCK_CHARS):
            texts = [t or "" for t in block.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(encoder.encode_ordinary(t)) for t in texts], pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(n_tokens, docs): one row per length that occurs."""
    return lengths(docs, path, text).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def suffix_sums(histo: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For every length L that occurs, taken as a context limit:

    docs (of that length), docs_over and tokens_over (documents longer than L and their tokens),
    truncated_tokens (sum of min(length, L) over all documents), total_docs, total_tokens and
    quantile (share of documents of length L at most).  An empty histogram gives no rows.
    """
    tokens = F.col("n_tokens") * F.col("docs")
    rows = histo.select("n_tokens", "docs", tokens.alias("_tokens"), F.floor(F.col("n_tokens") / bucket).alias("_bucket"))
    inner = Window.partitionBy("_bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    buckets = rows.groupBy("_bucket").agg(F.sum("docs").alias("_d"), F.sum("_tokens").alias("_t"))
    above = buckets.select(
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_d").over(outer), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_t").over(outer), F.lit(0)).alias("_tokens_above"),
        F.sum("_d").over(whole).alias("total_docs"),
        F.sum("_t").over(whole).alias("total_tokens"),
    )
    local = rows.select(
        "*",
        F.coalesce(F.sum("docs").over(inner), F.lit(0)).alias("_d_in"),
        F.coalesce(F.sum("_tokens").over(inner), F.lit(0)).alias("_t_in"),
    )
    both = local.join(above, F.col("_bucket") == F.col("_of"))
    docs_over, tokens_over = F.col("_d_in") + F.col("_docs_above"), F.col("_t_in") + F.col("_tokens_above")
    return both.select(
        "n_tokens",
        "docs",
        docs_over.alias("docs_over"),
        tokens_over.alias("tokens_over"),
        (F.col("total_tokens") - tokens_over + docs_over * F.col("n_tokens")).alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
        ((F.col("total_docs") - docs_over) / F.col("total_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens) for any limits, also lengths that do not occur.

    Everything above a limit is cut to it, so the answer comes from the rows above it alone.
    """
    answers = []
    for limit in limits:
        longer = F.col("n_tokens") > limit
        over = F.coalesce(F.sum(F.when(longer, F.col("docs"))), F.lit(0))
        cut = F.coalesce(F.sum(F.when(longer, F.col("docs") * (F.col("n_tokens") - limit))), F.lit(0))
        total = F.coalesce(F.max("total_tokens"), F.lit(0))
        answers.append(F.struct(F.lit(limit).cast("long").alias("context_limit"), over.alias("docs_over"), (total - cut).alias("truncated_tokens")))
    return sums.agg(F.array(*answers).alias("_a")).select(F.inline("_a"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least that share of documents does not exceed."""
    found = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))).alias("n_tokens")) for s in shares]
    return sums.agg(F.array(*found).alias("_q")).select(F.inline("_q"))
