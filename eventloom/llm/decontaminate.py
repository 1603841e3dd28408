"""Benchmark decontamination by spaced-seed hashing (built-in functions only).

Tokens are hashed once, and every window of SPAN tokens once per mask; a mask ignores fixed positions, so a hash
survives substitutions there.  Hashes of all document windows meet those of all test-item windows
in a join.  Around each hit the aligned tokens are compared: a document leaks an item when, in some
stretch of REACH aligned tokens (the whole item, if shorter), at least SHARE of them agree.

However many items there are, the documents are read once.  Their windows first pass a filter of a
few bytes a seed, of bounded size; what it wrongly lets through, more in a larger table of items,
meets no seed.  Hashes lead to item windows, and only these carry tokens.  Both are broadcast up to
SEED_ROWS hashes; beyond, the windows left are joined by sorting, which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored

SPAN = 9
# Token offsets that count; the others may differ.  Together they hit every stretch of SPAN to REACH
# tokens in which SHARE of the tokens agree (a test enumerates all substitutions).
MASKS = (
    (0, 1, 3, 5, 6, 8), (0, 2, 3, 4, 7, 8), (0, 1, 2, 5, 7, 8), (1, 4, 5, 6, 7, 8),
    (0, 1, 3, 4, 5, 7), (0, 1, 2, 3, 4, 8), (0, 2, 3, 5, 6, 7), (0, 3, 4, 5, 6, 8),
)
REACH = 15
SHARE = 0.8
BEFORE = 6  # aligned tokens looked at before a hit; REACH from it onwards
SEED_ROWS = 400_000
LANES = 7  # of a row of the filter, 64 bits each; a seed sets one bit in each
LANE_SEEDS = 16  # seeds a row, as long as the rows are few enough
FILTER_BITS = 20  # at most so many bits number the rows
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; NULL has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _hashed(df: DataFrame, words: str) -> DataFrame:
    """With _hashes: the hash of each token."""
    return df.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))


def _seed(hashes: Column, at: Column, mask: Column) -> Column:
    """The hash of the unmasked tokens of the window at ``at``.  Offsets are looked up: written out for
    every mask, the generated method would be too long for the JVM to compile."""
    offsets = F.array(*[F.lit(k) for m in MASKS for k in m])
    return F.xxhash64(mask, *[F.get(hashes, at + F.get(offsets, mask * len(MASKS[0]) + i)) for i in range(len(MASKS[0]))])


def _windows(df: DataFrame, words: str) -> DataFrame:
    """One row per window: _at."""
    last = F.size(words) - SPAN
    return df.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_at"))


def _seeds(windows: DataFrame, at: Column) -> DataFrame:
    """One row per window and mask: _seed."""
    masks = windows.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(MASKS))])).alias("_mask"))
    return masks.withColumn("_seed", _seed(F.col("_hashes"), at, F.col("_mask"))).drop("_mask")


def _around(words: str, at: Column) -> Column:
    """The tokens from BEFORE tokens before ``at`` to the end of its REACH; NULL outside."""
    return F.array(*[F.get(words, at + k) for k in range(-BEFORE, REACH)])


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """The windows of the distinct item texts, each with the tokens around it and the agreement it needs."""
    distinct = (
        items.select(F.col(key).alias("_item"), tokens(F.col(text)).alias("_item_words"))
        .groupBy("_item_words")
        .agg(F.min("_item").alias("_item"))
    )
    need = F.ceil(F.least(F.size("_item_words"), F.lit(REACH)) * F.lit(SHARE)).cast("int")
    placed = _windows(distinct, "_item_words")
    return placed.select(F.monotonically_increasing_id().alias("_window"), "_item", _around("_item_words", F.col("_at")).alias("_around"), need.alias("_need"))


def _bit(lane: int) -> Column:
    return F.shiftrightunsigned("_seed", 6 * lane).bitwiseAND(F.lit(63)).cast("int")


def _passing(rows: DataFrame, seeds: DataFrame, n_seeds: int) -> DataFrame:
    """``rows`` less those whose _seed is surely none of ``seeds``: the first bits of a seed number a row of
    the filter, the others one bit in each lane of it."""
    bits = min(FILTER_BITS, max(1, (n_seeds // LANE_SEEDS).bit_length()))
    row = F.shiftrightunsigned("_seed", 64 - bits).alias("_row")
    marks = seeds.select(row, *[F.call_function("shiftleft", F.lit(1).cast("long"), _bit(i)).alias(f"_lane{i}") for i in range(LANES)])
    kept = marks.groupBy("_row").agg(*[F.bit_or(f"_lane{i}").alias(f"_lane{i}") for i in range(LANES)])
    met = rows.select("*", row).join(F.broadcast(kept), "_row")
    for i in range(LANES):
        met = met.where(F.getbit(F.col(f"_lane{i}"), _bit(i)) == 1)
    return met.select(rows.columns)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text", seed_rows: int = SEED_ROWS) -> DataFrame:
    """One row per document and leaked item: key, item_key, matched_tokens (the best stretch), n_hits.

    Items with the same tokens count as the smallest of their ids; texts of fewer than SPAN tokens
    have no window and never match.  Rows that repeat a key count as one document; a NULL key is a
    key of its own.  An item row with a NULL id is kept under NULL.  Clean documents have no row.
    """
    windows = stored(item_windows(items, item_key, text), "item-windows")
    seeds, n_seeds = _seeds(_hashed(windows, "_around"), F.lit(BEFORE)).select("_seed", "_window"), windows.count() * len(MASKS)
    # The one-element explode makes the tokens a value of its own: else generated code would split
    # the text again for every window.
    base = docs.select(F.col(key).alias("_doc"), F.explode(F.array(tokens(F.col(text)))).alias("_words"))
    left = _passing(_seeds(_windows(_hashed(base, "_words"), "_words"), F.col("_at")), seeds, n_seeds).select("_doc", "_seed", _around("_words", F.col("_at")).alias("_near"))

    def side(part: DataFrame) -> DataFrame:
        return F.broadcast(part) if n_seeds <= seed_rows else part.hint("merge")

    met = left.join(side(seeds), "_seed").join(side(windows), "_window")
    hits = met.select("_doc", "_item", "_need", F.zip_with("_near", "_around", lambda a, b: a == b).alias("_same"))
    stretches = F.transform(F.sequence(F.lit(1), F.lit(BEFORE + 1)), lambda i: F.size(F.filter(F.slice("_same", i, REACH), lambda e: e)))
    hits = hits.select("_doc", "_item", "_need", F.array_max(stretches).alias("_matched"))
    return (
        hits.groupBy("_doc", "_item", "_need")
        .agg(F.max("_matched").cast("long").alias("matched_tokens"), F.count("*").alias("n_hits"))
        .where(F.col("matched_tokens") >= F.col("_need"))
        .drop("_need")
        .withColumnsRenamed({"_doc": key, "_item": item_key})
    )
