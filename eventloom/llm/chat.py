"""Chat formatting with cumulative snapshots collapsed (built-in functions only).

A conversation that is logged again after every turn leaves snapshots, each a prefix of the next.
Every turn gets a rolling hash of the conversation up to it.  A conversation whose whole hash is
the hash of a proper prefix of another is a snapshot and goes, by anti-join; of equal
conversations the smallest id stays.  What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stored

BLOCK = 64  # turn numbers per block of the rolling hash and per rendered part
HASHES = ("h1", "h2")  # two 64-bit hashes with different seeds, read together


def _row_hash(seed: int) -> Column:
    """Of turn, role and text; NULL and empty differ."""
    fields = [x for c in ("turn", "role", "text") for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *fields)


def turn_hashes(rows: DataFrame) -> DataFrame:
    """(conv, turn, h1, h2): one row per conversation and turn; repeated rows count once.

    Rows that tie on a turn are one turn, in whatever order they were logged.
    """
    hashed = rows.select("conv", "turn", *[_row_hash(i).alias(h) for i, h in enumerate(HASHES)]).distinct()
    return hashed.groupBy("conv", "turn").agg(*[F.bit_xor(h).alias(h) for h in HASHES])


def prefix_hashes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, turn, h1, h2, last): the rolling hash up to each turn, in two levels, so that a long
    conversation is spread over tasks and only one row per block of it meets in one."""
    placed = turns.withColumn("block", F.floor(F.coalesce("turn", F.lit(0)) / block))
    inner = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("conv", "block", "turn", *[F.bit_xor(h).over(inner).alias(h) for h in HASHES])
    blocks = placed.groupBy("conv", "block").agg(*[F.bit_xor(h).alias(h) for h in HASHES], F.max("turn").alias("top"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv").orderBy("block").rowsBetween(1, 1)
    ahead = blocks.select(
        F.col("conv").alias("_conv"),
        F.col("block").alias("_block"),
        *[F.coalesce(F.bit_xor(h).over(before), F.lit(0)).alias(f"_{h}") for h in HASHES],
        F.col("top").alias("_top"),
        F.count("*").over(whole).alias("_later"),
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    last = (F.col("_later") == 0) & F.col("turn").eqNullSafe(F.col("_top"))
    return local.join(ahead, same).select("conv", "turn", *[F.col(h).bitwiseXOR(F.col(f"_{h}")).alias(h) for h in HASHES], last.alias("last"))


def maximal(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, copies): the conversations that are no proper prefix of another, one per set of equal
    ones (the smallest id), and how many equal ones there were."""
    prefixes = stored(prefix_hashes(turn_hashes(_named(conversations, key, turn, role, text))), "chat-prefixes")
    proper = prefixes.where("not last").select(*HASHES).distinct()
    whole = prefixes.where("last").groupBy(*HASHES).agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    return whole.join(proper, list(HASHES), "left_anti").select("conv", "copies")


def _named(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    return conversations.select(F.col(key).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))


def formatted(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, part, copies, n_turns, chat): the maximal conversations, rendered turn by turn.

    A conversation of more than ``block`` turn numbers has several parts, to be read one after the
    other, so that no part grows with its length.  Rows of one turn are rendered by role and text,
    repeated rows once.  A NULL turn comes first; NULL roles and texts are rendered as empty; rows with
    a NULL key are one conversation.  An empty table gives no rows.
    """
    kept = stored(maximal(conversations, key, turn, role, text).select(F.col("conv").alias("_conv"), "copies"), "chat-kept")
    rows = _named(conversations, key, turn, role, text)
    rows = rows.join(kept, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv").distinct()
    part = F.floor(F.coalesce("turn", F.lit(0)) / block).alias("part")
    said = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy("conv", part, "copies").agg(F.sort_array(F.collect_list(said)).alias("said"))
    line = F.transform("said", lambda s: F.concat(F.lit("<|"), s["role"], F.lit("|>\n"), s["text"], F.lit("\n<|end|>\n")))
    return grouped.select(F.col("conv").alias(key), "part", "copies", F.size("said").cast("long").alias("n_turns"), F.array_join(line, "").alias("chat"))
