"""Near-duplicate documents by an inverted join of MinHash signatures.

Documents with equal shingle sets are one class from the start.  Every class posts its signature
under coordinate-value pairs.  A pair of sets of similarity 0.75 agrees in at least MATCHES of
COORDINATES coordinates (less than one pair in a hundred million fails), so, with the pairs
ordered from rare to common, two such classes share one of their COORDINATES - MATCHES + 1 rarest;
only those are posted, and the common rest is skipped.  Classes that meet under a posting count
their collisions over the whole signature.  What reaches MATCHES forms candidate groups, and links
are confirmed on the full sets within these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored
from eventloom.llm.graph import linked
from eventloom.llm.shingles import Shingler, permutations, signature

COORDINATES = 64
MATCHES = 27
PERCENT = 75
BLOCK_SETS = 256  # classes compared at a time
BLOCK_SHINGLES = 1_000_000  # shingles held at a time
MAX_BROADCAST = 500_000  # rows of 16 bytes; beyond, Spark joins by shuffle


def marks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, n_shingles, set_id, signature) of every row; without words the last two are NULL."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        shingler, (a, b) = Shingler(), permutations(COORDINATES)
        for batch in batches:
            sizes, ids, signs = [], [], []
            for t in batch.column("_text").to_pylist():
                h = shingler.hashes(t)
                sizes.append(len(h))
                ids.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                signs.append(signature(h, a, b).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_hash"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(signs, pa.binary())],
                names=[key, "text_hash", "n_shingles", "set_id", "signature"],
            )

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    return rows.mapInArrow(run, f"`{key}` {kind}, text_hash long, n_shingles long, set_id binary, signature binary")


class Signatures:
    """Rows of one block as a matrix; collisions are counted over all coordinates."""

    def __init__(self, payloads: pa.ChunkedArray):
        self.rows = np.frombuffer(b"".join(payloads.to_pylist()), np.uint32).reshape(len(payloads), COORDINATES)

    def similar(self, one: int, others: np.ndarray) -> np.ndarray:
        return (self.rows[others] == self.rows[one]).sum(axis=1) >= MATCHES


class Sets:
    """Full shingle sets of one block, with the shingles numbered within it."""

    def __init__(self, payloads: pa.ChunkedArray):
        loads = payloads.to_pylist()
        self.size = np.array([len(x) // 8 for x in loads])
        _, self.number = np.unique(np.frombuffer(b"".join(loads), np.uint64), return_inverse=True)
        self.end = np.cumsum(self.size)
        self.mark = np.zeros(len(self.number) + 1, dtype=bool)

    def similar(self, one: int, others: np.ndarray) -> np.ndarray:
        begin = self.end - self.size
        mine = self.number[begin[one] : self.end[one]]
        self.mark[mine] = True
        fits = np.minimum(self.size[others], self.size[one]) * 100 >= PERCENT * np.maximum(self.size[others], self.size[one])
        hit = np.zeros(len(others), dtype=bool)
        for i in np.flatnonzero(fits).tolist():
            o = others[i]
            both = int(np.count_nonzero(self.mark[self.number[begin[o] : self.end[o]]]))
            hit[i] = 100 * both >= PERCENT * (self.size[o] + self.size[one] - both)
        self.mark[mine] = False
        return hit


def postings(classes: DataFrame) -> DataFrame:
    """(group, node): each class under the rarest coordinate-value pairs that others have too."""
    slot = np.arange(COORDINATES, dtype=np.int64) << 32

    def posted(batches):
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            nodes = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), COORDINATES)))
            yield pa.RecordBatch.from_arrays([pa.array((signs.astype(np.int64) | slot).ravel()), nodes], names=["group", "node"])

    pairs = classes.select(F.col("set_id").alias("node"), "signature").mapInArrow(posted, "group long, node binary")
    common = pairs.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    ordered = pairs.join(common, "group").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "group"))).alias("pairs"))
    # Pairs nobody else has are the rarest and link nothing: of the shared ones, all but the
    # MATCHES - 1 most common remain.
    kept = F.size("pairs") - (MATCHES - 1)
    return ordered.where(kept > 0).select("node", F.explode(F.slice("pairs", F.lit(1), kept)).alias("p")).select(F.col("p.group").alias("group"), "node")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, weight, payload): the shingles of the classes in ``wanted`` (node, first_id, first_hash)."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            sets = [shingler.hashes(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(h) for h in sets], pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary())],
                names=["node", "weight", "payload"],
            )

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    one = rows["_hash"].eqNullSafe(wanted["first_hash"]) & rows["_key"].eqNullSafe(wanted["first_id"])
    side = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST else wanted
    found = rows.join(side, one).select("node", "_text").mapInArrow(run, "node binary, weight long, payload binary")
    return found.dropDuplicates(["node"])  # a repeated row stands once


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, n_shingles, group_id, component_id, kept) for every row.

    ``component_id`` is the smallest key reachable over links, ``kept`` says that the row's key is it.
    Texts that are NULL, empty or without words have no shingles, link with nothing and are kept.
    Rows with a NULL key take part; a group of such rows alone has the component NULL and is kept.
    Repeated rows share one component, and all rows with its smallest key are kept.  ``group_id`` names
    the component also where keys are NULL; it is NULL without shingles.
    """
    marked = stored(marks(docs, key, text), "near-marks")
    classes = (
        marked.where("n_shingles > 0")
        .groupBy("set_id")
        .agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "text_hash")).alias("first"), F.min("signature").alias("signature"))
        .select("set_id", F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), "signature")
    )
    classes = stored(classes, "near-classes")
    posts = stored(postings(classes), "near-posts")
    signs = classes.select(F.col("set_id").alias("node"), F.lit(1).alias("weight"), F.col("signature").alias("payload"))
    candidates = linked(posts, signs, Signatures, "near-candidates", BLOCK_SETS, BLOCK_SETS)

    reps = classes.select(F.col("set_id").alias("node"), "first_id", "first_hash")
    wanted = stored(reps.join(candidates.select("node"), "node"), "near-wanted")
    sets = stored(full_sets(docs, wanted, key, text), "near-sets")
    groups = candidates.select(F.col("component").alias("group"), "node")
    found = linked(groups, sets, Sets, "near-links", BLOCK_SETS, BLOCK_SHINGLES)

    named = reps.join(found, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(smallest, "component").select(F.col("node").alias("set_id"), F.col("component").alias("group_id"), "component_id"), "near-named")
    labelled = marked.where("n_shingles > 0").join(named, "set_id").select(key, "text_hash", "n_shingles", "group_id", "component_id")
    empty = marked.where("n_shingles = 0").select(key, "text_hash", "n_shingles", F.lit(None).cast("binary").alias("group_id"), F.col(key).alias("component_id"))
    return labelled.unionAll(empty).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-copy group: that of the smallest key, of the smallest text
    hash among equal keys.  Rows without shingles all stay.  Columns are as they were."""
    flags = stored(near_duplicates(docs, key, text).select(F.col(key).alias("_key"), F.col("text_hash").alias("_hash"), "group_id"), "near-flags")
    row = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("id"), F.col("_hash").alias("hash"))
    best = flags.where("group_id is not null").groupBy("group_id").agg(F.min(row).alias("best"), F.count("*").alias("n")).where("n > 1")
    best = stored(best, "near-best")
    judged = flags.join(best, "group_id").withColumn("wins", row == F.col("best"))
    judged = stored(judged.groupBy("_key", "_hash").agg(F.max("wins").alias("wins"), F.count("*").alias("copies")), "near-judged")
    rest = without(docs, judged.where("not wins"), key, text)
    repeated = judged.where("wins and copies > 1").select("_key", "_hash")
    if repeated.isEmpty():
        return rest
    again = _matching(rest, repeated, key, text, "left_semi")
    single = again.withColumn("_mark", F.xxhash64(text)).dropDuplicates([key, "_mark"]).select(docs.columns)
    return without(rest, repeated, key, text).unionAll(single)


def without(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less the rows named by (_key, _hash): their key and the xxhash64 of their text."""
    return _matching(docs, gone.select("_key", "_hash"), key, text, "left_anti")


def _matching(docs: DataFrame, named: DataFrame, key: str, text: str, how: str) -> DataFrame:
    side = F.broadcast(named) if named.count() <= MAX_BROADCAST else named
    return docs.join(side, docs[key].eqNullSafe(named["_key"]) & F.xxhash64(docs[text]).eqNullSafe(named["_hash"]), how)
