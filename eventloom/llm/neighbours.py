"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes of BITS bits: the signs of their coordinates after rotations learned on
a sample so that signs lose little (iterative quantisation).  A code is split into TABLES substrings
and each shard of the index has a table per substring.  Two codes within a Hamming radius r have a
substring within r // TABLES of each other, so looking up all buckets that near in every table
retrieves every code within the radius; their vectors are then ranked by inner product.

The radius of a query follows from its neighbours: a first visit to the shard of its own code widens
the radius until enough vectors are ranked; the inner product of the last of them bounds what is
still worth finding, and the sample says how many bits vectors of that inner product differ in.
Within this radius all shards are then searched.

For inner products of vectors of different lengths each vector gets one more coordinate that brings
it to the length of its band (lengths within a factor of two), which turns the largest inner product
into the smallest angle; bands are shards of their own.  Equal vectors are one entry.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import hashed_sample, stored

NEAREST = 20
BITS = 256
TABLES = 16
WIDTH = BITS // TABLES  # bits of a substring: two bytes
SHARD_ROWS = 16_384
SHARD_BYTES = 1 << 24
SAMPLE_ROWS = 4096  # vectors per length that rotations and radii are learned on
SAMPLE_BYTES = 1 << 25
CODER_BYTES = 1 << 26  # of all rotations together; vectors of rarer lengths are searched whole
FOUND = 0.95  # share of vectors at the bound that the radius has to hold
STEPS = 30
GRID = 64
SEED = 12
_POPULATION = np.array([bin(i).count("1") for i in range(1 << WIDTH)], dtype=np.uint8)


def population(codes: np.ndarray) -> np.ndarray:
    """Set bits per row of 16-bit substrings."""
    return _POPULATION[codes].sum(axis=1, dtype=np.int64)


@lru_cache
def masks(radius: int) -> np.ndarray:
    """All substrings of at most ``radius`` set bits."""
    return np.flatnonzero(_POPULATION <= radius).astype(np.uint16)


def marks(vectors: DataFrame, asked: Column, key: str, embedding: str) -> DataFrame:
    """(_key, _asked, node, dim, size, payload): the class of equal vectors, the logarithm of their length, doubles."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            nodes, dims, sizes, loads = [], [], [], []
            for v in batch.column("_vector").to_pylist():
                x = np.array(v, dtype=np.float64) + 0.0 if v and None not in v else np.empty(0)
                top = np.abs(x).max() if len(x) else 0.0
                good = bool(len(x)) and bool(np.isfinite(top)) and top > 0
                load = x.tobytes() if good else None
                nodes.append(xxhash.xxh3_128_digest(load) if good else None)
                dims.append(len(x) if good else None)
                sizes.append(float(np.log2(top) + np.log2(((x / top) ** 2).sum()) / 2) if good else None)
                loads.append(load)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_asked"), pa.array(nodes, pa.binary()), pa.array(dims, pa.int32()), pa.array(sizes, pa.float64()), pa.array(loads, pa.binary())],
                names=["_key", "_asked", "node", "dim", "size", "payload"],
            )

    rows = vectors.select(F.col(key).alias("_key"), F.coalesce(asked, F.lit(False)).alias("_asked"), F.col(embedding).alias("_vector")).where("_key is not null")
    return rows.mapInArrow(run, f"_key {kind}, _asked boolean, node binary, dim int, size double, payload binary").where("node is not null")


def directions(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1 and a coordinate of 0 added: a query on the sphere of any band."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.concatenate((x, np.zeros((len(x), 1))), axis=1)


def raised(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Vectors over the longest length of their band (``sizes``: logarithms of what is left of them), brought
    to length 1 by one more coordinate."""
    flat = directions(x)
    short = np.exp2(np.minimum(sizes, 0.0))
    flat *= short[:, None]
    flat[:, -1] = np.sqrt(np.maximum(0.0, 1.0 - short * short))
    return flat


class Coder:
    """Rotations whose signs are the code, and the radius that holds vectors of a given inner product."""

    def __init__(self, sample: np.ndarray, sizes: np.ndarray):
        x, q = raised(sample, sizes), directions(sample)
        width = x.shape[1]
        rng = np.random.default_rng((SEED, width))
        main = np.linalg.svd(x, full_matrices=False)[2][:BITS].T
        # The main axes of the sample, then directions at random where it has too few.
        axes = np.linalg.qr(np.concatenate((main, rng.standard_normal((width, width))), axis=1))[0][:, : min(BITS, width)]
        flat = x @ axes
        parts = []
        while sum(p.shape[1] for p in parts) < BITS:
            turn = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0]
            for _ in range(STEPS):  # alternate: nearest corners, then the rotation nearest to them
                u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
                turn = (u @ v).T
            parts.append(axes @ turn)
        self.planes = np.concatenate(parts, axis=1)[:, :BITS]
        # Partners of the sample at every inner product, away from it as its members differ from each other.
        others = q[rng.permutation(len(q))]
        away = others - (others * q).sum(axis=1, keepdims=True) * q
        away += 1e-9 * rng.standard_normal(away.shape)
        away -= (away * q).sum(axis=1, keepdims=True) * q
        away /= np.sqrt((away * away).sum(axis=1, keepdims=True))
        self.cosines = np.linspace(-1.0, 1.0, GRID + 1)
        mine = self.codes(q)
        radii = [np.quantile(population(mine ^ self.codes(c * q + np.sqrt(1 - c * c) * away)), FOUND, method="higher") for c in self.cosines]
        self.radii = np.maximum.accumulate(np.array(radii)[::-1])[::-1]

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = np.packbits(x @ self.planes >= 0, axis=1, bitorder="little")
        return bits.view(np.uint16)

    def radius(self, cosine: float) -> int:
        """Bits in which vectors of this cosine or more differ from the query, but for 1 - FOUND of them."""
        if not cosine > -1:
            return BITS
        at = np.searchsorted(self.cosines, cosine, side="right") - 1
        return int(self.radii[min(at, GRID)])


class Shard:
    """Multi-index of the codes of one shard: per substring the entries ordered by it."""

    def __init__(self, codes: np.ndarray, vectors: np.ndarray, first: np.ndarray):
        self.codes, self.vectors, self.first = codes, vectors, first
        self.order = [np.argsort(codes[:, t], kind="stable") for t in range(TABLES)]
        self.values, self.starts = [], []
        for t in range(TABLES):
            v, s = np.unique(codes[self.order[t], t], return_index=True)
            self.values.append(v)
            self.starts.append(np.append(s, len(codes)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every entry whose code is within ``radius``: by the pigeonhole principle one of its first
        radius % TABLES + 1 substrings differs in radius // TABLES bits at most or another in one less."""
        if radius >= BITS:
            return np.arange(len(self.codes))
        hit = np.zeros(len(self.codes), dtype=bool)
        for t in range(TABLES):
            near = radius // TABLES - (t > radius % TABLES)
            if near < 0:
                continue
            values, starts = self.values[t], self.starts[t]
            probes = masks(near) if near <= 3 else None
            if probes is not None and len(probes) < len(values):
                at = np.searchsorted(values, probes ^ code[t])
                at[at == len(values)] = 0
                at = at[values[at] == probes ^ code[t]]
            else:  # fewer buckets than probes: look which are near
                at = np.flatnonzero(_POPULATION[values ^ code[t]] <= near)
            begin, size = starts[at], starts[at + 1] - starts[at]
            flat = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            hit[self.order[t][flat]] = True
        found = np.flatnonzero(hit)
        return found[population(self.codes[found] ^ code) <= radius]

    def ranked(self, entries: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of the largest inner product, ties by their first row."""
        scores = (self.vectors[entries] * query).sum(axis=1)
        if len(entries) > 4 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            entries, scores = entries[scores >= least], scores[scores >= least]
        order = np.lexsort((self.first[entries], -scores))[:k]
        return entries[order], scores[order]


def _shards(batches, keys: list[str]):
    """(index, ids, classes, some queries) for the shards of a sorted partition; index rows come first."""
    key, held, shard = None, [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        side = batch.column("side").to_pylist()
        cuts = [i for i in range(len(rows)) if i == 0 or rows[i] != rows[i - 1] or side[i] != side[i - 1]]
        for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True):
            part = batch.slice(a, b - a)
            if rows[a] != key:
                key, held, shard = rows[a], [], None
            if side[a] == 0:
                held.append(part)
            elif held:
                if shard is None:
                    shard = _shard(pa.Table.from_batches(held))
                yield *shard, part


def _matrix(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _shard(rows: pa.Table) -> tuple[Shard, list, list]:
    """The index of one shard, the ids and the class of each entry."""
    nodes, first = rows.column("node").to_pylist(), rows.column("first_id").to_pylist()
    rank = np.empty(len(first), dtype=np.int64)
    rank[sorted(range(len(first)), key=first.__getitem__)] = np.arange(len(first))
    return Shard(_matrix(rows.column("code"), np.uint16), _matrix(rows.column("payload"), np.float64), rank), rows.column("ids").to_pylist(), nodes


def learned(classes: DataFrame) -> dict[int, Coder]:
    """A coder per vector length, from at most SAMPLE_ROWS vectors of it and SAMPLE_BYTES (taken in hash order);
    commoner lengths first, as long as CODER_BYTES last."""
    coders, spent = {}, 0
    counts = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(CODER_BYTES // (8 * BITS))
    for r in counts.collect():
        spent += 8 * BITS * (r.dim + 1)
        if r.n < 2 or spent > CODER_BYTES:
            continue
        rows = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * r.dim)))
        sample = hashed_sample(classes.where(F.col("dim") == r.dim).select("node", "payload", "short"), rows, by=F.col("node")).collect()
        coders[r.dim] = Coder(np.frombuffer(b"".join(s.payload for s in sample), np.float64).reshape(-1, r.dim), np.array([s.short for s in sample]))
    return coders


CELL = ["dim", "band", "prefix", "block"]


def cosine(score: float, size: float, longest: float) -> float:
    """The score over the lengths of the query and of its longest partner, both as logarithms."""
    with np.errstate(over="ignore", invalid="ignore"):
        return float(score * np.exp2(-size) * np.exp2(-longest))


def coded(rows: DataFrame, coders, query: bool) -> DataFrame:
    """``rows`` with their ``code`` and its first bits as ``low``; lengths without a coder have code 0."""
    names = [c for c in rows.columns]
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", code binary, low int"

    def run(batches):
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            codes = np.zeros((batch.num_rows, TABLES), dtype=np.uint16)
            for dim in np.unique(dims).tolist():
                if dim in coders.value:
                    at = np.flatnonzero(dims == dim)
                    part = batch.take(pa.array(at))
                    x = _matrix(part.column("payload"), np.float64)
                    codes[at] = coders.value[dim].codes(directions(x) if query else raised(x, np.array(part.column("short").to_pylist())))
            low = pa.array(codes[:, 0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), low], names=[*names, "code", "low"])

    return rows.mapInArrow(run, schema)


def nearest(vectors: DataFrame, asked: Column, k: int = NEAREST, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query, rank, key, score): for every row that ``asked`` selects its ``k`` nearest rows by inner product in
    double precision, nearest first, ties by the smaller id; all others, if there are fewer.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do rows without
    an id.  Vectors of different lengths never meet.  A repeated row counts once; another vector under the same
    id is another row, and a query of its own.  An empty table gives an empty one; other columns are ignored.
    A query meets every vector within its radius; how many of the true nearest that finds is tested.
    """
    kind = vectors.schema[key].dataType.simpleString()
    session = vectors.sparkSession
    marked = stored(marks(vectors, asked, key, embedding).dropDuplicates(["node", "_key"]), "neighbour-marks")
    first = marked.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy("_key"))).where(F.col("_n") <= k + 1)
    classes = first.groupBy("node").agg(
        F.min("_key").alias("first_id"), F.sort_array(F.collect_list("_key")).alias("ids"),
        F.first("dim").alias("dim"), F.floor(F.first("size") + 0.5).cast("int").alias("band"), F.first("size").alias("size"), F.first("payload").alias("payload"),
    )
    classes = stored(classes, "neighbour-classes")
    rows = F.least(F.lit(SHARD_ROWS), F.greatest(F.lit(64), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8)))).cast("int")
    bits = F.least(F.lit(WIDTH), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.col("rows"))))).cast("int")
    bands = classes.groupBy("dim", "band").agg(F.count("*").alias("n"), F.max("size").alias("longest")).withColumn("rows", rows).withColumn("bits", bits)
    bands = stored(bands.drop("n"), "neighbour-bands")
    sized = classes.join(bands, ["dim", "band"]).withColumn("short", F.col("size") - F.col("longest"))
    coders = session.sparkContext.broadcast(learned(sized))

    most = F.expr("shiftleft(1, bits) - 1")

    def front(low: str) -> Column:
        """The first bits of a code, as many as the shards of its band are told apart by."""
        return F.col(low).bitwiseAND(most)

    index = coded(sized.select("node", "first_id", "ids", "dim", "band", "rows", "bits", "short", "payload"), coders, query=False)
    index = stored(index.withColumn("prefix", front("low")).select("dim", "band", "prefix", "rows", "node", "first_id", "ids", "code", "payload"), "neighbour-index")
    shards = index.groupBy("dim", "band", "prefix").agg(F.ceil(F.count("*") / F.max("rows") / 2).cast("int").alias("cuts"))
    shards = stored(shards, "neighbour-shards")
    placed = index.join(shards, CELL[:3]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    placed = placed.select(*CELL, F.lit(0).alias("side"), "node", "first_id", "ids", "code", "payload", F.lit(0).alias("radius"), F.lit(0.0).alias("longest"), F.lit(0.0).alias("size"))

    asking = marked.where("_asked").select("node").distinct().join(classes.select("node", "dim", "size", "payload"), "node")
    queries = stored(coded(asking, coders, query=True), "neighbour-queries")

    def visited(visits: DataFrame) -> DataFrame:
        loads = visits.select("node", *CELL, "radius", "longest").join(queries.select("node", "code", "payload", "size"), "node")
        none = [F.lit(None).cast(kind).alias("first_id"), F.lit(None).cast(f"array<{kind}>").alias("ids")]
        loads = loads.select(*CELL, F.lit(1).alias("side"), "node", *none, "code", "payload", "radius", "longest", "size")
        return placed.unionAll(loads).repartition(*CELL).sortWithinPartitions(*CELL, "side")

    def close(batches):
        """The scores of the nearest entries that the shard of a query's own code holds."""
        for shard, _, _, part in _shards(batches, CELL):
            codes, x = _matrix(part.column("code"), np.uint16), _matrix(part.column("payload"), np.float64)
            coder = coders.value.get(x.shape[1])
            sizes = zip(part.column("size").to_pylist(), part.column("longest").to_pylist(), strict=True)
            nodes, out = part.column("node").to_pylist(), []
            for q, (size, longest) in enumerate(sizes):
                radius, found = TABLES - 1, shard.within(codes[q], TABLES - 1)
                while len(found) <= k and radius < BITS:
                    radius = min(BITS, radius + TABLES)
                    found = shard.within(codes[q], radius)
                _, scores = shard.ranked(found, x[q], k + 1)
                if coder is not None and len(scores) > k:  # what was found bounds what is still worth finding
                    wider = coder.radius(cosine(scores[-1], size, longest))
                    if wider > radius:
                        _, scores = shard.ranked(shard.within(codes[q], wider), x[q], k + 1)
                out += [(nodes[q], float(s)) for s in scores]
            if out:
                n, s = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.binary()), pa.array(s, pa.float64())], names=["node", "score"])

    zero = F.lit(0).alias("radius")
    home = queries.join(bands, "dim").withColumn("prefix", front("low")).join(shards, CELL[:3]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    seen = visited(home.select("node", *CELL, zero, "longest")).mapInArrow(close, "node binary, score double")
    bound = seen.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score")))).where(F.col("_n") == k + 1).select("node", F.col("score").alias("bound"))

    def widths(batches):
        """The radius per query and band; -1 where no vector is long enough to reach the bound."""
        for batch in batches:
            radii = []
            for dim, score, size, longest in zip(*(batch.column(c).to_pylist() for c in ("dim", "bound", "size", "longest")), strict=True):
                least = float("nan") if score is None or dim not in coders.value else cosine(score, size, longest)
                radii.append(BITS if np.isnan(least) else -1 if least > 1 + 1e-9 else coders.value[dim].radius(least))
            kept = ["node", "dim", "band", "bits", "longest", "low"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(radii, pa.int32())], names=[*kept, "radius"])

    reach = queries.select("node", "dim", "size", "low").join(bound, "node", "left").join(bands, "dim")
    reach = reach.mapInArrow(widths, "node binary, dim int, band int, bits int, longest double, low int, radius int").where("radius >= 0")
    fronts = F.filter(F.sequence(F.lit(0), most), lambda p: F.bit_count(p.bitwiseXOR(front("low"))) <= F.col("radius"))
    visits = reach.withColumn("prefix", F.explode(fronts)).join(shards, CELL[:3]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))

    def search(batches):
        """The nearest rows among all entries of a shard within the radius of each query."""
        for shard, ids, entries, part in _shards(batches, CELL):
            codes, x = _matrix(part.column("code"), np.uint16), _matrix(part.column("payload"), np.float64)
            out = []
            for q, (node, radius) in enumerate(zip(part.column("node").to_pylist(), part.column("radius").to_pylist(), strict=True)):
                at, scores = shard.ranked(shard.within(codes[q], radius), x[q], k + 1)
                found = sorted((-s, i, entries[e] == node) for e, s in zip(at.tolist(), scores.tolist(), strict=True) for i in ids[e])
                out += [(node, i, -s, own) for s, i, own in found[: k + 1]]
            if out:
                n, i, s, own = zip(*out, strict=True)
                kinds = (pa.binary(), part.schema.field("first_id").type, pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((n, i, s, own), kinds, strict=True)], names=["node", "id", "score", "own"])

    found = visited(visits).mapInArrow(search, f"node binary, id {kind}, score double, own boolean")
    found = found.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "id"))).where(F.col("_n") <= k + 1)
    best = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score", "own"))).alias("_found"))
    asked_rows = marked.where("_asked").select("node", F.col("_key").alias("query")).join(best, "node")
    others = F.slice(F.filter("_found", lambda r: ~(r["own"] & (r["id"] == F.col("query")))), 1, k)
    listed = asked_rows.select("query", F.posexplode(others).alias("_at", "_hit"))
    return listed.select("query", (F.col("_at") + 1).alias("rank"), F.col("_hit.id").alias(key), F.col("_hit.score").alias("score"))
