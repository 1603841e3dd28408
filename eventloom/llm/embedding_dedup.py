"""Near-duplicate embeddings by sorted projection passes.

In each pass every vector gets a key of concatenated random hashes; a hash is the number of the pivot with the
largest projection in a random set of pivots, which are drawn from the vectors themselves, so that dense regions
get more of them.  All vectors are ordered lexicographically by that key, and each is compared with those up to
a window away in the order.  Verified pairs of all passes are united.  The number of pivots follows from the
number of vectors, so that about half a window shares the first two hashes; later hashes order what shares them.
The number of passes follows from a measurement: partners at the threshold are made for some vectors, and passes
are added until the share of partners that never share the first two hashes is below MISSED.  Where MOST passes
do not reach that, there are fewer pivots and wider windows, up to one window, which is exact.  Inside the united
components all pairs are then counted exactly, in blocks.  Equal vectors are one class from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import hashed_sample, starts, stored, whole_groups
from eventloom.llm.graph import EDGE, components

COSINE = 0.9
MISSED = 1e-3  # of the pairs at the threshold
PASSES = 8  # at least
MOST = 64
WINDOW = 1024  # rows either side in the order, at most while MOST passes do
NARROW = 64  # and at least
SHARE = 8  # a window is no more than this part of the rows otherwise
BLOCK = 1024
POOL = 4096  # vectors that pivots and probes are drawn from
POOL_BYTES = 1 << 26  # of all vector lengths together
GROUP = 8  # windows that one task compares at a time
LATER = (8, 8)  # pivots of the hashes that order the rows which share the first two
SEED = 11


def marks(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(key, node, dim, payload): the class of equal vectors and the vector in doubles, scaled to 1.

    NULL vectors, those with NULL or non-finite components and those of length 0 have NULLs there.
    """
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            nodes, dims, loads = [], [], []
            for v in batch.column("_vector").to_pylist():
                x = np.array(v, dtype=np.float64) if v and None not in v else np.empty(0)
                top = np.abs(x).max() if len(x) else 0.0
                if len(x) and np.isfinite(top) and top > 0:
                    x = x / top  # large and tiny components neither overflow nor vanish
                    x = x / np.sqrt(x @ x) + 0.0
                    nodes.append(xxhash.xxh3_128_digest(x.tobytes()))
                    dims.append(len(x))
                    loads.append(x.tobytes())
                else:
                    nodes.append(None)
                    dims.append(None)
                    loads.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(nodes, pa.binary()), pa.array(dims, pa.int32()), pa.array(loads, pa.binary())], names=[key, "node", "dim", "payload"]
            )

    rows = vectors.select(F.col(key).alias("_key"), F.col(embedding).alias("_vector"))
    return rows.mapInArrow(run, f"`{key}` {kind}, node binary, dim int, payload binary")


def matrix(payloads: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(payloads), np.float64).reshape(-1, dim)


@dataclass(frozen=True)
class Order:
    """How vectors of one length are ordered: the pivots, and per pass the pivots of each hash."""

    pool: np.ndarray
    sets: tuple[tuple[np.ndarray, ...], ...]
    window: int

    def hashes(self, x: np.ndarray, which: int) -> np.ndarray:
        """One row per vector: the hashes of a pass, in the order in which they are concatenated."""
        return np.stack([(x @ self.pool[s].T).argmax(axis=1) for s in self.sets[which]], axis=1).astype(">u2")


def order(pool: np.ndarray, rows: int, window: int, least: int) -> Order:
    """Pivots, passes and window for ``rows`` vectors, of which ``pool`` is a sample."""
    rng = np.random.default_rng((SEED, pool.shape[1]))
    window = max(NARROW, min(window, rows // SHARE))
    # Probes are no pivots: a pivot and its partner would meet too often.
    probes, pool = pool[1::2], pool[::2]
    size = min(int(np.ceil(np.sqrt(2 * rows / window))), len(pool))
    away = rng.standard_normal(probes.shape)
    away -= (away * probes).sum(1, keepdims=True) * probes
    away /= np.maximum(np.sqrt((away * away).sum(1, keepdims=True)), 1e-300)
    partners = COSINE * probes + np.sqrt(1 - COSINE * COSINE) * away
    while size > 1 and len(probes):
        # With a bounded pool the hashes cannot be finer than its pivots: the window then follows the runs.
        wide = max(window, int(np.ceil(2 * rows / (size * size))))
        sets: list[tuple[np.ndarray, ...]] = []
        apart = np.ones(len(probes), dtype=bool)
        for p in range(MOST):
            sets.append(tuple(rng.choice(len(pool), min(n, len(pool)), replace=False) for n in (size, size, *LATER)))
            one = Order(pool, (sets[p][:2],), wide)
            apart &= (one.hashes(probes, 0) != one.hashes(partners, 0)).any(axis=1)
            if p + 1 >= least and apart.mean() < MISSED:
                return Order(pool, tuple(sets), wide)
        size = size * 3 // 4
    return Order(pool[:1], ((np.zeros(1, dtype=np.int64),),), max(rows, 1))


def orders(classes: DataFrame, passes: int, window: int) -> dict[int, Order]:
    """Per vector length the order of its passes, from a bounded sample of the vectors."""
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = {}
    for dim, rows in sorted(sizes.items()):
        size = max(2, min(POOL, POOL_BYTES // (8 * dim * len(sizes))))
        sample = hashed_sample(classes.where(F.col("dim") == dim).select("node", "payload"), size, by=F.col("node"))
        found[dim] = order(matrix([r.payload for r in sample.select("payload").collect()], dim), rows, window, passes)
    return found


def ranked(classes: DataFrame, plans: dict[int, Order]) -> DataFrame:
    """(dim, pass, rank, node): the place of every class in each pass, counted over all passes."""
    sent = classes.sparkSession.sparkContext.broadcast(plans)

    def run(batches):
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            for dim in sorted(set(dims.tolist())):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x, plan = matrix(part.column("payload").to_pylist(), dim), sent.value[dim]
                for p in range(len(plan.sets)):
                    keys = [h.tobytes() for h in plan.hashes(x, p)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("dim"), pa.array(np.full(len(x), p, np.int32)), pa.array(keys, pa.binary()), part.column("node")], names=["dim", "pass", "key", "node"]
                    )

    keyed = stored(classes.select("node", "dim", "payload").mapInArrow(run, "dim int, pass int, key binary, node binary"), "vector-keys")
    by = ["dim", "pass", "key", "node"]
    placed = stored(keyed.repartitionByRange(*by).sortWithinPartitions(*by).select("dim", "pass", "node", F.monotonically_increasing_id().alias("at")), "vector-order")
    # The number is the task and, below it, the row of the task; one row per task makes ranks of them.
    task = F.shiftright("at", 33)
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("at") - F.shiftleft("task", 33)
    return placed.withColumn("task", task).join(F.broadcast(before), "task").select("dim", "pass", rank.alias("rank"), "node")


def window_links(classes: DataFrame, plans: dict[int, Order]) -> DataFrame:
    """(a, b): links between classes within a window of each other; of those that connect the same
    classes once more only some.

    The order is cut into groups of several windows; a group also gets the first window of the next
    one, so that every pair within a window meets in one task, and no task holds more than a group.
    """
    spread = classes.sparkSession.createDataFrame([(d, o.window) for d, o in sorted(plans.items())], "dim int, window long")
    rows = ranked(classes, plans).join(F.broadcast(spread), "dim")
    step = F.col("window") * GROUP
    group = F.floor(F.col("rank") / step)
    homes = F.when((F.col("rank") % step < F.col("window")) & (group > 0), F.array(group, group - 1)).otherwise(F.array(group))
    posted = rows.select("dim", "pass", F.explode(homes).alias("group"), "rank", "window", "node")
    met = posted.join(classes.select("node", "payload"), "node").repartition("dim", "pass", "group").sortWithinPartitions("dim", "pass", "group", "rank")

    def run(batches):
        for table in whole_groups(batches, ["dim", "pass", "group"]):
            nodes, loads = table.column("node").to_pylist(), table.column("payload").to_pylist()
            edges = [*starts(table, ["dim", "pass", "group"]), table.num_rows]
            for i, j in zip(edges, edges[1:]):
                x = matrix(loads[i:j], table.column("dim")[i].as_py())
                links = _near_rows(x, table.column("window")[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i + k] for k in side], pa.binary()) for side in links], names=["a", "b"])

    return met.select("dim", "pass", "group", "rank", "window", "node", "payload").mapInArrow(run, EDGE)


def _near_rows(x: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Links of rows at most ``window`` apart (some farther ones too), square by square.  Links between
    rows that are connected already are left out."""
    home = np.arange(len(x))  # rows with one number are connected
    left: list[int] = []
    right: list[int] = []
    for top in range(0, len(x), BLOCK):
        for start in range(top, min(top + BLOCK + window, len(x)), BLOCK):
            near = x[top : top + BLOCK] @ x[start : start + BLOCK].T >= COSINE
            if start == top:
                near = np.triu(near, 1)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                others = start + np.flatnonzero(near[i])
                others = others[home[others] != home[top + i]]
                if len(others):
                    # One link for each connected set that the row meets.
                    _, first = np.unique(home[others], return_index=True)
                    left += [top + i] * len(first)
                    right += others[first].tolist()
                    home[np.isin(home, home[others])] = home[top + i]
    return left, right


def counted_links(members: DataFrame, block: int) -> DataFrame:
    """(node, links): for (component, node, n, payload, dim) the rows of other classes of the same
    component with a cosine of COSINE at least; blocks of each component meet pairwise."""

    def run(batches):
        for table in whole_groups(batches, ["component", "i", "j"]):
            home, i_, n, dims = (np.array(table.column(c).to_pylist()) for c in ("home", "i", "n", "dim"))
            nodes, loads = table.column("node").to_pylist(), table.column("payload").to_pylist()
            edges = [*starts(table, ["component", "i", "j"]), table.num_rows]
            out_nodes, out_links = [], []
            for a, b in zip(edges, edges[1:]):
                x = matrix(loads[a:b], int(dims[a]))
                same = table.column("i")[a].as_py() == table.column("j")[a].as_py()
                first = home[a:b] == i_[a:b]
                left, right = (np.arange(b - a), np.arange(b - a)) if same else (np.flatnonzero(first), np.flatnonzero(~first))
                near = x[left] @ x[right].T >= COSINE
                if same:
                    np.fill_diagonal(near, False)
                counts = np.zeros(b - a, dtype=np.int64)
                counts[left] = near @ n[a:b][right]
                if not same:
                    counts[right] = near.T @ n[a:b][left]
                out_nodes += nodes[a:b]
                out_links += counts.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_nodes, pa.binary()), pa.array(out_links, pa.int64())], names=["node", "links"])

    sizes = stored(members.groupBy("component").agg(F.count("*").alias("rows")).select("component", F.ceil(F.col("rows") / block).cast("int").alias("cuts")), "vector-sizes")
    rows = members.join(sizes, "component").withColumn("home", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    rows = rows.withColumns({"i": F.least("home", "other"), "j": F.greatest("home", "other")})
    met = rows.select("component", "i", "j", "home", "node", "n", "dim", "payload").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    return met.mapInArrow(run, "node binary, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", passes: int = PASSES, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Vectors without a direction link with nothing.  Vectors of different lengths never link.  A row
    with a NULL key takes part; a component of such rows alone has the id NULL.  Repeated rows count
    as rows of their own.  Equal keys go by the vector's digest, so ties do not depend on the layout.
    An empty table gives no rows.  Other columns are not read, whatever their names.  There are
    ``passes`` passes at least; ``window`` is the number of rows either side that each row meets.
    """
    marked = stored(marks(vectors, key, embedding), "vector-marks")
    classes = stored(
        marked.where("node is not null").groupBy("node").agg(F.min(key).alias("first_id"), F.count("*").alias("n"), F.min("dim").alias("dim"), F.min("payload").alias("payload")),
        "vector-classes",
    )
    united = stored(components(window_links(classes, orders(classes, passes, window)), "vector"), "vector-united")
    counted = counted_links(classes.select("node", "n", "dim", "payload").join(united, "node"), block)
    named = classes.select("node", "first_id", "n").join(united, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").join(counted, "node", "left")
    named = stored(named.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vector-named")
    alone = marked.where("node is null").select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    rows = marked.where("node is not null").select(key, "node").join(named, "node").select(key, "n_links", "component_id").unionAll(alone)
    return rows.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
