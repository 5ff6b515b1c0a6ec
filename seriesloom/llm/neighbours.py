"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

A vector x becomes (x, sqrt(M^2 - |x|^2)), M the largest length of all, and a query q becomes (q, 0): the nearest then have the largest inner
products. The tree is fitted on a bounded sample; every distinct vector goes down to the leaf of the nearest centres. A query takes nodes out of a
priority queue, the nearest centre first, puts the children of inner ones back in and visits the leaves as they come. How many leaves it visits is
calibrated: for a bounded set of queries the true neighbours are found among all rows, and visits are widened until their mean recall is
reached. Leaves and their visitors meet in blocks of bounded size, so neither a full leaf nor a popular one is in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import written

#: Bound of the sample the tree is fitted on (about; by a hash of the vector), children of a node, sampled vectors of a leaf.
SAMPLE, BRANCHES, LEAF = 16_384, 8, 192
#: Queries of the calibration (about), the mean recall they must reach.
CALIBRATION, RECALL = 256, 0.95
#: Components of the distinct vectors and of the queries of one block.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 21, 1 << 19
#: Steps of a share of all hashes.
STEPS = 1 << 40


@dataclass(frozen=True)
class Tree:
    """Nodes of a fitted tree: centres, children of inner nodes, and the number of each leaf (-1 for inner nodes)."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max(initial=-1)) + 1

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: at every node the nearest child."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            below = self.children[node]
            if not len(below):
                out[rows] = self.leaf[node]
                continue
            nearest = _distances(x[rows], self.centres[below]).argmin(axis=1)
            todo += [(int(c), rows[nearest == i]) for i, c in enumerate(below)]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        near = ((self.centres - q) ** 2).sum(axis=1).tolist()
        queue, out = [(near[0], 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if len(below):
                for c in below.tolist():
                    heapq.heappush(queue, (near[c], c))
            else:
                out.append(int(self.leaf[node]))
        return out


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances but for the rows' own lengths."""
    return (centres**2).sum(axis=1) - 2 * (x @ centres.T)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, turns: int = 12) -> np.ndarray:
    """The cluster of each row; starts from distant rows."""
    centres = x[[int(rng.integers(len(x)))]]
    far = np.full(len(x), np.inf)
    while len(centres) < k:
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        centres = np.vstack((centres, x[rng.choice(len(x), p=far / far.sum())]))
    own = np.zeros(len(x), np.int64)
    for _ in range(turns):
        own = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return own


def fit(x: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 1) -> Tree:
    """A tree whose leaves hold at most ``leaf`` of the rows ``x``, but for rows that k-means cannot part."""
    rng = np.random.default_rng(seed)
    centres, children, number, todo, leaves = [x.mean(axis=0)], [np.zeros(0, np.int64)], [-1], [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop()
        own = _k_means(x[rows], branches, rng) if len(rows) > leaf else np.zeros(len(rows), np.int64)
        parts = [rows[own == i] for i in np.unique(own)]
        if len(parts) < 2:
            number[node], leaves = leaves, leaves + 1
            continue
        first = len(centres)
        children[node] = np.arange(first, first + len(parts))
        for p in parts:
            todo.append((len(centres), p))
            centres.append(x[p].mean(axis=0))
            children.append(np.zeros(0, np.int64))
            number.append(-1)
    return Tree(np.array(centres), children, np.array(number))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _raised(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that makes them all equally long."""
    return np.hstack((x, np.sqrt(np.maximum(longest - (x**2).sum(axis=1), 0.0))[:, None]))


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _best(rows: np.ndarray, ids: list[list[int]], queries: np.ndarray, k: int) -> list[tuple[list[float], list[int]]]:
    """Of each query the ``k`` ids with the largest inner products, ties to smaller ids.

    A matrix product chooses the rows; their scores are then summed row by row in one fixed order, so that they do not depend on the block.
    """
    out = []
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        rough = part @ rows.T
        if len(rows) > k:
            edge = np.partition(rough, len(rows) - k, axis=1)[:, len(rows) - k]
            slack = 1e-9 * np.abs(rough).max(axis=1) + 1e-300
        else:
            edge, slack = np.full(len(part), -np.inf), np.zeros(len(part))
        for q, r, least in zip(part, rough, edge - slack):
            chosen = np.flatnonzero(r >= least)
            exact = (rows[chosen] * q).sum(axis=1).tolist()
            found = sorted((-s, i) for s, c in zip(exact, chosen.tolist()) for i in ids[c])[:k]
            out.append(([-s for s, _ in found], [i for _, i in found]))
    return out


def usable(vector: Column) -> Column:
    """A vector with values, all finite and not all zero."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine) & F.exists(vector, lambda v: v != 0), F.lit(False))


def _merged(found: DataFrame, k: int) -> DataFrame:
    """q, best: the first ``k`` (score, id) of each query over all its blocks, nearest first."""
    pairs = F.flatten(F.collect_list(F.arrays_zip("score", "vec")))
    ranked = F.array_sort(F.transform(pairs, lambda p: F.struct((-p["score"]).alias("far"), p["vec"].alias("vec"))))
    return found.groupBy("q").agg(F.slice(ranked, 1, k).alias("best"))


_FOUND = "q bigint, score array<double>, vec array<bigint>"


def _met(rows: DataFrame, probes: DataFrame, sizes: dict[int, int], asked: dict[int, int], k: int, length: int) -> DataFrame:
    """Leaves and their visitors, block by block: ``rows`` (leaf, v, ids), ``probes`` (leaf, q, v)."""
    blocks = lambda n, most: -(-n * length // most) or 1
    pieces = [blocks(sizes.get(i, 0), BLOCK_ROWS) for i in range(max([*sizes, *asked], default=0) + 1)]
    shares = [blocks(asked.get(i, 0), BLOCK_QUERIES) for i in range(len(pieces))]
    of = lambda counts: F.element_at(F.array(*[F.lit(c) for c in counts]), F.col("leaf") + 1)
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("v"), of(pieces)).cast("int")).withColumn("share", upto(of(shares)))
    probes = probes.withColumn("share", F.pmod(F.xxhash64("q"), of(shares)).cast("int")).withColumn("piece", upto(of(pieces)))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "score": _lists([], pa.float64()), "vec": _lists([], pa.int64())})
        flat = lambda t: _matrix(t.column("v").combine_chunks())
        found = _best(flat(left), left.column("ids").to_pylist(), flat(right), k)
        return pa.table({"q": right.column("q"), "score": _lists([f[0] for f in found], pa.float64()), "vec": _lists([f[1] for f in found], pa.int64())})

    key = ["leaf", "piece", "share"]
    return rows.groupBy(*key).cogroup(probes.groupBy(*key)).applyInArrow(block, _FOUND)


def _exact(rows: DataFrame, queries: np.ndarray, k: int) -> list[list[int]]:
    """The true nearest ids of a bounded set of queries: every task keeps its own best, their union is ranked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[list[float], list[int]]] = [([], []) for _ in queries]
        for b in batches:
            if b.num_rows:
                for i, (score, ids) in enumerate(_best(_matrix(b.column(0)), b.column(1).to_pylist(), queries, k)):
                    both = sorted((-s, v) for s, v in zip(best[i][0] + score, best[i][1] + ids))[:k]
                    best[i] = ([-s for s, _ in both], [v for _, v in both])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(queries)), pa.int64()), _lists([b[0] for b in best], pa.float64()), _lists([b[1] for b in best], pa.int64())], ["q", "score", "vec"])

    found = {r.q: [p.vec for p in r.best] for r in _merged(rows.select("v", "ids").mapInArrow(run, _FOUND), k).collect()}
    return [found.get(i, []) for i in range(len(queries))]


def _calibrated(tree: Tree, asked: np.ndarray, raised: np.ndarray, truth: list[list[int]], leaf_of: dict[int, int], recall: float) -> int:
    """The least number of leaves, widened one by one, at which the mean recall of the queries is reached."""
    needed = []  # for every true neighbour, the visits it takes; each query weighs one
    for q, near in zip(raised, truth):
        place = {leaf: i + 1 for i, leaf in enumerate(tree.visits(q, tree.leaves))}
        needed += [(place[leaf_of[v]], 1 / len(near)) for v in near if v in leaf_of]
    total, got = sum(w for _, w in needed), 0.0
    for visits, weight in sorted(needed):
        got += weight
        if got >= recall * total - 1e-9:
            return visits
    return tree.leaves


def search(table: DataFrame, queries: Column, k: int, vector: str = "embedding", key: str = "vec_id", recall: float = RECALL, sample: int = SAMPLE,
           branches: int = BRANCHES, leaf: int = LEAF, calibration: int = CALIBRATION) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row that ``queries`` chooses, the ``k`` nearest found among all rows of other ids.

    Nearness is the inner product in double precision; nearest first, ties to the smaller id; all candidates where there are fewer. Rows with a null id
    or a null, empty or zero vector or with null or non-finite components take no part, nor have vectors of another length than most rows have
    (ties: the longest). Rows that repeat both id and vector count once; an id with several vectors asks once with each and is found with each. An
    empty table gives no rows. Only ``key`` and ``vector`` are read.

    The tree comes from about ``sample`` distinct vectors, the number of visits from about ``calibration`` queries; every row is indexed. Equal vectors
    are one entry with its k + 1 smallest ids, as no others can be among the nearest, so copies do not fill a leaf.
    """
    spark = table.sparkSession
    given = table.select(table[key].cast("bigint").alias("id"), table[vector].alias("v"), queries.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = {r.n: r.rows for r in given.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).collect()}
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    length = max(sizes, key=lambda n: (sizes[n], n))
    given = written(given.where(F.size("v") == length).groupBy("id", "v").agg(F.max("asks").alias("asks")))
    few = given.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("at") <= k + 1)
    rows = written(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    asking = written(given.where("asks").select("v").distinct().withColumn("q", F.monotonically_increasing_id()))

    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    counted = rows.agg(F.count("*").alias("n"), F.max(total).alias("longest")).first()
    n_asking = asking.count()
    if not n_asking:
        return spark.createDataFrame([], schema)
    part = lambda df, most, n: df.where(F.pmod(F.xxhash64("v", F.lit(5)), F.lit(STEPS)) < max(1, round(STEPS * most / n))).select("v").toArrow().column(0).combine_chunks()
    chosen = part(rows, sample, counted.n)
    longest = counted.longest * (1 + 1e-9)
    tree = fit(_raised(_matrix(chosen if len(chosen) else rows.select("v").limit(1).toArrow().column(0).combine_chunks()), longest), branches, leaf)
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = shared.value.descend(_raised(_matrix(b.column(0)), longest))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), b.column(0), b.column(1)], ["leaf", "v", "ids"])

    kind = rows.schema["v"].dataType.simpleString()
    placed = written(rows.mapInArrow(assign, f"leaf int, v {kind}, ids array<bigint>"))
    in_leaf = {r.leaf: r.n for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}

    # calibration: the true neighbours of a few queries among all rows, and the leaves that hold them
    trial = part(asking, calibration, n_asking)
    visits = tree.leaves
    if len(trial) and tree.leaves > 1:
        plain = _matrix(trial)
        truth = _exact(rows, plain, k + 1)
        wanted = sorted({v for near in truth for v in near})
        leaf_of = {r.i: r.leaf for r in placed.select("leaf", F.explode("ids").alias("i")).where(F.col("i").isin(wanted)).collect()}
        raised = np.hstack((plain, np.zeros((len(plain), 1))))
        visits = _calibrated(tree, plain, raised, truth, leaf_of, recall)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                x = _matrix(b.column(0))
                leaves = [shared.value.visits(q, visits) for q in np.hstack((x, np.zeros((len(x), 1))))]
                each = pa.array(np.repeat(np.arange(len(x)), [len(one) for one in leaves]))
                yield pa.RecordBatch.from_arrays([pa.array([i for one in leaves for i in one], pa.int32()), b.column(1).take(each), b.column(0).take(each)], ["leaf", "q", "v"])

    probes = written(asking.select("v", "q").mapInArrow(probe, f"leaf int, q bigint, v {kind}"))
    visitors = {r.leaf: r.n for r in probes.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    best = _merged(_met(placed, probes, in_leaf, visitors, k + 1, length), k + 1)
    answers = best.join(asking, "q").select("v", "best")
    each = given.where("asks").select("id", "v").join(answers, "v").select("id", F.filter("best", lambda b: b["vec"] != F.col("id")).alias("best"))
    each = each.select(F.col("id").alias("query_id"), F.posexplode(F.slice("best", 1, k)).alias("at", "b"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec").alias("vec_id"), (-F.col("b.far")).alias("score"))
