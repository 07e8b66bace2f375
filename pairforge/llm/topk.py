"""Exact top-k inner products by a ball tree per shard, with branch and bound.

Candidate vectors are dealt into shards of bounded size, and the ball tree of a
shard is built once.  Shards and queries form groups; a group of queries and a
group of shards meet in a cell of their own, so that no key stands for more than
a cell.  In a cell, tree nodes are visited in the order of their upper bound of
the inner product, query . centre + |query| * radius, and a node is skipped by
every query whose k-th best score so far is above the bound.  That score is
shared: from tree to tree of a cell, and between rounds, each of which takes four
times as many groups of shards as the one before.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import stored

#: Rows (and bytes of vectors) of a shard, rows of a leaf, shards of a cell, queries of a cell.
SHARD_ROWS, SHARD_BYTES, LEAF_ROWS, GROUP_SHARDS, QUERY_BLOCK = 4096, 1 << 21, 64, 8, 4096

#: Sums below this are exact in double precision; those below the other in 64 bits.
EXACT, LONG = float(1 << 53), float(1 << 63)
#: No score yet.  Scores beyond 64 bits count as the ends of their range.
NONE, LEAST, MOST = -(1 << 63), 1 - (1 << 63), (1 << 63) - 1


def integer_vectors(frame: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component as double.  Rows whose vector
    is null, empty or holds a null, NaN or infinite component are left out, and
    so are null ids."""
    v: Column = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return frame.where(F.coalesce(good & (F.size(vector) > 0), F.lit(False)) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("v"))


class BallTree:
    """Nodes in arrays: rows [first, last) of the reordered vectors, centre and
    radius; node i has children 2 i + 1 and 2 i + 2."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        self.first, self.last, self.centre, self.radius = {}, {}, {}, {}
        todo = [(0, 0, len(ids))]
        while todo:
            node, a, b = todo.pop()
            part = rows[order[a:b]]
            centre = part.mean(axis=0)
            self.first[node], self.last[node], self.centre[node] = a, b, centre
            self.radius[node] = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            if b - a > LEAF_ROWS and self.radius[node] > 0:
                far = part[((part - part[0]) ** 2).sum(axis=1).argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                side = part @ (other - far)
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(side, middle)]
                todo += [(2 * node + 1, a, a + middle), (2 * node + 2, a + middle, b)]
        self.ids, self.rows = ids[order], rows[order]

    def _reach(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products with the rows below a node, with more
        room than rounding can take."""
        size = float(np.sqrt((self.centre[node] ** 2).sum())) + self.radius[node]
        return queries @ self.centre[node] + norms * self.radius[node] + 1e-9 * (1 + norms * size)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best rows of each query (NONE and 0 beyond the
        rows there are); rows scoring below ``floor`` may be left out."""
        n = len(queries)
        best, who = np.full((n, k), NONE, np.int64), np.zeros((n, k), np.int64)
        norms = np.sqrt((queries**2).sum(axis=1))
        open_nodes = [(0, np.arange(n), self._reach(0, queries, norms))]
        while open_nodes:
            at = max(range(len(open_nodes)), key=lambda i: open_nodes[i][2].max(initial=-np.inf))
            node, some, bound = open_nodes.pop(at)
            needed = np.maximum(floor[some], best[some, -1])
            some = some[(needed == NONE) | (bound >= needed)]
            if not len(some):
                continue
            children = [c for c in (2 * node + 1, 2 * node + 2) if c in self.first]
            for c in children:
                open_nodes.append((c, some, self._reach(c, queries[some], norms[some])))
            if not children:
                a, b = self.first[node], self.last[node]
                score = inner(queries[some], self.rows[a:b])
                ids = np.broadcast_to(self.ids[a:b], score.shape)
                score = np.where(ids == query_ids[some][:, None], NONE, score)
                score, ids = np.hstack([best[some], score]), np.hstack([who[some], ids])
                rank = np.lexsort((ids, ~score), axis=1)[:, :k]  # ~x is -x - 1, which exists for every x
                best[some], who[some] = np.take_along_axis(score, rank, 1), np.take_along_axis(ids, rank, 1)
        return best, who


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; those beyond 64 bits are
    the least or the greatest long."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    if most < LONG:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    whole = [[int(x) for x in r] for r in a.tolist()], [[int(x) for x in r] for r in b.tolist()]
    return np.array([[min(max(sum(x * y for x, y in zip(q, r, strict=True)), LEAST), MOST) for r in whole[1]] for q in whole[0]], np.int64).reshape(len(a), len(b))


def _groups(counts: dict[int, int], size) -> dict[int, int]:
    return {d: max(1, -(-n // size(d))) for d, n in counts.items()}


def _of(numbers: dict[int, int]) -> Column:
    """The number of a row's vector length."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("dims"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k highest inner
    products among the candidates with another id; ties to the smaller id.

    Both sides are (id, v) as from ``integer_vectors``.  Only vectors of equal
    length meet.  Rows that repeat an id count each, but never against a query of
    that id; a query id given several times is asked once per different vector.
    Scores are exact; those beyond 64 bits count as the ends of that range.
    """
    spark = queries.sparkSession
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # of rows that are equal as a whole no more than k can be among the k best
    copies = candidates.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    rows = stored(copies.select("id", "v", F.size("v").alias("dims"), F.explode(F.sequence(F.lit(1), "times")).alias("copy")))
    asked = stored(queries.select("id", "v", F.size("v").alias("dims")).distinct())
    # one row per vector length
    n_rows, n_asked = ({r["dims"]: r["count"] for r in t.groupBy("dims").count().collect()} for t in (rows, asked))
    shards = _groups(n_rows, lambda d: max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * d))))
    parts = _groups({d: n for d, n in n_asked.items() if d in shards}, lambda d: QUERY_BLOCK)
    if not parts:
        return nothing
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v", "copy"), _of(shards)).cast("int")).where(F.col("dims").isin(list(parts)))
    trees = stored(dealt.groupBy("dims", "shard").applyInArrow(_built, "dims int, shard int, tree binary"))
    asked = asked.where(F.col("dims").isin(list(parts))).withColumn("block", F.pmod(F.xxhash64("id", "v"), _of(parts)).cast("int"))
    last = max(shards[d] for d in parts)
    best, begin, width = nothing.drop("rank"), 0, GROUP_SHARDS
    while begin < last:
        end = begin + width
        best = stored(_ranked(best.unionByName(_round(asked, trees, best, begin, end, shards, parts, k)), k).drop("rank"))
        begin, width = end, 4 * width
    return _ranked(best, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _round(asked: DataFrame, trees: DataFrame, best: DataFrame, begin: int, end: int, shards: dict[int, int], parts: dict[int, int], k: int) -> DataFrame:
    """Answers of the shards from ``begin`` to before ``end`` that may be among the
    k best.  Each side goes to the cells it has a part in."""
    kth = best.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    floor = F.coalesce("floor", F.lit(NONE).cast("long")).alias("floor")
    until = F.least(_of(shards), F.lit(end)) - 1
    group = F.explode(F.sequence(F.lit(begin // GROUP_SHARDS), (until / GROUP_SHARDS).cast("int"))).alias("group")
    waiting = asked.where(until >= begin).join(kth, F.col("id") == F.col("query_id"), "left")
    left = waiting.select("dims", "block", group, "id", "v", floor)
    some = trees.where(F.col("shard").between(begin, end - 1))
    right = some.select("dims", F.explode(F.sequence(F.lit(0), _of(parts) - 1)).alias("block"), (F.col("shard") / GROUP_SHARDS).cast("int").alias("group"), "shard", "tree")
    cell = ["dims", "block", "group"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_answers(k), "query_id long, vec_id long, score long")


def _built(rows: pa.Table) -> pa.Table:
    """The ball tree of one shard."""
    v, ids = _matrix(rows)
    tree = pickle.dumps(BallTree(ids, v), pickle.HIGHEST_PROTOCOL)
    return pa.table({"dims": rows["dims"].slice(0, 1), "shard": rows["shard"].slice(0, 1), "tree": pa.array([tree], pa.binary())})


def _answers(k: int):
    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 3]
        if queries.num_rows:
            v, ids = _matrix(queries)
            floor = queries["floor"].to_numpy().astype(np.int64)
            order = np.argsort(trees["shard"].to_numpy(), kind="stable").tolist()
            for at in order:
                best, who = pickle.loads(trees["tree"][at].as_py()).search(ids, v, k, floor)
                i, j = np.nonzero((best >= floor[:, None]) & (best != NONE))
                found.append((ids[i], who[i, j], best[i, j]))
                floor = np.maximum(floor, best[:, -1])
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return run


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = rows["v"].combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1), rows["id"].to_numpy().astype(np.int64)
