"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node, so a vector that stands in many rows costs as much as
any other.  The graph starts from blocks: vectors are sorted by the signs of their
random projections, and neighbours inside ``BLOCK`` rows of that order are a first
guess.  NN-descent then mends it: the neighbours of a node, forward and reverse, are
joined at that node, and each pair that is closer than the worst neighbour so far
of one of the two becomes an edge of that one.  Only pairs with an edge that is new
since the last round are looked at.

A search starts from the nodes in a query's own blocks and keeps the ``beam`` best
nodes seen.  A round opens the ``width`` best that were not opened yet, by a join
with the graph, and ends when all of the beam are open.  Graph and search compare
vectors by a code of one byte a component; the best of the beam are scored again
from the vectors given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import stored

TREES, BLOCK, FIRST_NEAR = 6, 1024, 12
DEGREE, JOINED, ROUNDS = 24, 40, 2
LINKS = 2 * DEGREE
BEAM, WIDTH, SEARCH_TREES, RESCORED = 256, 64, 2, 32
SIGN_BITS = 30

EDGE = "node long, s float, id long"


def usable_vectors(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): double vectors.  Rows without an id and rows whose vector is null,
    empty, all zero or has a null, NaN or infinite component are left out."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.coalesce(F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0), F.lit(False)))


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix for each length of a column of vectors."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        yield rows, values[start[rows][:, None] + np.arange(n)]


def _codes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors for each length of a column of codes."""
    raw = column.to_pylist()
    sizes = np.array([len(x) for x in raw])
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        yield rows, _matrix([raw[i] for i in rows])


def _matrix(codes: list[bytes]) -> np.ndarray:
    """Rows of whole numbers as doubles: their inner products are exact."""
    return np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1).astype(np.float64)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same figure for a pair wherever it is computed."""
    scale = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :]
    return ((a @ b.T) / scale).astype(np.float32)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes: list = [None] * batch.num_rows
        for rows, m in _vectors(batch.column("v")):
            m = m / np.abs(m).max(axis=1)[:, None]
            small = np.rint(127 * m).astype(np.int8)
            for i, code in zip(rows.tolist(), small, strict=True):
                codes[i] = code.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], names=[*batch.schema.names, "code"])


def nodes_of(vectors: DataFrame, members: int) -> DataFrame:
    """(members, v, code, node): one row per different vector of (id, v), with the
    ``members`` smallest of its ids."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = vectors.select("id", "v").withColumn("rank", rank).where(F.col("rank") <= members)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("members"))
    coded = grouped.mapInArrow(_coded, "v array<double>, members array<long>, code binary")
    return stored(coded.withColumn("node", F.monotonically_increasing_id()))


def _blocks(rows: DataFrame, trees: int) -> DataFrame:
    """(tree, dims, spot, node, asks, answers, code): each row of (node, asks,
    answers, code) once a tree, in the order of its projections' signs."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, m in _codes(batch.column("code")):
                part = batch.take(pa.array(at))
                for tree in range(trees):
                    lines = np.random.default_rng([tree, m.shape[1]]).normal(size=(m.shape[1], SIGN_BITS))
                    spot = (m @ lines > 0) @ (1 << np.arange(SIGN_BITS, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), tree, np.int32)), pa.array(np.full(len(at), m.shape[1], np.int32)), pa.array(spot), *part.columns],
                        names=["tree", "dims", "spot", *part.schema.names],
                    )

    rows = rows.select("node", "asks", "answers", "code")
    keyed = rows.mapInArrow(project, "tree int, dims int, spot long, node long, asks boolean, answers boolean, code binary")
    order = ["tree", "dims", "spot", "node"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def _near_in_blocks(rows: DataFrame, trees: int, near: int) -> DataFrame:
    """(node, s, id): for each row that asks the best ``near`` that answer in each
    of its blocks of ``BLOCK`` to 2 * ``BLOCK`` rows."""

    def best(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        node = np.array([r[0] for r in block])
        asks, answers = (np.flatnonzero([r[i] for r in block]) for i in (1, 2))
        if len(asks) and len(answers):
            m = _matrix([r[3] for r in block])
            s = _cosines(m[asks], m[answers])
            s[node[asks][:, None] == node[answers][None, :]] = -np.inf
            some = np.argpartition(-s, min(near, s.shape[1]) - 1, axis=1)[:, :near]
            s = np.take_along_axis(s, some, 1).ravel()
            who, whom = np.repeat(node[asks], some.shape[1]), node[answers][some].ravel()
            good = s > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(who[good]), pa.array(s[good]), pa.array(whom[good])], names=["node", "s", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind = [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "dims", "node", "asks", "answers", "code")]
            for tree, dims, *row in zip(*columns, strict=True):
                if (tree, dims) != kind:
                    yield from best(block)
                    block, kind = [], (tree, dims)
                block.append(row)
                if len(block) == 2 * BLOCK:
                    yield from best(block[:BLOCK])
                    block = block[BLOCK:]
        yield from best(block)

    return _blocks(rows, trees).mapInArrow(run, EDGE)


def _best_edges(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The ``DEGREE`` best edges of each node among those it had and those found
    for it: (node, s, id, place, fresh)."""
    both = edges.select("node", "s", "id", F.lit(True).alias("had")).unionByName(found.select("node", "s", "id", F.lit(False).alias("had")))
    # an edge that was found several times has one place
    place = F.dense_rank().over(Window.partitionBy("node").orderBy(F.desc("s"), "id"))
    best = both.withColumn("place", place).where(F.col("place") <= DEGREE)
    return best.groupBy("node", "s", "id", "place").agg((~F.max("had")).alias("fresh"))


def _pairs_at_nodes(edges: DataFrame, nodes: DataFrame, round_number: int) -> DataFrame:
    """The join of NN-descent: pairs of neighbours of one node, at least one by a
    fresh edge, where one is closer to the other than its worst neighbour."""
    ahead = edges.select(F.col("node").alias("at"), F.col("id").alias("node"), "fresh", F.lit(0).alias("back"))
    back = edges.select(F.col("id").alias("at"), "node", "fresh", F.lit(1).alias("back"))
    # a hub's reverse edges take turns from round to round
    order = Window.partitionBy("at").orderBy(F.desc("fresh"), "back", F.xxhash64("node", F.lit(round_number)))
    some = ahead.unionByName(back).withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= JOINED)
    worst = edges.where(F.col("place") == DEGREE).select("node", F.col("s").alias("worst"))
    known = nodes.select("node", "code").join(worst, "node", "left")
    member = F.struct("node", "fresh", "code", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"))
    met = some.join(known, "node").groupBy("at").agg(F.collect_list(member).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, whom, close = [], [], []
            lists = batch.column("met")
            end = np.cumsum(np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            node, fresh, worst_of = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("node", "fresh", "worst"))
            codes = flat.field("code").to_pylist()
            for a, b in zip(np.concatenate([[0], end[:-1]]).tolist(), end.tolist(), strict=True):
                ids, first = np.unique(node[a:b], return_index=True)
                new = np.zeros(len(ids), bool)
                new[np.searchsorted(ids, node[a:b][fresh[a:b].astype(bool)])] = True
                if new.any():
                    m = _matrix([codes[a + i] for i in first])
                    s = _cosines(m, m)
                    good = (s > worst_of[a:b][first][:, None]) & (new[:, None] | new[None, :])
                    np.fill_diagonal(good, False)
                    i, j = np.nonzero(good)
                    who.append(ids[i]), whom.append(ids[j]), close.append(s[i, j])
            if who:
                x = np.stack([np.concatenate(who), np.concatenate(whom)])
                x, first = np.unique(x, axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(np.concatenate(close)[first]), pa.array(x[1])], names=["node", "s", "id"])

    return met.select("met").mapInArrow(run, EDGE)


def first_edges(nodes: DataFrame) -> DataFrame:
    """The graph before the descent."""
    rows = nodes.select("node", "code", F.lit(True).alias("asks"), F.lit(True).alias("answers"))
    guess = _near_in_blocks(rows, TREES, FIRST_NEAR)
    return stored(_best_edges(guess.where("false"), guess))


def descend(nodes: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The neighbour graph after so many rounds."""
    for number in range(rounds):
        edges = stored(_best_edges(edges, _pairs_at_nodes(edges, nodes, number)))
    return edges


def links(edges: DataFrame) -> DataFrame:
    """(node, near): the edges in both directions, the best ``LINKS`` of a node."""
    both = edges.select("node", "s", "id").unionByName(edges.select(F.col("id").alias("node"), "s", F.col("node").alias("id")))
    place = F.dense_rank().over(Window.partitionBy("node").orderBy(F.desc("s"), "id"))
    best = both.withColumn("place", place).where(F.col("place") <= LINKS)
    return stored(best.groupBy("node").agg(F.collect_set("id").alias("near")))


def _scores(asked: DataFrame) -> DataFrame:
    """(query, s, id) of rows (query, code, worst, id, other) that beat ``worst``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.empty(batch.num_rows)
            theirs = batch.column("other").to_pylist()
            for rows, a in _codes(batch.column("code")):
                b = _matrix([theirs[i] for i in rows])
                scale = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
                s[rows] = np.einsum("ij,ij->i", a, b) / scale
            s = s.astype(np.float32)
            good = pa.array(s > batch.column("worst").to_numpy(zero_copy_only=False))
            out = pa.RecordBatch.from_arrays([batch.column("query"), pa.array(s), batch.column("id")], names=["query", "s", "id"])
            yield out.filter(good)

    return asked.select("query", "code", "worst", "id", "other").mapInArrow(run, "query long, s float, id long")


def _beam(rows):
    return F.slice(F.array_sort(rows), 1, BEAM)


def _spot(s, id_, open_):
    return F.struct((-s).alias("far"), id_.alias("id"), open_.alias("open"))


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """(query, code, beam): the best nodes found for each row of (query, code);
    ``beam`` holds (far, id, open), nearest first, far being minus the cosine."""
    asks = queries.select(F.col("query").alias("node"), "code", F.lit(True).alias("asks"), F.lit(False).alias("answers"))
    # queries and nodes are numbered apart
    rows = asks.withColumn("node", -1 - F.col("node")).unionByName(nodes.select("node", "code", F.lit(False).alias("asks"), F.lit(True).alias("answers")))
    entry = _near_in_blocks(rows, SEARCH_TREES, FIRST_NEAR).select((-1 - F.col("node")).alias("query"), "s", "id")
    start = entry.groupBy("query").agg(F.collect_set(_spot(F.col("s"), F.col("id"), F.lit(True))).alias("beam"))
    state = stored(queries.select("query", "code").join(start.select("query", _beam(F.col("beam")).alias("beam")), "query"))
    codes = nodes.select(F.col("node").alias("id"), F.col("code").alias("other"))
    while not state.where(F.exists("beam", lambda x: x["open"])).isEmpty():
        opened = state.withColumn("front", F.slice(F.filter("beam", lambda x: x["open"]), 1, WIDTH)["id"])
        front = opened.select("query", F.explode("front").alias("node"))
        reached = front.join(graph, "node").groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("reached"))
        worst = F.when(F.size("beam") < BEAM, F.lit(-2.0)).otherwise(-F.element_at("beam", -1)["far"]).cast("float")
        asked = opened.join(reached, "query").select("query", "code", worst.alias("worst"), F.explode(F.array_except("reached", F.col("beam.id"))).alias("id"))
        found = _scores(asked.join(codes, "id")).groupBy("query").agg(F.collect_list(_spot(F.col("s"), F.col("id"), F.lit(True))).alias("found"))
        seen = F.transform("beam", lambda x: F.struct(x["far"].alias("far"), x["id"].alias("id"), (x["open"] & ~F.array_contains("front", x["id"])).alias("open")))
        more = F.coalesce("found", F.array().cast("array<struct<far:float,id:long,open:boolean>>"))
        state = stored(opened.join(found, "query", "left").select("query", "code", _beam(F.concat(seen, more)).alias("beam")))
    return state


def _exact(pairs: DataFrame) -> DataFrame:
    """(query_id, members, score): cosines in double precision from the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.empty(batch.num_rows)
            other = {n.shape[1]: (rows, n) for rows, n in _vectors(batch.column("other"))}
            for rows, a in _vectors(batch.column("v")):
                _, b = other[a.shape[1]]
                # a factor of each vector keeps its squares finite
                a, b = a / np.abs(a).max(axis=1)[:, None], b / np.abs(b).max(axis=1)[:, None]
                score[rows] = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("members"), pa.array(score)], names=["query_id", "members", "score"])

    return pairs.select("query_id", "members", "v", "other").mapInArrow(run, "query_id long, members array<long>, score double")


def nearest(queries: DataFrame, candidates: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of largest cosine found for
    each query, nearest first, ties to the smaller id.

    Both sides are (id, v) as from ``usable_vectors``.  Only vectors of equal length
    meet.  A row never meets a query of its own id; rows that repeat an id else
    count each, and a query id with several vectors is asked once with each, the
    best k of all being returned.  Equal vectors share one node, which keeps the
    k + 1 smallest ids, so none that could be an answer is lost.  An empty side
    gives no rows.
    """
    nodes = nodes_of(candidates, k + 1)
    graph = links(descend(nodes, first_edges(nodes), rounds))
    asked = queries.select("id", "v").distinct().mapInArrow(_coded, "id long, v array<double>, code binary")
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()))
    found = search(asked, nodes, graph)
    few = found.select("query", F.explode(F.slice("beam", 1, k + RESCORED)["id"]).alias("node"))
    pairs = few.join(asked.select("query", F.col("id").alias("query_id"), "v"), "query").join(nodes.select("node", "members", F.col("v").alias("other")), "node")
    each = _exact(pairs).select("query_id", F.explode("members").alias("vec_id"), "score").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
