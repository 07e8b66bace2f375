"""Exact Jaccard join of shingle sets in the metric space d = 1 - Jaccard.

Two sets within the radius r = 1 - threshold of each other are linked.

1. Equal sets are one point.
2. Pivots.  Take the shingles of a set in one fixed order, rare ones first.  Of n
   shingles, a linked set misses at most r n, so it holds one of the first
   floor(r n) + 1: that is the triangle inequality against the one-shingle sets.
   The smallest point that a shingle leads among those holding it there is a
   pivot; a point belongs to the region of each pivot that leads one of its
   first shingles.  Two linked points share such a shingle, hence a region.
   The first shingle that both hold leads the smaller set's order even earlier, and
   their sizes are close: a point that meets no such partner at a shingle stays out
   of that region.  First shingles move once, packed; what their sketches allow
   to be linked in a region goes on, named by its smallest point, so that copies
   that meet in many regions go on as one.
3. A region too large for one task is split again by Voronoi cells of some of
   its own points: a point goes to its nearest pivot and, as a boundary point,
   to every pivot at most 2 r farther than that.  For linked x, y and the cell p
   of x: d(y, p) <= d(x, p) + r <= d(x, p_y) + r <= d(y, p_y) + 2 r.  Cells are
   split in turn.  Where everything lies within the windows of everything, cells
   do not shrink; such a region is dealt into blocks, and pairs of blocks meet.
4. In a small enough region all intersections are counted exactly, and a
   spanning forest of the links leaves it: rows out are linear in rows in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import by_flag, hash_flags, lean, raw_texts, slices, stored
from pairforge.llm.components import components
from pairforge.llm.shingles import set_id, shingle_sets

#: Points and shingles that one task joins at once.
LEAF_POINTS, LEAF_SHINGLES = 1024, 4_000_000
#: Leaves' points that one task compares by sketches at most.
SKETCH_LEAVES = 32
#: First shingles that a bucket of the join holds, that a worker packs at once, and
#: that one row has at most (larger rows are humongous objects of the JVM's heap).
BUCKET_FIRSTS, PACK_FIRSTS, ROW_FIRSTS = 1 << 18, 1 << 18, 1 << 13
#: Bytes of a packed first shingle: what is kept of its hash, the point, its kind.
HASH_BYTES, FIRST_BYTES = 5, 5 + 8 + 1
#: Ratio of sizes of a class, and the largest class.
SIZE_STEP, LAST_CLASS = 1.12, 126
#: Bits of the flags that keep texts from being moved.
TEXT_FLAG_BITS = 23
#: Cells per split, and splits before blocks.
PIVOTS, DEPTH = 8, 4
#: Classes of a sketch.
SKETCH = 256
#: Counters of the shingle frequencies that set the order (2^17 of them).
FREQUENCY_BITS = 17


def _in_first(n: int, threshold: int) -> int:
    """Shingles of n of which a linked set holds one: n - ceil(n t / 100) + 1."""
    return n - -(-n * threshold // 100) + 1


def _in_first_of_smaller(n: int, threshold: int) -> int:
    """Shingles of n of which a linked set of n or more holds one: they have at
    least 2 n t / (100 + t) in common."""
    return n - -(-2 * n * threshold // (100 + threshold)) + 1


def size_class(n: int) -> int:
    return min(LAST_CLASS, int(math.log(n) / math.log(SIZE_STEP)))


def classes_apart(threshold: int) -> int:
    """The classes that the sizes of linked sets lie apart at most."""
    return int(math.log(100 / max(threshold, 1)) / math.log(SIZE_STEP) + 1e-9) + 1


def linked(common: np.ndarray, total: np.ndarray, threshold: int) -> np.ndarray:
    """100 * intersection >= threshold * union, where total is the sum of sizes."""
    return 100 * common >= threshold * (total - common)


def sketch(shingles: np.ndarray) -> bytes:
    """Shingles per class of their hash.  The sum of the differences between two
    sketches is at most the size of the symmetric difference of the sets."""
    counts = np.bincount((shingles & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


class Forest:
    """Spanning forest of links among numbered points."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def join_region(sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """Links of a region, as (point, root) of a spanning forest."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    forest = Forest(n)
    if n <= 6:
        for a in range(n):
            for b in range(a):
                small, large = sorted((sizes[a], sizes[b]))
                if 100 * small >= threshold * large and forest.root(a) != forest.root(b):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if linked(both, small + large, threshold):
                        forest.join(a, b)
    else:
        values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), sizes)
        shared = count[place] > 1
        column = np.cumsum(count > 1) - 1
        owner, place = owner[shared], column[place[shared]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        common = np.zeros((n, n), np.float32)
        width = max(256, (1 << 21) // n)
        for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            a, b = np.searchsorted(place, [at, at + width])
            block = np.zeros((n, width), np.float32)
            block[owner[a:b], place[a:b] - at] = 1
            common += block @ block.T
        hit = linked(common.astype(np.int64), sizes[:, None] + sizes[None, :], threshold)
        for a, b in zip(*np.nonzero(np.tril(hit, -1)), strict=True):
            forest.join(int(a), int(b))
    return [(x, forest.root(x)) for x in range(n) if forest.root(x) != x]


def near_duplicates(documents: DataFrame, words: int, threshold: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles and component_id, the smallest key
    reachable by links, its own included.

    Texts without words (null, empty, white space) have no shingle, no link, and
    are their own component.  Repeated rows are copies of each other.  Null keys
    take part but are never the smallest; an empty table gives no rows.
    """
    classes = _classes(documents, words, threshold, key, text)
    return classes.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _classes(documents: DataFrame, words: int, threshold: int, key: str, text: str) -> DataFrame:
    """(k, h, n, component_id) per document: key, text hash, size of the set and
    smallest key of the class."""
    source = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    kind = source.schema["k"].dataType.simpleString()
    found = stored(_points(source, words, kind))
    points = found.where("counter = -1").select("k", "h", "n", "point", "sketch")
    counters = found.where("counter >= 0").groupBy("counter").agg(F.sum("n").alias("n")).collect()  # 2^17 rows at most
    frequency = np.zeros(1 << FREQUENCY_BITS, np.int64)
    for row in counters:
        frequency[row["counter"]] = row["n"]

    n_firsts = points.agg(F.sum(F.expr(f"n * {100 - threshold} div 100 + 1"))).first()[0] or 0
    firsts = _firsts(source, words, threshold, frequency, -(-n_firsts // BUCKET_FIRSTS) or 1)
    members = stored(_members(firsts, threshold).distinct())

    one = points.groupBy("point").agg(F.min(F.struct("k", "h")).alias("one"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    one = stored(one.join(members.select("point").distinct(), "point", "left_semi"))
    members = stored(_with_partner(members, one, threshold))
    one = stored(one.join(members.select("point").distinct(), "point", "left_semi").select("point", "one"))
    edges = stored(_all_links(members, source, one, words, threshold))
    label = components(edges)

    each = points.where("n > 0").groupBy("point").agg(F.min("k").alias("least"))
    named = each.join(label, each["point"] == label["node"], "left").select("point", "least", F.coalesce("component", "point").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_point = named.join(smallest, "component").select("point", "component_id")
    linked_rows = points.where("n > 0").join(of_point, "point").select("k", "h", "n", "component_id")
    alone = points.where("n = 0").select("k", "h", "n", F.col("k").alias("component_id"))
    return linked_rows.unionByName(alone)


def _points(source: DataFrame, words: int, kind: str) -> DataFrame:
    """A row per document (counter -1) with the size and digest of its set, and
    rows that count shingles by the leading bits of their hash."""
    names = ["k", "h", "n", "point", "sketch", "counter"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, like = np.zeros(1 << FREQUENCY_BITS, np.int64), None
        for batch in slices(batches, "t"):
            sets = shingle_sets(raw_texts(batch.column("t")), words)
            all_of = (np.concatenate(sets) >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)
            seen += np.bincount(all_of, minlength=len(seen))
            like = batch.column("k").type
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("h"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()), pa.array([-1] * len(sets), pa.int32())],
                names=names,
            )
        used = np.flatnonzero(seen)
        for at in range(0, len(used), 1 << 15):
            part = used[at : at + (1 << 15)]
            none = [pa.nulls(len(part), like), pa.nulls(len(part), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(seen[part]), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.binary()), pa.array(part.astype(np.int32))], names=names)

    return source.mapInArrow(lean(run), f"k {kind}, h long, n long, point long, sketch binary, counter int")


def pack_firsts(shingle: np.ndarray, point: np.ndarray, kind: np.ndarray, buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """First shingles by bucket: the bucket of each row, and its bytes.

    Of a hash its last 40 bits are kept, in order, byte plane by byte plane; of
    shingles that agree in them all, one region more is looked at, no link is lost.
    """
    short = shingle & np.uint64((1 << 8 * HASH_BYTES) - 1)
    order = np.argsort(short, kind="stable")
    short, point, kind = short[order], point[order], kind[order]
    bucket = (short * np.uint64(buckets) >> np.uint64(8 * HASH_BYTES)).astype(np.int64)
    cut = np.union1d(np.flatnonzero(np.diff(bucket, prepend=-1)), np.arange(0, len(bucket), ROW_FIRSTS))
    planes = short.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    parts = zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=True)
    return bucket[cut], [planes[a:b].T.tobytes() + point[a:b].tobytes() + kind[a:b].tobytes() for a, b in parts]


def unpack_firsts(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept part of the hash, point, kind) of packed first shingles."""
    n = len(packed) // FIRST_BYTES
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :HASH_BYTES] = np.frombuffer(packed, np.uint8, n * HASH_BYTES).reshape(HASH_BYTES, n).T
    point = np.frombuffer(packed, np.int64, n, n * HASH_BYTES)
    return planes.view(np.uint64)[:, 0], point, np.frombuffer(packed, np.uint8, n, n * (HASH_BYTES + 8))


def meeting(shingle: np.ndarray, point: np.ndarray, kind: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """(region, point) of the points that meet a possible partner at a shingle.

    A kind is twice the class of a size, and one more where the shingle is among
    the first of a smaller set.  Two points are possible partners if their classes
    are at most ``apart`` apart and the one of the smaller class is so marked (of
    one class: either).  In the order below the nearest of a point's possible
    partners above is the next point, below the last marked one.
    """
    order = np.lexsort((point, kind ^ np.uint8(1), shingle))
    shingle, point, kind = shingle[order], point[order], kind[order]
    same = np.zeros(len(shingle) + 1, bool)  # as the one before
    same[1:-1] = shingle[1:] == shingle[:-1]
    good = same[:-1] | same[1:]
    good[1:] &= ~(same[1:-1] & (point[1:] == point[:-1]))  # a copy
    shingle, point, kind = shingle[good], point[good], kind[good]
    if not len(shingle):
        return point, point
    size, marked = (kind >> np.uint8(1)).astype(np.int64), (kind & np.uint8(1)).astype(bool)
    above = np.zeros(len(shingle), bool)
    above[:-1] = marked[:-1] & (shingle[1:] == shingle[:-1]) & (size[1:] - size[:-1] <= apart)
    last = np.maximum.accumulate(np.where(marked, np.arange(len(shingle)), -1))
    last = np.concatenate([[-1], last[:-1]])
    below = (last >= 0) & (shingle[last] == shingle) & (size - size[last] <= apart)
    stays = above | below
    shingle, point = shingle[stays], point[stays]
    if not len(shingle):
        return point, point
    start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    region = np.repeat(np.minimum.reduceat(point, start), np.diff(np.append(start, len(shingle))))
    return region, point


def _firsts(source: DataFrame, words: int, threshold: int, frequency: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, firsts): the first shingles of all points, packed."""
    shared = source.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        shingle, point, kind, held, total = [], [], [], set(), 0

        def packed() -> pa.RecordBatch:
            bucket, parts = pack_firsts(np.concatenate(shingle), np.concatenate(point), np.concatenate(kind), buckets)
            return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(parts, pa.binary())], names=["bucket", "firsts"])

        for batch in slices(batches, "t"):
            for s in shingle_sets(raw_texts(batch.column("t")), words):
                name = set_id(s)
                if not len(s) or name in held:
                    continue
                held.add(name)
                order = np.lexsort((s, counts[(s >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)]))
                first = s[order[: _in_first(len(s), threshold)]]
                marks = np.full(len(first), 2 * size_class(len(s)), np.uint8)
                marks[: _in_first_of_smaller(len(s), threshold)] += 1
                shingle.append(first)
                point.append(np.full(len(first), name, np.int64))
                kind.append(marks)
                total += len(first)
                if total >= PACK_FIRSTS:
                    yield packed()
                    shingle, point, kind, held, total = [], [], [], set(), 0
        if total:
            yield packed()

    return source.select("t").mapInArrow(lean(run), "bucket long, firsts binary")


def _members(firsts: DataFrame, threshold: int) -> DataFrame:
    """(region, point) of the points that meet others at a first shingle; rows may repeat."""
    apart = classes_apart(threshold)
    dealt = firsts.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[tuple] = []

        def done() -> Iterator[pa.RecordBatch]:
            region, point = meeting(*(np.concatenate(x) for x in zip(*held, strict=True)), apart)
            if len(region):
                yield pa.RecordBatch.from_arrays([pa.array(region), pa.array(point)], names=["region", "point"])

        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("firsts").to_pylist(), strict=True):
                if bucket != now:
                    if held:
                        yield from done()
                    now, held = bucket, []
                held.append(unpack_firsts(packed))
        if held:
            yield from done()

    return dealt.mapInArrow(lean(run), "region long, point long")


def possible_groups(n: np.ndarray, sketches: np.ndarray, threshold: int) -> np.ndarray:
    """A number per point, equal for those that a chain of possible links joins: the
    sketches (a row each) allow a small enough difference."""
    order = np.argsort(n, kind="stable")
    n, fine = n[order], sketches[order].astype(np.int16)
    coarse = fine.reshape(len(n), -1, 4).sum(axis=2, dtype=np.int16)
    label = np.arange(len(n))
    least = np.searchsorted(n, -(-n * threshold // 100))  # the first that is not too small
    for i in range(len(n)):
        near = np.arange(least[i], i)
        for counts in (coarse, fine):
            if len(near):
                both = n[near] + n[i]
                apart = np.abs(counts[near] - counts[i]).sum(axis=1)
                near = near[linked((both - apart) // 2, both, threshold)]
        for other in np.unique(label[near]):
            if other != label[i]:
                low, high = sorted((other, label[i]))
                label[label == high] = low
    out = np.empty_like(label)
    out[order] = label
    return out


def _with_partner(members: DataFrame, one: DataFrame, threshold: int) -> DataFrame:
    """(region, point, n) of the members of a region that a link is possible for, as
    regions of what may be linked, named by the smallest point.  Points that meet in
    several regions meet in one of these.  Very large regions keep all members."""
    sizes = members.groupBy("region").agg(F.count("*").alias("size"))
    sized = members.join(sizes, "region").join(one.select("point", "n", "sketch"), "point")
    small = F.col("size") <= SKETCH_LEAVES * LEAF_POINTS
    dealt = sized.where(small).select("region", "point", "n", "sketch").repartition("region").sortWithinPartitions("region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: tuple[list, list, list] = ([], [], [])

        def done() -> Iterator[pa.RecordBatch]:
            if len(held[0]) < 2:
                return
            point, n = (np.array(x, np.int64) for x in held[:2])
            label = possible_groups(n, np.frombuffer(b"".join(held[2]), np.uint8).reshape(-1, SKETCH), threshold)
            order = np.argsort(label, kind="stable")
            start = np.flatnonzero(np.diff(label[order], prepend=-1))
            size = np.diff(np.append(start, len(order)))
            name = np.repeat(np.minimum.reduceat(point[order], start), size)
            good = np.repeat(size > 1, size)
            if good.any():
                yield pa.RecordBatch.from_arrays([pa.array(name[good]), pa.array(point[order][good]), pa.array(n[order][good])], names=["region", "point", "n"])

        for batch in batches:
            for region, *row in zip(*(batch.column(c).to_pylist() for c in ("region", "point", "n", "sketch")), strict=True):
                if region != now:
                    yield from done()
                    now, held = region, ([], [], [])
                for part, value in zip(held, row, strict=True):
                    part.append(value)
        yield from done()

    found = dealt.mapInArrow(lean(run), "region long, point long, n long")
    return found.unionByName(sized.where(~small).select("region", "point", "n")).distinct()


def _with_texts(points: DataFrame, source: DataFrame, one: DataFrame) -> DataFrame:
    """Rows of points with the text of one of their documents.

    A filter keeps most other texts from being moved; the join is exact.
    """
    wanted = one.select("point", F.col("one.k").alias("wk"), F.col("one.h").alias("wh"))
    some = by_flag(source.where("t is not null"), "h", hash_flags(wanted.select("wh"), TEXT_FLAG_BITS), True)
    rows = points.join(wanted, "point")
    return some.join(rows, (F.col("h") == F.col("wh")) & F.col("k").eqNullSafe(F.col("wk"))).select(*points.columns, "t")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            sets = shingle_sets(raw_texts(batch.column("t")), words)
            yield pa.RecordBatch.from_arrays([batch.column("point"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["point", "shingles"])

    return texts.mapInArrow(lean(run), "point long, shingles binary")


def _leaf() -> str:
    return f"size <= 16 or (size <= {LEAF_POINTS} and weight <= {LEAF_SHINGLES})"


def _all_links(members: DataFrame, source: DataFrame, one: DataFrame, words: int, threshold: int) -> DataFrame:
    """Links (a, b) of all regions; regions beyond a leaf are split first."""
    sizes = members.groupBy("region").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    large = stored(sizes.where(f"not ({_leaf()})"))
    if large.isEmpty():
        return _leaf_links(_with_texts(members.select("region", "point"), source, one), threshold, words).distinct()
    in_leaves = members.join(large, "region", "left_anti").select("region", "point")
    links = [_leaf_links(_with_texts(in_leaves, source, one), threshold, words)]
    of_large = members.join(large, "region")
    sets = _sets(_with_texts(of_large.select("point").distinct(), source, one), words)
    todo = stored(of_large.join(sets, "point").select("region", "point", "shingles", F.lit(None).cast("long").alias("parent_size")))
    for depth in range(DEPTH + 1):
        sizes = todo.groupBy("region").agg(F.count("*").alias("size"), F.sum(F.expr("octet_length(shingles) div 8")).alias("weight"), F.max("parent_size").alias("parent_size"))
        stuck = F.coalesce(F.col("size") > 0.7 * F.col("parent_size"), F.lit(False)) | F.lit(depth == DEPTH)
        large = stored(sizes.where(f"not ({_leaf()})").select("region", "size", "weight", stuck.alias("stuck")))
        links.append(_leaf_links(todo.join(large, "region", "left_anti"), threshold))
        if large.isEmpty():
            break
        rest = todo.drop("parent_size").join(large, "region")
        links.append(_leaf_links(_blocks(rest.where("stuck")), threshold))
        if depth == DEPTH:
            break
        todo = stored(_cells(rest.where("not stuck"), threshold, depth))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _cells(rest: DataFrame, threshold: int, depth: int) -> DataFrame:
    """Send each point to its Voronoi cell and to those whose window it is in."""
    chosen = F.pmod(F.xxhash64("point", F.lit(depth)), F.greatest(F.floor(F.col("size") / PIVOTS), F.lit(1)).cast("long")) == 0
    pivots = rest.where(chosen).groupBy("region").agg(F.collect_list("shingles").alias("pivots"))
    joined = rest.join(pivots, "region", "left").select("region", "point", "shingles", "size", "pivots")
    wide = 2 * (1 - threshold / 100) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for row in batch.to_pylist():
                mine = np.frombuffer(row["shingles"], np.uint64)
                pivots = [np.frombuffer(p, np.uint64) for p in row["pivots"] or []]
                far = []
                for p in pivots:
                    both = len(np.intersect1d(mine, p, assume_unique=True))
                    far.append(1 - both / (len(mine) + len(p) - both))
                near = [i for i, d in enumerate(far) if d <= min(far) + wide] if far else [-1]
                for i in near:
                    name = np.array([row["region"] & (2**64 - 1), depth, i + 1], np.uint64)
                    out[0].append(set_id(name))
                    out[1].append(row["point"])
                    out[2].append(row["shingles"])
                    out[3].append(row["size"])
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], names=["region", "point", "shingles", "parent_size"])

    return joined.mapInArrow(lean(run), "region long, point long, shingles binary, parent_size long")


def _blocks(rest: DataFrame) -> DataFrame:
    """Deal the points of a region into blocks; a new region for each two blocks."""
    by_weight = F.ceil(F.col("weight") * 2 / LEAF_SHINGLES)
    blocks = F.greatest(F.ceil(F.col("size") * 2 / LEAF_POINTS), F.least(by_weight, F.col("size")), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")
    each = rest.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))
    return each.select(pair.alias("region"), "point", "shingles")


def _leaf_links(regions: DataFrame, threshold: int, words: int | None = None) -> DataFrame:
    """Links of small regions; their points come with sets, or with texts to make
    sets of ``words`` words from."""
    what = "shingles" if words is None else "t"
    dealt = regions.select("region", "point", what).repartition("region").sortWithinPartitions("region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        points: list[int] = []
        sets: list[np.ndarray] = []

        def done() -> Iterator[pa.RecordBatch]:
            edges = join_region(sets, threshold) if len(points) > 1 else []
            if edges:
                ends = np.array(points, np.int64)[np.array(edges)]
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

        for batch in slices(batches, what):
            raw = raw_texts(batch.column(what))
            found = [np.frombuffer(x, np.uint64) for x in raw] if words is None else shingle_sets(raw, words)
            for region, point, shingles in zip(batch.column("region").to_pylist(), batch.column("point").to_pylist(), found, strict=True):
                if region != now:
                    yield from done()
                    now, points, sets = region, [], []
                points.append(point)
                sets.append(shingles)
        yield from done()

    return dealt.mapInArrow(lean(run), "a long, b long")


def one_of_each_class(documents: DataFrame, words: int, threshold: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest key of each class of near duplicates, all
    columns as they are.

    A row is judged by its key and its text's hash, so a text whose key also stands
    on a near copy of something else does not go with it.  Of the rows of one key
    that are left, the one with the smallest text hash stays (one of them, if they
    repeat key and text).  Texts without words are in no class.  Rows with a null
    key are never told apart and stay; an empty table gives no rows.  Whole texts
    are compared, however long.
    """
    classes = stored(_classes(documents, words, threshold, key, text).select("k", "h", "component_id"))
    losers = classes.where("k <> component_id").select("k", "h")
    repeated = stored(classes.where("k is not null").groupBy("k").count().where("count > 1").select("k"))
    several = not repeated.isEmpty()
    if several:
        left = classes.where("k = component_id").join(repeated, "k", "left_semi").select("k", "h")
        best = left.groupBy("k").agg(F.min("h").alias("best"))
        losers = losers.unionByName(left.join(best, "k").where("h <> best").select("k", "h"))
    gone = losers.distinct().toDF("__k", "__h")
    sure, rest = _parted(documents, F.xxhash64(text), gone.select("__h"))
    kept = sure.unionByName(rest.join(gone, (F.col(key) == F.col("__k")) & (F.xxhash64(text) == F.col("__h")), "left_anti"))
    if not several:
        return kept
    again = repeated.toDF("__k")
    sure, rest = _parted(kept, F.xxhash64(key), again.select(F.xxhash64("__k")))
    same = F.col(key) == F.col("__k")
    return sure.unionByName(rest.join(again, same, "left_anti")).unionByName(rest.join(again, same, "left_semi").dropDuplicates([key]))


def _parted(rows: DataFrame, value: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash surely is not among the given ones, which need no join
    and don't move, and all others."""
    flags, hashed = hash_flags(hashes, TEXT_FLAG_BITS), rows.withColumn("__x", value)
    return tuple(by_flag(hashed, "__x", flags, flagged).drop("__x") for flagged in (False, True))
