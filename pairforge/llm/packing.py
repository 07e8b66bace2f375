"""Best-fit packing of token pieces by a grouping genetic algorithm.

Pieces are dealt at random into blocks of bounded size.  Each block is packed by
several islands, each with a population of its own; after every round an
island's best packing migrates to the next island of the block.  A gene is a
whole bin: crossover injects well-filled bins of one parent into the other,
drops the bins that hold one of their pieces a second time, and puts the
displaced pieces back by best fit.  A block stops at its lower bound.  Bins that
stay underfilled are opened once more and packed together across blocks.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import lean, raw_texts, slices, stored
from pairforge.llm.tokens import WordEncoder

#: Pieces per block, on average.
BLOCK_PIECES = 4096
ISLANDS, ROUNDS, POPULATION, CHILDREN = 3, 2, 4, 12
#: Bins filled below this share are opened again across blocks.
WELL_FILLED = 0.995

Bins = list[list[int]]


def filled(items: list[int], lengths: list[int]) -> int:
    return sum(map(lengths.__getitem__, items))


def best_fit(bins: Bins, items: list[int], lengths: list[int], limit: int) -> Bins:
    """Put items, in the given order, each where the least room is left over."""
    room = [limit - filled(b, lengths) for b in bins]
    order = sorted((r, b) for b, r in enumerate(room) if r)
    for item in items:
        n = lengths[item]
        at = bisect_left(order, (n, -1))
        if at < len(order):
            left, b = order.pop(at)
            bins[b].append(item)
        else:
            left, b = limit, len(bins)
            bins.append([item])
        if left > n:
            insort(order, (left - n, b))
    return bins


def longest_first(items, lengths: list[int]) -> list[int]:
    return sorted(items, key=lambda i: -lengths[i])


def fitness(bins: Bins, lengths: list[int], limit: int) -> float:
    """Mean squared fill: of two packings, the one with fuller bins is nearer to
    one bin less."""
    return sum([(filled(b, lengths) / limit) ** 2 for b in bins]) / max(len(bins), 1)


def crossover(a: Bins, b: Bins, lengths: list[int], limit: int, draw: random.Random) -> Bins:
    """A child of b with some well-filled whole bins of a."""
    full = sorted(a, key=lambda g: -filled(g, lengths))
    some = full[: max(1, len(full) // 2)]
    injected = [list(g) for g in draw.sample(some, max(1, len(some) // 2))]
    taken = {i for g in injected for i in g}
    kept, displaced = [], []
    for g in b:
        if taken.isdisjoint(g):
            kept.append(list(g))
        else:
            displaced += [i for i in g if i not in taken]
    kept.sort(key=lambda g: filled(g, lengths))
    opened = min(len(kept), draw.randint(1, 4))  # mutation: the least filled bins are opened
    displaced += [i for g in kept[:opened] for i in g]
    return best_fit(injected + kept[opened:], longest_first(displaced, lengths), lengths, limit)


def evolve(population: list[Bins], lengths: list[int], limit: int, draw: random.Random) -> list[Bins]:
    """Fill up a population, breed it, and return it best first.

    It ends early once a packing has as few bins as the lengths allow.
    """
    least = -(-sum(lengths) // limit)
    known: dict[int, tuple[Bins, tuple[int, float]]] = {}  # a packing is measured once

    def worth(p: Bins) -> tuple[int, float]:
        if id(p) not in known:
            known[id(p)] = p, (-len(p), fitness(p, lengths, limit))
        return known[id(p)][1]

    while len(population) < POPULATION and not any(len(p) <= least for p in population):
        if not population:
            population.append(best_fit([], longest_first(range(len(lengths)), lengths), lengths, limit))
            continue
        opened = draw.sample(population[0], max(1, len(population[0]) // 3))
        ids = {id(g) for g in opened}
        bins = [list(g) for g in population[0] if id(g) not in ids]
        items = [i for g in opened for i in g]
        draw.shuffle(items)
        population.append(best_fit(bins, items, lengths, limit))  # in any order: another packing to breed with
    population.sort(key=worth, reverse=True)
    for _ in range(CHILDREN):
        if not lengths or len(population[0]) <= least:
            break
        a, b = draw.sample(population, 2) if len(population) > 1 else population * 2
        population.append(crossover(a, b, lengths, limit, draw))
        population.sort(key=worth, reverse=True)
        del population[POPULATION:]
    return population


def _as_bytes(bins: Bins, n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for b, items in enumerate(bins):
        out[items] = b
    return out.tobytes()


def _as_bins(packed: bytes) -> Bins:
    of = np.frombuffer(packed, np.int32)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    return [g.tolist() for g in np.split(order, cuts)] if len(of) else []


def pack_pieces(pieces: DataFrame, limit: int, seed: int = 0) -> DataFrame:
    """Sequence and offset of each piece.

    ``pieces`` is a stored table with a unique long ``row`` and a ``length`` of 1
    to ``limit``.  Returns row, sequence_id, offset.
    """
    done, rest = [], pieces.select("row", "length")
    for level in range(2):
        count = rest.count()
        blocks = max(1, -(-count // BLOCK_PIECES))
        packed = stored(_packed(rest, blocks, limit, seed + level, level))
        if level or blocks == 1:
            done.append(packed)
            break
        full = F.col("filled") >= int(WELL_FILLED * limit)
        done.append(packed.where(full))
        rest = packed.where(~full).select("row", "length")
    out = done[0] if len(done) == 1 else done[0].unionByName(done[1])
    return out.select("row", "sequence_id", "offset")


def _packed(rest: DataFrame, blocks: int, limit: int, seed: int, level: int) -> DataFrame:
    deal = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(blocks)).cast("long")
    block = rest.groupBy(deal.alias("block")).agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("items"))
    state = block.select(
        "block",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.transform("items", lambda x: x["row"]).alias("rows"),
        F.transform("items", lambda x: x["length"].cast("long")).alias("lengths"),
        F.array().cast("array<binary>").alias("population"),
    )
    schema = "block long, island int, rows array<long>, lengths array<long>, population array<binary>, bins int, fit double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                block, island, lengths = row.column("block")[0].as_py(), row.column("island")[0].as_py(), row.column("lengths")[0].as_py()
                draw = random.Random(f"{seed}/{block}/{island}")
                old = [_as_bins(p) for p in row.column("population")[0].as_py()]
                new = evolve(old, lengths, limit, draw)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(row.column(c) for c in ("block", "island", "rows", "lengths")),
                        pa.array([[_as_bytes(p, len(lengths)) for p in new]], pa.list_(pa.binary())),
                        pa.array([len(new[0])], pa.int32()),
                        pa.array([fitness(new[0], lengths, limit)], pa.float64()),
                    ],
                    names=["block", "island", "rows", "lengths", "population", "bins", "fit"],
                )

    ring = Window.partitionBy("block").orderBy("island")
    for turn in range(ROUNDS):
        if turn:  # each island gets the best packing of the one before it in the ring
            elite = F.coalesce(F.lag(F.element_at("population", 1)).over(ring), F.last(F.element_at("population", 1)).over(ring.rowsBetween(0, Window.unboundedFollowing)))
            state = state.withColumn("population", F.concat(F.array(elite), "population")).drop("bins", "fit")
        state = stored(state.mapInArrow(lean(run), schema))
    best = state.groupBy("block").agg(F.max_by(F.struct("rows", "lengths", F.element_at("population", 1).alias("of")), F.struct(-F.col("bins"), "fit", "island")).alias("b"))

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, best = batch.column("block")[at].as_py(), batch.column("b")[at].as_py()
                of, n = np.frombuffer(best["of"], np.int32).astype(np.int64), np.array(best["lengths"], np.int64)
                order = np.argsort(of, kind="stable")
                ends = np.cumsum(n[order])
                first = np.searchsorted(of[order], np.arange(of.max() + 1))
                offsets = (ends - n[order]) - (ends - n[order])[first][of[order]]
                filled = np.bincount(of, weights=n).astype(np.int64)[of[order]]
                arrays = [np.array(best["rows"], np.int64)[order], n[order], (((np.int64(level) << 31) + block) << 31) + of[order], offsets, filled]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["row", "length", "sequence_id", "offset", "filled"])

    return best.mapInArrow(lean(laid), "row long, length long, sequence_id long, offset long, filled long")


def token_pieces(documents: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut each document (its ids, then ``end_id``) every ``limit`` ids.

    Null text is the end id alone.  Returns the stored table row (unique), key,
    piece, start, length, ids_crc32.  Repeated rows give pieces of their own.
    """
    source = documents.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = WordEncoder(tokenizer), TaskContext.get().partitionId() << 40
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches, "t", 1 << 22):
            ids = [x + end for x in encoder.encode([t.decode() for t in raw_texts(batch.column("t"))])]
            at, piece, start, length, crc = [], [], [], [], []
            for doc, x in enumerate(ids):
                for p in range(-(-len(x) // (4 * limit))):
                    part = x[4 * limit * p : 4 * limit * (p + 1)]
                    at.append(doc)
                    piece.append(p)
                    start.append(p * limit)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            rows = np.arange(row, row + len(at))
            row += len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column("k").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["row", "k", "piece", "start", "length", "ids_crc32"],
            )

    kind = source.schema["k"].dataType.simpleString()
    return stored(source.mapInArrow(lean(run), f"row long, k {kind}, piece int, start long, length long, ids_crc32 long")).withColumnRenamed("k", key)


def packed_documents(documents: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``limit`` tokens.

    One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.
    Only longer documents are cut.  An empty table gives no rows; null keys and
    repeated rows are kept.
    """
    pieces = token_pieces(documents, tokenizer, limit, end_id, key, text)
    return pieces.join(pack_pieces(pieces, limit), "row").drop("row")
