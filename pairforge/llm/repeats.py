"""Repeated byte strings of a corpus by run-length suffix indexes.

1. Anchors.  Of the 64-byte strings inside a window of ``length`` bytes, those
   with the smallest hash are anchors of the window; the choice depends on the
   window alone, so equal windows have equal anchors at equal places.  All
   windows around an anchor lie in its context, length - 64 bytes to each side.
2. Contexts that occur twice as a whole are repeats throughout: counting finds
   them.  Anchors with one context only are no repeats.  A window reaches half of
   what is missing to the left or to the right of its anchor, so a context that
   shares neither of these longer strings with another context has no repeat; it
   goes by hashes, before its bytes are fetched.
3. An anchor with very many contexts is replaced by longer ones: a window
   reaches half of what is missing to its left or to its right, so each context
   goes on with the string grown to either side, until few differing contexts
   share it or it is a whole window; then counting decides.  No group is gathered.
   Which sides are shared after the first step is known from step 2: the others
   have no rows, and only the bytes around a shared side are fetched.
4. Small groups are dealt into shards of bounded size.  A shard builds the
   suffix order and the Burrows-Wheeler transform of its contexts, keeps suffix
   positions and match lengths at run ends only, and streams the text: inside a
   run the match of a position is that of the position before less one byte.
   Matches of ``length`` or more are marked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import by_flag, hash_flags, lean, raw_texts, slices, stored, with_texts
from pairforge.llm.shingles import POWERS, mixed, prefix_hash

ANCHOR = 64
#: Contexts of an anchor that may meet in one shard, and bytes of a shard.
SMALL_GROUP, SHARD_BYTES = 1024, 1 << 20
#: Bytes of a long text that are read at once.
PIECE = 1 << 21


def _slide(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over each run of ``width`` values."""
    n, done, out = len(a), 1, a
    while 2 * done <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    return op(out[: n - width + 1], out[width - done : width - done + n - width + 1]) if done < width else out


def substring_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = POWERS.to(len(h))
    return mixed((h[end] - h[start]) * down[start] + (end - start).astype(np.uint64))


def anchors(texts: list[bytes], length: int, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text, place, context start, context end, anchor hash, context hash) of all
    anchors; texts shorter than ``length`` have none."""
    return grown_anchors(texts, length, anchor)[:6]


def grown_anchors(texts: list[bytes], length: int, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """``anchors`` and two more columns: the hashes of the anchor grown to the left
    and to the right by half of what a window has beside it, 0 where the text ends
    before."""
    size = min(anchor, length)
    some = [i for i, t in enumerate(texts) if len(t) >= length]
    if not some:
        return tuple(np.zeros(0, t) for t in (*[np.int64] * 4, *[np.uint64] * 4))
    lengths = np.array([len(texts[i]) for i in some], np.int64)
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    data = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
    h = prefix_hash(data)
    _, down = POWERS.to(len(h))
    grams = mixed((h[size:] - h[:-size]) * down[: len(h) - size]) | np.uint64(1)
    width = length - size + 1
    least = _slide(grams, width, np.minimum)  # one for each window start
    for b in base[1:]:  # windows that would cross from one text into the next
        least[max(0, b - length + 1) : b] = 0
    pad = np.zeros(width - 1, np.uint64)
    place = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), width, np.maximum) == grams)
    text = np.searchsorted(base, place, side="right") - 1
    start = np.maximum(base[text], place - (length - size))
    end = np.minimum(base[text] + lengths[text], place + length)
    context = substring_hash(h, start, end) + mixed((place - start).astype(np.uint64))
    at = base[text]
    half = -(-(length - size) // 2)
    sides = []
    for side, low in enumerate((place - half, place)):
        fits = (low >= at) & (low + size + half <= at + lengths[text])
        grown = np.zeros(len(place), np.uint64)
        # the sides are told apart, and none is 0
        grown[fits] = mixed(substring_hash(h, low[fits], low[fits] + size + half) + np.uint64(side)) | np.uint64(1)
        sides.append(grown)
    return np.array(some)[text], place - at, start - at, end - at, grams[place], context, *sides


def _pieces(text: bytes, length: int, size: int | None = None) -> Iterator[tuple[int, int, int, bytes]]:
    """Cut a long text into (offset, first place and end of the places that are the
    piece's own, bytes).  The margins are context only, so that each anchor comes
    from one piece, with all of its windows at hand."""
    size = size or PIECE
    if len(text) <= 2 * size:
        yield 0, 0, len(text), text
        return
    for a in range(0, len(text), size):
        low = max(0, a - 2 * length)
        yield low, a, a + size, text[low : a + size + 2 * length]


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only unresolved groups are sorted again.
    Places are 32-bit numbers while they fit."""
    n = len(data)
    place_type = np.int32 if n < 1 << 30 else np.int64
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key <<= np.uint64(8)
        key |= padded[j : j + n]
    order = np.argsort(key, kind="stable").astype(place_type)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    rank = np.empty(n, place_type)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=place_type), place_type(0)))
    step = 8
    head = np.concatenate([new, [True]])
    open_at = np.flatnonzero(~(head[:-1] & head[1:])).astype(place_type)  # places in groups of two or more
    while len(open_at) and step < 2 * n:
        suffix = order[open_at]
        combined = rank[suffix].astype(np.int64) * (n + 1)
        combined += np.where(suffix < n - step, rank[np.minimum(suffix, n - 1 - min(step, n - 1)) + min(step, n - 1)] + 1, 0)
        by = np.argsort(combined, kind="stable")
        suffix, combined = suffix[by], combined[by]
        order[open_at] = suffix
        new = np.concatenate([[True], combined[1:] != combined[:-1]])
        del by, combined
        rank[suffix] = np.maximum.accumulate(np.where(new, open_at, place_type(0)))
        ends = np.concatenate([new[1:], [True]])
        open_at = open_at[~(new & ends)]
        step *= 2
    return order


def common_lengths(h: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Bytes that the suffixes a and b have in common, by halving on hashes."""
    low, high = np.zeros(len(a), np.int64), n - np.maximum(a, b)
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = substring_hash(h, a, a + mid) == substring_hash(h, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


class RunIndex:
    """Run-length Burrows-Wheeler transform with suffix positions and match
    lengths sampled at the ends of runs."""

    def __init__(self, data: np.ndarray):
        self.n = n = len(data)
        order = suffix_order(data)
        bwt = data[order - 1]
        change = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.symbols, self.heads = bwt[np.concatenate([[0], change])], np.concatenate([[0], change])
        # sampled places: those where two runs meet, and both sides of the whole text,
        # before which there is nothing to take a match from
        whole = int(np.flatnonzero(order == 0)[0])
        border = np.unique(np.concatenate([change, [x for x in (whole, whole + 1) if 0 < x < n]])).astype(np.int64)
        upper, lower = order[border - 1], order[border]
        lce = common_lengths(prefix_hash(data), upper, lower, n)
        self.head_at, self.head_match, self.tail_at, self.tail_match = lower, lce, upper, lce

    def matches(self) -> np.ndarray:
        """Longest match of each position with any other, in text order."""
        reach = np.arange(self.n)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            np.maximum.at(reach, at, at + match)
        np.maximum.accumulate(reach, out=reach)
        reach -= np.arange(self.n)
        return reach


def shard_repeats(segments: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(segment, start, end) of all bytes inside a string of ``length`` bytes that
    starts a second time in the segments."""
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    data = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8) + np.uint8(1)  # no byte of UTF-8 is 255: separators are 0
    left = ends[np.searchsorted(ends, np.arange(len(data)))] - np.arange(len(data))
    hit = np.minimum(RunIndex(data).matches(), left) >= length
    cover = np.zeros(len(data) + length + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length, -1)
    inside = np.concatenate([[False], np.cumsum(cover)[: len(data)] > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        s = int(np.searchsorted(ends, a))
        begin = int(ends[s] - sizes[s])
        out.append((s, a - begin, b - begin))
    return out


def repeated_spans(documents: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", anchor: int = ANCHOR) -> DataFrame:
    """(k, h, spans): for each key and text hash with repeats, its spans.

    A span is a run of bytes of the UTF-8 text, each inside a string of
    ``length`` bytes that also starts elsewhere; spans may touch or overlap.
    """
    source = _source(documents, key, text)
    kind = source.schema["k"].dataType.simpleString()
    where = ["k", "h", "start", "end"]
    size = PIECE  # as it is here, not where the tasks run

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            texts, cut = raw_texts(batch.column("t")), []
            for i, t in enumerate(texts):
                cut += [(i, *p) for p in _pieces(t or b"", length, size)]
            found = grown_anchors([c[4] for c in cut], length, anchor)
            row, low, a, b = (np.array([c[j] for c in cut], np.int64)[found[0]] for j in range(4))
            keep = (found[1] + low >= a) & (found[1] + low < b)
            row = pa.array(row[keep])
            columns = [pa.array((found[j] + low)[keep]) for j in (1, 2, 3)] + [pa.array(x[keep].view(np.int64)) for x in found[4:]]
            yield pa.RecordBatch.from_arrays([batch.column("k").take(row), batch.column("h").take(row), *columns], names=[*where[:2], "place", *where[2:], "anchor", "context", "left", "right"])

    places = source.mapInArrow(lean(find), f"k {kind}, h long, place long, start long, end long, anchor long, context long, left long, right long")
    places = stored(places)
    twice = places.groupBy("anchor").agg(F.count("*").alias("total")).where("total > 1").select("anchor")
    places = stored(places.join(twice, "anchor"))
    contexts = stored(places.groupBy("anchor", "context").agg(F.count("*").alias("times"), F.min(F.struct("k", "h", "start", "end", "place", "left", "right")).alias("one")))
    whole = places.join(contexts.where("times > 1").select("anchor", "context"), ["anchor", "context"]).select(*where)

    sharing = _sharing(contexts)
    variants = sharing.groupBy("anchor").agg(F.count("*").alias("variants"))
    differing = sharing.join(variants, "anchor").select("anchor", "variants", "times", "one.*", "to_left", "to_right")
    content = stored(_contents(source, _wanted(differing, length, min(anchor, length)), kind))
    small, windows = _refined(content, length, min(anchor, length))
    shards = max(1, math.ceil((small.agg(F.sum(F.octet_length("content"))).first()[0] or 0) / SHARD_BYTES))
    marked = _sharded(small, shards, length, kind)
    # each branch is written on its own: run side by side, their sorts and Python
    # workers would share the executors' memory
    spans = stored(whole).unionByName(stored(windows.select(*where))).unionByName(stored(marked))
    return spans.groupBy("k", "h").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _source(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(F.col(key).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def _sharing(contexts: DataFrame) -> DataFrame:
    """The contexts that share a grown string with another context, and which of the
    two they share (to_left, to_right)."""
    several = contexts.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1").select("anchor")
    some = stored(contexts.join(several, "anchor"))
    sides = some.select("anchor", "context", F.posexplode(F.array("one.left", "one.right")).alias("at", "side")).where("side <> 0")
    shared = sides.groupBy("side").agg(F.count("*").alias("times")).where("times > 1").select("side")
    kept = sides.join(shared, "side").groupBy("anchor", "context").agg(F.max(F.col("at") == 0).alias("to_left"), F.max(F.col("at") == 1).alias("to_right"))
    return stored(some.join(kept, ["anchor", "context"]))


def _wanted(contexts: DataFrame, length: int, have: int) -> DataFrame:
    """The parts of the texts that go on: whole contexts of anchors with few of them
    (``low``, the place of the string they meet in, is the anchor's), else the windows
    around each grown string that is shared."""
    half = -(-(length - have) // 2)
    place = F.col("place")
    whole = F.array(F.struct("anchor", "variants", "start", "end", place.alias("low")))

    def around(shared: str, low: Column) -> Column:
        start, end = F.greatest(low + have + half - length, F.col("start")), F.least(low + length, F.col("end"))
        return F.when(F.col(shared), F.struct("anchor", "variants", start.alias("start"), end.alias("end"), low.alias("low")))

    sides = F.filter(F.array(around("to_left", place - half), around("to_right", place)), lambda part: part.isNotNull())
    return contexts.select("k", "h", F.when(F.col("variants") <= SMALL_GROUP, whole).otherwise(sides).alias("parts"))


def _contents(source: DataFrame, contexts: DataFrame, kind: str) -> DataFrame:
    """The bytes of parts of contexts.  A document has all of its parts in one row."""
    wanted = contexts.groupBy("k", "h").agg(F.flatten(F.collect_list("parts")).alias("list")).toDF("wk", "wh", "list")
    wanted = stored(wanted)
    some = by_flag(source, "h", hash_flags(wanted.select("wh")), True)
    one = some.join(wanted, (F.col("h") == F.col("wh")) & F.col("k").eqNullSafe(F.col("wk"))).select("k", "h", "t", "list")
    # rows repeated as a whole give the same contexts again
    slim = one.select("k", "h", F.explode("list").alias("c"), "t").select("k", "h", "c.*", F.expr("substring(cast(t as binary), cast(c.start + 1 as int), cast(c.end - c.start as int))").alias("content"))
    return slim.dropDuplicates(["k", "h", "anchor", "low"])


def _refined(content: DataFrame, length: int, have: int) -> tuple[DataFrame, DataFrame]:
    """(contexts in small groups, repeated spans), see step 3.

    A context that grew to one side can hold windows in a smaller part of it
    only.  Parts that are equal are repeats throughout, and one of them goes on.
    A grown string is named by its bytes alone: neighbouring anchors, and the ways
    to grow one, meet in strings at one place, whose part of the text (all of its
    windows) is one row then.
    """
    few = F.col("size") <= SMALL_GROUP
    small = [content.where(F.col("variants") <= SMALL_GROUP).select("k", "h", "start", "content", F.col("anchor").alias("group"))]
    spans = []
    now = stored(content.where(F.col("variants") > SMALL_GROUP).select("k", "h", "start", "content", (F.col("low") - F.col("start")).cast("int").alias("low")))
    half = -(-(length - have) // 2)
    have += half
    sides = now
    while half and not now.isEmpty():
        group = F.xxhash64(F.expr(f"substring(content, low + 1, {have})"))
        # windows around [low, low + have) reach from low + have - length to low + length
        cut = F.greatest(F.col("low") + have - length, F.lit(0))
        part = sides.select("k", "h", "start", "low", "content", group.alias("group"), cut.alias("cut"))
        part = part.select("k", "h", (F.col("start") + F.col("cut")).alias("start"), (F.col("low") - F.col("cut")).alias("low"), F.expr(f"substring(content, cut + 1, low - cut + {length})").alias("content"), "group")
        part = stored(part.where(f"octet_length(content) >= {length}").withColumn("same", F.xxhash64("content", "low")).dropDuplicates(["k", "h", "start", "group", "same"]))
        parts = part.groupBy("group", "same").agg(F.count("*").alias("times"), F.min(F.struct("k", "h", "start")).alias("one"))
        again = parts.where("times > 1").select("group", "same")
        spans.append(part.join(again, ["group", "same"]).select("k", "h", "start", (F.col("start") + F.octet_length("content")).alias("end")))
        if have >= length:
            break
        sizes = parts.groupBy("group").agg(F.count("*").alias("size")).where("size > 1")
        chosen = parts.join(sizes, "group").select(F.col("group").alias("g"), F.col("same").alias("s"), "one", "size")
        is_one = (F.col("group") == F.col("g")) & (F.col("same") == F.col("s")) & F.struct("k", "h", "start").eqNullSafe(F.col("one"))
        sized = stored(part.join(chosen, is_one).select("k", "h", "start", "content", "group", "low", "size"))
        small.append(sized.where(few).select("k", "h", "start", "content", "group"))
        now = stored(sized.where(~few).drop("size", "group"))
        half = -(-(length - have) // 2)
        have += half
        sides = now.withColumn("low", F.explode(F.array(F.col("low") - half, F.col("low")))).where(f"low >= 0 and low + {have} <= octet_length(content)")
    every, found = small[0], content.where("false").select("k", "h", "start", F.col("start").alias("end"))
    for more in small[1:]:
        every = every.unionByName(more)
    for more in spans:
        found = found.unionByName(more)
    return stored(every), found


def _sharded(small: DataFrame, shards: int, length: int, kind: str) -> DataFrame:
    shard = F.pmod(F.xxhash64("group"), F.lit(shards)).cast("int")
    dealt = small.select(shard.alias("shard"), "k", "h", "start", "content").repartition("shard").sortWithinPartitions("shard", "k", "h", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[list] = []  # k, h, start, bytes: parts of the corpus that don't overlap

        def done() -> Iterator[pa.RecordBatch]:
            found = shard_repeats([bytes(x[3]) for x in held], length) if held else []
            if found:
                rows = [(held[s][0], held[s][1], held[s][2] + a, held[s][2] + b) for s, a, b in found]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (key_type, pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["k", "h", "start", "end"])

        for batch in batches:
            key_type = batch.column("k").type
            for shard, k, h, start, content in zip(*(batch.column(c).to_pylist() for c in ("shard", "k", "h", "start", "content")), strict=True):
                if shard != now:
                    yield from done()
                    now, held = shard, []
                last = held[-1] if held else None
                if last and (last[0], last[1]) == (k, h) and start <= last[2] + len(last[3]):
                    if start + len(content) > last[2] + len(last[3]):
                        last[3] += content[last[2] + len(last[3]) - start :]
                else:
                    held.append([k, h, start, bytearray(content)])
        yield from done()

    return dealt.mapInArrow(lean(run), f"k {kind}, h long, start long, end long")


def _runs(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted spans, joined where they touch."""
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["end"]))
        else:
            out.append((s["start"], s["end"]))
    return out


def _cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for r in runs for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def _whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, shrunk so that no character is cut in two."""
    out = []
    for a, b in runs:
        while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        out.append((a, b))
    return out


def _with_spans(rows: DataFrame, spans: DataFrame, key: str, text_hash: str) -> tuple[DataFrame, DataFrame]:
    """(the rows that may have spans, with them as ``__spans``; the rows that surely
    have none).  The latter are not moved, and their texts need not go to Python."""
    spans = stored(spans.toDF("__k", "__h", "__spans"))
    flags = hash_flags(spans.select("__h"))
    same = (F.col(text_hash) == F.col("__h")) & F.col(key).eqNullSafe(F.col("__k"))
    some = by_flag(rows, text_hash, flags, True).join(spans, same, "left").drop("__k", "__h")
    return some, by_flag(rows, text_hash, flags, False)


def texts_without_repeats(documents: DataFrame, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their repeats taken out of the text, character-wise;
    those of which nothing but white space is left then go.  Other columns, and
    documents without repeats, stay as they are."""
    hashed = documents.withColumn("__hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined, whole = _with_spans(hashed, repeated_spans(documents, length, key, text), key, "__hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [_runs(s) for s in batch.column("__spans").to_pylist()]
            texts = [t and _cut(t, _whole_characters(t, r)) for t, r in zip(raw_texts(batch.column(text)), found, strict=True)]
            keep = pa.array([not r or bool(t.strip()) for t, r in zip(texts, found, strict=True)])
            yield with_texts(batch.drop_columns(["__spans"]), text, texts).filter(keep)

    return joined.drop("__hash").mapInArrow(lean(run), documents.schema).unionByName(whole.drop("__hash"))


def without_repeats(documents: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", anchor: int = ANCHOR) -> DataFrame:
    """One row per document: key, n_bytes, spans (array of start, end; maximal
    removed runs) and kept (the remaining bytes).

    Null text counts as empty.  Rows repeated as a whole repeat each other; null
    keys take part; an empty table gives no rows.  Other columns aren't read.
    """
    source = _source(documents, key, text)
    joined, whole = _with_spans(source, repeated_spans(documents, length, key, text, anchor), "k", "h")
    kind = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            texts = raw_texts(batch.column("t"))
            runs = [_runs(found) for found in batch.column("spans").to_pylist()]
            merged = [[{"start": a, "end": b} for a, b in r] for r in runs]
            kept = [_cut(t, r) for t, r in zip(texts, runs, strict=True)]
            sizes = list(map(len, texts))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(sizes, pa.int64()), pa.array(merged, span), pa.array(kept, pa.binary())], names=["k", "n_bytes", "spans", "kept"])

    spans = "array<struct<start:bigint,end:bigint>>"
    cut = joined.select("k", "t", F.col("__spans").alias("spans")).mapInArrow(lean(run), f"k {kind}, n_bytes long, spans {spans}, kept binary")
    none = whole.select("k", F.octet_length("t").cast("long").alias("n_bytes"), F.array().cast(spans).alias("spans"), F.col("t").cast("binary").alias("kept"))
    return cut.unionByName(none).withColumnRenamed("k", key)
