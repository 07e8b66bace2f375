"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of whole documents of one task.  Its symbols are the words that
occur in a benchmark; a stretch of the shard that no benchmark window can lie in
(a word, or two neighbouring words, that no benchmark has) is one separator, so
that the index holds only what could match.  Every benchmark window is searched
backwards through the ranks of a wavelet tree; its occurrences are located by
walking to the next sampled suffix position; the spans of a document are merged.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import lean, raw_texts, slices, with_texts

#: Text per shard, and items whose windows are searched for at once.
SHARD_BYTES, ITEMS_AT_ONCE = 1 << 22, 20_000
#: Every so many places of a shard keep their suffix position.
SAMPLE = 16

_KEPT = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII bytes."""
    return (text or b"").translate(_KEPT).split()


class WaveletTree:
    """Rank of any symbol before any place, by one bit vector per bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, now = bits, [], symbols.astype(np.int64)
        for level in range(bits - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            zeros = len(now) - int(ones[-1])
            self.levels.append((level, ones, zeros))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        start, end = np.zeros_like(place), place.copy()
        for level, ones, zeros in self.levels:
            bit = ((symbol >> level) & 1).astype(bool)
            a, b = ones[start], ones[end]
            start, end = np.where(bit, zeros + a, start - a), np.where(bit, zeros + b, end - b)
        return end - start


class FMIndex:
    """Self-index of a sequence of symbols 1.. with separators 0."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.n = n = len(symbols)
        self.bits = max(1, largest.bit_length())
        order = self._suffixes(symbols)
        self.bwt = symbols[order - 1].astype(np.int64)
        counts = np.bincount(symbols, minlength=1 << self.bits)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletTree(self.bwt, self.bits)
        # no walk crosses a separator: separators are all alike, so their order says nothing
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> np.ndarray:
        n, step = len(symbols), 1
        rank = symbols.astype(np.int64)
        while True:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * (max(n, int(rank.max())) + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            step *= 2
            if new[-1] == n - 1 or step >= n:
                return order

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places [low, high) of the suffixes that start with each window; the
        windows, rows of symbols, are read backwards all at once."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        live = np.arange(len(windows))
        for column in range(windows.shape[1] - 1, -1, -1):
            c = windows[live, column]
            low[live] = self.below[c] + self.tree.rank(c, low[live])
            high[live] = self.below[c] + self.tree.rank(c, high[live])
            live = live[low[live] < high[live]]
        low[low > high] = 0
        high[low >= high] = low[low >= high]
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Suffix positions, by steps towards the front until a sampled place."""
        out, steps = np.empty(len(places), np.int64), 0
        at, left = places.copy(), np.arange(len(places))
        while len(left):
            there = self.sampled[at]
            out[left[there]] = self.samples[self.sample_rank[at[there]]] + steps
            left, at = left[~there], at[~there]
            c = self.bwt[at]
            at = self.below[c] + self.tree.rank(c, at)
            steps += 1
        return out


class Windows:
    """All windows of the items of one benchmark block."""

    def __init__(self, items: list[tuple], size: int):
        self.size, self.ids = size, {}
        by: dict[tuple, set] = {}
        pairs: set[tuple[int, int]] = set()
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            pairs.update(zip(words, words[1:], strict=False))
            for i in range(max(1, len(words) - size + 1) if words else 0):
                by.setdefault(tuple(words[i : i + size]), set()).add(str(item))
        self.pairs = np.unique(np.array([a << 32 | b for a, b in pairs], np.int64))
        self.short = min((len(w) for w in by), default=0)
        self.groups = []
        for length in sorted({len(w) for w in by}):
            some = [w for w in by if len(w) == length]
            self.groups.append((np.array(some, np.int64), [sorted(by[w]) for w in some]))

    def kept(self, symbols: np.ndarray) -> np.ndarray:
        """Places that a window could cover: in a stretch of at least the shortest
        window's words whose neighbours all are neighbours in some item."""
        joined = (symbols[:-1] << 32) | symbols[1:]
        at = np.searchsorted(self.pairs, joined)
        follows = np.zeros(len(joined), bool)
        if len(self.pairs):
            follows = self.pairs[np.minimum(at, len(self.pairs) - 1)] == joined
        run = np.concatenate([[0], np.cumsum(~follows)])  # stretch of each place
        length = np.bincount(run)[run]
        return (symbols > 0) & (length >= self.short)

    def hits(self, documents: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """For each document the word spans of the occurrences, and the items."""
        spans: list[list[tuple[int, int]]] = [[] for _ in documents]
        items: list[set[str]] = [set() for _ in documents]
        get = self.ids.get
        found = [np.fromiter((get(w, 0) for w in d), np.int64, len(d)) for d in documents]
        symbols = np.concatenate([x for f in found for x in (f, [0])]) if found else np.zeros(0, np.int64)
        if not len(symbols) or not self.groups:
            return spans, items
        keep = self.kept(symbols)
        if not keep.any():
            return spans, items
        first = keep & ~np.concatenate([[False], keep[:-1]])
        # a stretch is preceded by one separator; place[] leads back to the shard
        order = np.sort(np.concatenate([np.flatnonzero(keep), np.flatnonzero(first) - 0.5]))
        place = np.ceil(order).astype(np.int64)
        body = np.where(order == place, symbols[place], 0)
        body, place = np.append(body, 0), np.append(place, len(symbols))
        index = FMIndex(body, len(self.ids))
        starts = np.cumsum([0] + [len(f) + 1 for f in found])
        for windows, owners in self.groups:
            low, high = index.search(windows)
            times = high - low
            which = np.repeat(np.arange(len(windows)), times)
            offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = place[index.locate(np.repeat(low, times) + offset)]
            document = np.searchsorted(starts, at, side="right") - 1
            for w, d, a in zip(which.tolist(), document.tolist(), (at - starts[document]).tolist(), strict=True):
                spans[d].append((a, a + windows.shape[1]))
                items[d].update(owners[w])
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: key, n_words, spans (array of start, end in words,
    merged) and items (ids of the items with occurring windows, as sorted strings).

    A window is ``window`` consecutive words of an item, or a shorter item as a
    whole.  Null texts have no words; null item ids are called "null".  Items are
    searched for in blocks of ``ITEMS_AT_ONCE``, each sent to all tasks and each
    tried on every document, so the size of what is sent is bounded.  Rows are
    treated one by one: repeated rows and null keys get a row each.
    """
    source = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = source.schema["k"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    find = _finder(benchmark, window, item, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = find()
        for batch in slices(batches, "t", SHARD_BYTES):
            texts = [words_of(t) for t in raw_texts(batch.column("t"))]
            spans, items = hits(texts)
            found = [[{"start": a, "end": b} for a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(map(len, texts), pa.int64()), pa.array(found, span), pa.array(map(sorted, items), pa.list_(pa.string()))],
                names=["k", "n_words", "spans", "items"],
            )

    found = source.mapInArrow(lean(run), f"k {kind}, n_words long, spans array<struct<start:int,end:int>>, items array<string>")
    return found.withColumnRenamed("k", key)


def texts_without_hits(documents: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with the words of benchmark windows, and what is between
    them, taken out of the text; those of which no word is left then go.  Other
    columns, and documents without a hit, stay as they are."""
    find = _finder(benchmark, window, item, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = find()
        for batch in slices(batches, text, SHARD_BYTES):
            raw = raw_texts(batch.column(text))
            spans, _ = hits([words_of(t) for t in raw])
            texts = [_without_words(t, s) if s else t for t, s in zip(raw, spans, strict=True)]
            keep = pa.array([not s or bool(words_of(t)) for t, s in zip(texts, spans, strict=True)])
            yield with_texts(batch, text, texts).filter(keep)

    return documents.mapInArrow(lean(run), documents.schema)


def _without_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_KEPT))]
    cuts = [0, *(x for a, b in spans for x in (places[a][0], places[b - 1][1])), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def _finder(benchmark: DataFrame, window: int, item: str, item_text: str) -> Callable:
    """A function that, called in a task, gives the search over all item blocks."""
    context, blocks = benchmark.sparkSession.sparkContext, []
    part: list[tuple] = []
    for row in benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("i"), F.col(item_text).alias("t")).toLocalIterator():
        part.append((row["i"], (row["t"] or "").encode()))
        if len(part) == ITEMS_AT_ONCE:
            blocks.append(context.broadcast(part))
            part = []
    blocks.append(context.broadcast(part))

    def find() -> Callable:
        one = Windows(blocks[0].value, window) if len(blocks) == 1 else None

        def hits(texts: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
            spans: list[list] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            for block in blocks:
                more_spans, more_items = (one or Windows(block.value, window)).hits(texts)
                for d in range(len(texts)):
                    spans[d] += more_spans[d]
                    items[d] |= more_items[d]
            return [merged(s) for s in spans], items

        return hits

    return find
