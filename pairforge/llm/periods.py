"""Periodic runs of words by multi-scale minimizers.

A run is a longest stretch of words that repeats with its smallest period q at
least ``exponent`` times.  Inside a run, two windows a period apart hold the same
words, so the least k-gram of one stands q after that of the other.  Scale s looks
for periods from 2^s to 2^(s+1) - 1 with k = 2^(s+1) and windows of 2^s k-grams:
two such windows and the period between them fit into four periods, and a k-gram
not shorter than the period occurs once a period, so the next equal minimizer is
exactly q away.  Each such pair is a seed; comparing words at distance q from it
gives the stretch.  Periods below 2^``FIRST_SCALE`` are found by comparing the
words with themselves at each of these lags.

k-grams are named by doubling (names of 2k from pairs of names of k, within one
document), so equal names are equal words and nothing depends on a hash.  A k-gram
that stands once in its document can't be part of a run; only the others go on to
the next scale.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import let
from pairforge.llm.common import raw_texts, slices

#: Periods below 2^3 are scanned lag by lag.
FIRST_SCALE = 3

RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``least`` true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    a, b = edges[0::2], edges[1::2]
    long = b - a >= least
    return a[long], b[long]


def _reach(x: np.ndarray, i: int, q: int, step: int) -> int:
    """The last place to which words from ``i`` on equal those q later; with
    ``step`` -1 the first place before ``i``."""
    size, n = 64, len(x) - q
    while (i < n) if step > 0 else (i > 0):
        a, b = (i, min(i + size, n)) if step > 0 else (max(i - size, 0), i)
        other = np.flatnonzero(x[a:b] != x[a + q : b + q])
        if len(other):
            return a + int(other[0]) if step > 0 else a + int(other[-1]) + 1
        i, size = (b if step > 0 else a), min(4 * size, 1 << 16)
    return i


def _doubled(names: np.ndarray, k: int) -> np.ndarray:
    """Names of 2k-grams from those of k-grams; -1 where a gram occurs once."""
    out = np.full(len(names), -1, np.int64)
    at = np.flatnonzero((names[: len(names) - k] >= 0) & (names[k:] >= 0)) if len(names) > k else np.empty(0, np.int64)
    if len(at):
        pair = names[at] * (int(names.max()) + 1) + names[at + k]
        _, name, times = np.unique(pair, return_inverse=True, return_counts=True)
        many = times[name] > 1
        out[at[many]] = name[many]
    return out


def _minimizers(names: np.ndarray, window: int) -> np.ndarray:
    """Places of the least k-gram of each window; windows that hold a k-gram
    without a name can't lie in a run and give none."""
    start, end = _stretches(names >= 0, 2 * window + 1)
    if not len(start):
        return start
    size = end - start
    at = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    # an odd factor orders names in a way that text order doesn't show through
    order = (names[at] * 0x9E3779B1 & 0x7FFFFFFF) << 32 | np.arange(len(at))
    reach = 1
    while reach < window:
        order = np.minimum(order[:-reach], order[reach:])
        reach *= 2
    inside = at[window - 1 :] - at[: len(at) - window + 1] == window - 1
    return at[np.unique(order[inside] & 0xFFFFFFFF)]


def _seeds(names: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, place) of neighbouring equal minimizers, in that order."""
    at = _minimizers(names, 1 << scale)
    at = at[np.lexsort((at, names[at]))]
    gap = np.diff(at)
    good = (names[at[1:]] == names[at[:-1]]) & (gap >> scale == 1) if len(at) else np.empty(0, bool)
    q, m = gap[good], at[:-1][good]
    rank = np.lexsort((m, q))
    return q[rank], m[rank]


def runs_of(x: np.ndarray, names: np.ndarray, longest: int, exponent: int = 4, shortest: int = 6) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``x``, by start, then period.

    ``x`` numbers the words of one or more documents, with a number of its own
    after each document; ``names`` numbers them apart in each document, -1 where a
    word occurs once in its document; ``longest`` is the longest document.
    """
    if exponent < 4:
        raise ValueError("two windows of a scale need four periods")
    found: list[tuple[int, int, int]] = []
    for q in range(1, min(1 << FIRST_SCALE, longest // exponent + 1)):
        a, b = _stretches(x[:-q] == x[q:], max(shortest, exponent * q) - q)
        found += zip(a.tolist(), (b - a + q).tolist(), [q] * len(a), strict=True)
    scale, k = 0, 1
    while exponent << scale <= longest and (names >= 0).any():
        names, k = _doubled(names, k), 2 * k
        if scale >= FIRST_SCALE:
            periods, places = _seeds(names, scale)
            i = 0
            while i < len(places):
                q, m = int(periods[i]), int(places[i])
                a, b = _reach(x, m, q, -1), _reach(x, m, q, 1)
                if b - a + q >= max(shortest, exponent * q):
                    found.append((a, b - a + q, q))
                last = int(np.searchsorted(periods, q, "right"))
                i += max(1, int(np.searchsorted(places[i:last], b)))
        scale += 1
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.array(found, np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # a multiple of the smallest period gives the same stretch
    fresh = np.concatenate([[True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)])
    rows = rows[fresh]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _batch_runs(words: list[list[bytes]], exponent: int, shortest: int) -> list[np.ndarray]:
    """The runs of each document of a batch."""
    n = np.array([len(w) for w in words], np.int64)
    ids = pa.array([w for doc in words for w in doc], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.cumsum(n + 1) - (n + 1)
    x = np.empty(int((n + 1).sum()), np.int64)
    end = np.zeros(len(x), bool)
    end[first + n] = True
    x[end], x[~end] = -1 - np.arange(len(words)), ids
    names = np.full(len(x), -1, np.int64)
    own = np.repeat(np.arange(len(words)), n) * (int(ids.max(initial=0)) + 1) + ids
    _, name, times = np.unique(own, return_inverse=True, return_counts=True)
    names[~end] = np.where(times[name] > 1, name, -1) if len(own) else []
    rows = runs_of(x, names, int(n.max(initial=0)), exponent, shortest)
    doc = np.searchsorted(first, rows[:, 0], "right") - 1
    rows[:, 0] -= first[doc]
    cut = np.searchsorted(doc, np.arange(len(words) + 1))
    return [rows[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and those of each run's first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text", exponent: int = 4, shortest: int = 6) -> DataFrame:
    """Adds ``n_words``, ``runs`` (start, length, period, by start, then period)
    and ``collapsed`` in place of ``text``: the words without those that a run
    contains after its first period, joined by one space.

    Words are what ASCII white space separates.  A run repeats at least
    ``exponent`` times (4 or more) and has at least ``shortest`` words; runs may
    overlap, and all are given.  A null or empty text has no words, no runs and an
    empty ``collapsed``.  Rows are treated one by one: repeated rows and keys, null
    keys and an empty table come out as they went in.  Other columns stay, but for
    columns of the three names, which are replaced.  A long text is held by one
    task, with some 100 bytes a word.
    """
    added = ("n_words", "runs", "collapsed")
    kept = docs.drop(*[c for c in docs.columns if c.lower() in added]) if text.lower() not in added else docs
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text], RESULT])
    others = [name for name in kept.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in slices(batches, text):
            words = [(t or b"").split() for t in raw_texts(batch.column(text))]
            runs = _batch_runs(words, exponent, shortest)
            n = np.array([len(r) for r in runs])
            flat = np.concatenate([np.empty((0, 3), np.int64), *runs])
            parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), parts).cast(kind)
            left = pa.array([_collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())
            sizes = pa.array([len(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], sizes, lists, left], names=[*others, *added])

    return kept.mapInArrow(run, schema)


def planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a tail that repeats, where crc32 of the key says so.

    With h = crc32(key as text), g = floor(h / 10) and n words: if h % 10 is 0, word
    i from a = g % n on is what stood at a + (i - a) % p, where p is
    1 + floor((n - a) / (3 + g % 8)).  Other texts stay as they are.
    """
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")

        def word(i):
            return F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p))

        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " "))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.withColumn(text, F.when(h % 10 == 0, F.coalesce(let(words, repeated), F.col(text))).otherwise(F.col(text)))
