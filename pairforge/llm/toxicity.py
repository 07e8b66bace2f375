"""Toxicity by a factorization machine over hashed terms of the text.

Only the text is an input.  The machine learns pairs of terms, such as an insult
near a group, which additive weights miss.
"""

from __future__ import annotations

import pickle
import tempfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import hand_back, lean, raw_texts, slices
from pairforge.llm.decontam import words_of
from pairforge.llm.factorization import FactorizationMachine

BUCKETS = 1 << 18
#: Rows of the labelled sample that the model is fitted on.
SAMPLE_ROWS = 20_000
#: Words whose bucket a worker keeps.
_KEPT = 100_000


class Terms:
    """Distinct hashed terms of texts: each word, and how it begins.

    Languages that join words or inflect them hide a stem in many words; the
    first 4 to 7 bytes of a word are terms for that reason.
    """

    def __init__(self) -> None:
        self.memo: dict[bytes, bytes] = {}  # a word's terms as 32-bit numbers in a row

    def _terms(self, word: bytes) -> bytes:
        starts = [zlib.crc32(b"^" + word[:n]) % BUCKETS for n in range(4, 8) if len(word) >= n]
        return np.array([zlib.crc32(word) % BUCKETS, *starts], np.int32).tobytes()

    def of(self, text: bytes | None) -> np.ndarray:
        words, memo = set(words_of(text)), self.memo
        if len(memo) > _KEPT:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = self._terms(w)
        return np.unique(np.frombuffer(b"".join(map(memo.__getitem__, words)), np.int32))


def held_out(key: str):
    """Rows kept away from all fitting: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, key: str, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out part, chosen by a
    hash of the key: y and the given columns, whatever the documents' other columns
    are called.  The bound makes the broadcast safe."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    some = known.select(F.col(key).alias("label_key"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("label_key"), "label_key").limit(rows)
    texts = documents.select(F.col(key).alias("document_key"), F.struct(*columns).alias("row"))
    return texts.join(F.broadcast(some), F.col("document_key") == F.col("label_key")).select("y", "row.*")


@contextmanager
def sampled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """All rows of (y, terms), and y.  The terms lie in a temporary file, mapped
    into memory: long texts of many rows don't fit a worker."""
    y: list[int] = []
    ends = [0]
    with tempfile.TemporaryFile() as kept:
        for batch in batches:
            for label_, terms in zip(batch.column("y").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                y.append(label_)
                ends.append(ends[-1] + len(terms) // 4)
                kept.write(terms)
        kept.flush()
        flat = np.asarray(np.memmap(kept, np.int32, "r")) if ends[-1] else np.zeros(0, np.int32)
        yield [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], np.array(y, float)


def fit_toxicity(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Fit on a sample of at most ``sample_rows`` labelled rows.

    Terms are made where the rows are; the fit itself is one task, over all terms
    of those rows.  Without any
    labelled row the model scores 0.5 throughout.
    """
    sample = labelled_sample(documents, labels, label, key, [F.col(text).alias("t")], sample_rows)

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in slices(batches, "t"):
            rows = [terms.of(t) for t in raw_texts(batch.column("t"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["y", "terms"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with sampled_rows(batches) as (rows, y):
            model = FactorizationMachine(BUCKETS).fit(rows, y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    ordered = sample.mapInArrow(lean(featurize), "y int, terms binary").repartition(1).sortWithinPartitions(F.xxhash64("terms"), "y")
    found = ordered.mapInArrow(lean(fit), "model binary").first()
    return pickle.loads(found["model"]) if found else FactorizationMachine(BUCKETS).fit([], np.zeros(0))


def toxicity_scores(documents: DataFrame, model: FactorizationMachine, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, score (0 to 1) and predicted.

    Null and empty texts have no terms and get the score of that; repeated rows
    and null keys are scored row by row (a null key is not held out).
    """
    source = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = source.schema["k"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, machine = Terms(), shared.value
        for batch in slices(batches, "t", 1 << 22):
            scores = machine.scores([terms.of(t) for t in raw_texts(batch.column("t"))])
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(scores)], names=["k", "score"])

    scored = source.mapInArrow(lean(run), f"k {kind}, score double").withColumnRenamed("k", key)
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: FactorizationMachine, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows that score below the threshold, all columns as they are.

    Only the texts go to Python.  Null and empty texts get the score of no terms;
    repeated rows and null keys are judged row by row.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, machine = Terms(), shared.value
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], names=["t"])
            found = [machine.scores([terms.of(t) for t in raw_texts(some.column("t"))]) for some in slices([batch], "t", 1 << 22)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))
        del terms, machine
        hand_back()

    return documents.where(score(F.col(text)) < threshold)
