"""Quality by co-training on two views of a document.

One classifier sees the text alone, the other the page's metadata alone
(language, source, length).  In each round, each of them labels the unlabelled
documents it is surest about for the other.  Both are calibrated on labelled rows
kept back from the fit, and their log-odds, weighted by how well each does there,
give the score of every document.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import raw_texts, slices
from pairforge.llm.factorization import FactorizationMachine, _sigmoid
from pairforge.llm.toxicity import held_out

TEXT_BUCKETS, PAGE_BUCKETS = 1 << 16, 1 << 12
#: Bounds of the samples that the classifiers are fitted on.
LABELLED_ROWS, UNLABELLED_ROWS, SAMPLE_TERMS = 20_000, 10_000, 8_000_000
ROUNDS, CONFIDENT, SHARE = 3, 0.95, 0.1

_SHAPE = bytes(0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def _bin(name: bytes, value: float, steps: float) -> bytes:
    return name + str(int(value * steps)).encode()


def text_terms(text: bytes | None) -> np.ndarray:
    """Shapes of words (letters, capitals, digits, symbols as they are; runs
    shortened) and binned figures of the whole text."""
    text = text or b""
    words, lines = text.split(), text.split(b"\n")
    n, size = max(1, len(words)), max(1, len(text))
    shape = text.translate(_SHAPE)
    letters, capitals, digits = (shape.count(c) for c in (b"a", b"A", b"0"))
    symbols = size - letters - capitals - digits - shape.count(b" ") - shape.count(b"\n")
    terms = {_RUNS.sub(rb"\1+", w) for w in set(shape.split())}
    terms |= {
        _bin(b"=distinct", len(set(words)) / n, 20),
        _bin(b"=capitals", capitals / size, 40),
        _bin(b"=digits", digits / size, 40),
        _bin(b"=symbols", symbols / size, 60),
        _bin(b"=word", len(text) / n, 1.5),
        _bin(b"=lines", len(set(lines)) / len(lines), 10),
        _bin(b"=line", np.log1p(size / len(lines)), 1.5),
        _bin(b"=stops", (text.count(b". ") + text.count(b".\n")) / n, 40),
        _bin(b"=words", np.log1p(len(words)), 1.5),
    }
    return np.unique(np.array([zlib.crc32(t) % TEXT_BUCKETS for t in terms], np.int32))


def page_terms(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    length = "none" if n_chars is None else str(int(2 * np.log1p(max(0, n_chars))))
    terms = (f"lang {lang}", f"source {source}", f"length {length}", f"both {lang} {length}")
    return np.unique(np.array([zlib.crc32(t.encode()) % PAGE_BUCKETS for t in terms], np.int32))


class CoTraining:
    """Two calibrated classifiers and the weights of their views."""

    def fit(self, views: tuple[list, list], y: np.ndarray, pool: tuple[list, list]) -> CoTraining:
        """``views`` are the labelled rows by text and by page, ``pool`` the
        unlabelled ones.  A fifth of the labelled rows decides the weights."""
        make = (lambda: FactorizationMachine(TEXT_BUCKETS, factors=0), lambda: FactorizationMachine(PAGE_BUCKETS, factors=0))
        keep = np.arange(len(y)) % 5 != 0
        train = [[r for r, k in zip(v, keep, strict=True) if k] for v in views]
        labels, free = [y[keep], y[keep]], np.ones(len(pool[0]), bool)
        for turn in range(ROUNDS + 1):
            self.models = [make[i]().fit(train[i], labels[i]) for i in range(2)]
            if turn == ROUNDS or not free.any() or len(set(y[keep])) < 2:
                break
            for i in range(2):  # what view i is sure of becomes a label of the other view
                score = self.models[i].scores(pool[i])
                sure = np.maximum(score, 1 - score)
                some = np.flatnonzero(free & (sure >= CONFIDENT))
                some = some[np.argsort(-sure[some], kind="stable")][: max(1, int(SHARE * len(y)))]
                free[some] = False
                train[1 - i] = train[1 - i] + [pool[1 - i][j] for j in some]
                labels[1 - i] = np.concatenate([labels[1 - i], (score[some] >= 0.5).astype(float)])
        # calibrate again on true labels only, and weigh the views together
        rest = [[r for r, k in zip(v, keep, strict=True) if not k] for v in views]
        target = y[~keep]
        self.weights = np.array([0.0, 1.0, 1.0])
        if len(set(target)) == 2:
            x = np.stack([np.ones(len(target)), *(m.log_odds(r) for m, r in zip(self.models, rest, strict=True))], axis=1)
            w = np.array([0.0, 0.5, 0.5])
            for _ in range(50):
                p = _sigmoid(x @ w)
                ridge = np.diag([1e-6, 1.0, 1.0])
                step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - target) + ridge @ (w - [0, 0.5, 0.5]))
                w = w - step
                if np.abs(step).max() < 1e-6:
                    break
            self.weights = w
        return self

    def scores(self, text: list[np.ndarray], page: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(both, text view, page view), each from 0 to 1."""
        a, b = self.models[0].log_odds(text), self.models[1].log_odds(page)
        w0, wa, wb = self.weights
        return _sigmoid(w0 + wa * a + wb * b), _sigmoid(a), _sigmoid(b)


def _views(documents: DataFrame, key: str, text: str, metadata: tuple[str, str, str]) -> DataFrame:
    lang, source, size = metadata
    return documents.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(size).cast("long").alias("size"))


def _both_terms(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    page = zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "size")), strict=True)
    return [text_terms(t) for t in raw_texts(batch.column("t"))], [page_terms(*p) for p in page]


def fit_quality(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", metadata: tuple[str, str, str] = ("lang", "source", "n_chars"), label: str = "quality", labelled_rows: int = LABELLED_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> CoTraining:
    """Fit on at most ``labelled_rows`` labelled and ``unlabelled_rows`` other
    documents, chosen by a hash of the key; the held-out part is in neither."""
    views = _views(documents, key, text, metadata)
    order = (F.xxhash64("k"), "k")
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    some = known.orderBy(*order).limit(labelled_rows)
    others = views.where(F.col("k").isNotNull() & ~held_out("k")).select("k").join(known, "k", "left_anti").orderBy(*order).limit(unlabelled_rows)
    chosen = some.unionByName(others.withColumn("y", F.lit(None).cast("int")))
    rows = views.join(F.broadcast(chosen), "k")  # both parts are bounded

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            parts = _both_terms(batch)
            yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array([r.tobytes() for r in p], pa.binary()) for p in parts)], names=["y", "text", "page"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y: list[int] = []
        labelled: tuple[list, list] = ([], [])
        pool: tuple[list, list] = ([], [])
        total = 0
        for batch in batches:
            for label_, *parts in zip(*(batch.column(c).to_pylist() for c in ("y", "text", "page")), strict=True):
                total += len(parts[0]) // 4
                if total <= SAMPLE_TERMS:
                    for view, part in zip(pool if label_ is None else labelled, parts, strict=True):
                        view.append(np.frombuffer(part, np.int32))
                    if label_ is not None:
                        y.append(label_)
        model = CoTraining().fit(labelled, np.array(y, float), pool)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    ordered = rows.mapInArrow(featurize, "y int, text binary, page binary").repartition(1).sortWithinPartitions(F.xxhash64("text", "page"), "y")
    found = ordered.mapInArrow(fit, "model binary").first()
    return pickle.loads(found["model"]) if found else CoTraining().fit(([], []), np.zeros(0), ([], []))


def quality_scores(documents: DataFrame, model: CoTraining, threshold: float = 0.5, key: str = "doc_id", text: str = "text", metadata: tuple[str, str, str] = ("lang", "source", "n_chars")) -> DataFrame:
    """One row per document: key, held_out, score (1: good), text_score,
    page_score, keep.

    Null texts and null metadata are values of their own; every row is scored by
    itself, repeated rows and null keys included.
    """
    views = _views(documents, key, text, metadata)
    kind = views.schema["k"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            scores = shared.value.scores(*_both_terms(batch))
            yield pa.RecordBatch.from_arrays([batch.column("k"), *map(pa.array, scores)], names=["k", "score", "text_score", "page_score"])

    scored = views.mapInArrow(run, f"k {kind}, score double, text_score double, page_score double").withColumnRenamed("k", key)
    return scored.select(key, held_out(key).alias("held_out"), "score", "text_score", "page_score", (F.col("score") >= threshold).alias("keep"))
