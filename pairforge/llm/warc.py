"""WARC archives and their capture index.

Archives are written by Spark's text sink, whose line separator is the end of a
WARC record, so any file system that Spark reaches will do.  They are read by
Spark's text source in splits, cut where a record ends and the next one begins.
A payload that holds that very cut goes to an archive of its own, which is read
as a whole file.

The index of captures is an external merge: tasks write runs sorted by URL key
and timestamp; the runs are dealt into ranges of the key, and in each range a
loser tree merges the sorted slices of all runs into one capture history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import shared_folder, stored

END = "\r\n\r\n"
BEGIN = "WARC/1.1\r\nWARC-Type: "
#: Payloads shorter than this are never revisits.
LEAST_REVISIT = 100
#: Records per archive file.
RECORDS_PER_FILE = 50_000


class LoserTree:
    """k-way merge of sorted iterators.

    Inner nodes hold the loser of the match below them; the winner goes up, so
    the next item costs one match on each level.  Equal items leave in the order
    of their runs.
    """

    def __init__(self, runs: list[Iterator[Any]], key: Callable[[Any], Any] = lambda x: x):
        self.runs, self.k, self.key = runs, len(runs), key
        self.heads: list[tuple] = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _next(self, i: int) -> tuple:
        for item in self.runs[i]:
            return (0, self.key(item), i, item)
        return (1, None, i, None)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return (x[0], x[2]) < (y[0], y[2]) if x[0] or y[0] else (x[1], x[2]) < (y[1], y[2])

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[Any]:
        while self.k and not self.heads[self.winner][0]:
            yield self.heads[self.winner][3]
            now = self.winner
            self.heads[now] = self._next(now)
            node = (now + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], now):
                    self.losers[node], now = now, self.losers[node]
                node //= 2
            self.winner = now


def url_key(url: Column) -> Column:
    """Host with its labels reversed, then path and query, in lower case; the
    scheme, a leading www, the port and the fragment don't count."""
    rest = F.lower(F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, "^([^/?]*)", 1), ":[0-9]*$", ""), "^www[0-9]*\\.", "")
    path = F.regexp_extract(rest, "^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))


def _header(name: str, value: Column) -> Column:
    """A header line; none for a null value.  Line ends inside are escaped."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", first_time: str = "2024-01-01 00:00:00") -> str:
    """Write one record per row below a fresh shared folder and return its path.

    The payload is the html in UTF-8 (null: empty).  Of the records with equal
    payloads of at least 100 bytes, the one with the smallest key is the
    response; the others are revisits, which refer to it and carry its digest and
    length but no payload.  A page is captured key seconds after ``first_time``
    (null keys: at it).  Rows that repeat a key within a group of equal payloads
    are revisits of the first; null keys are never referred to while another key
    has the payload.
    """
    page = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    page = page.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html").cast("long"))
    page = page.withColumn("row", F.monotonically_increasing_id())
    # the (key, row) that answers for a payload; ids of rows hold as the scan's files do
    groups = page.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    groups = stored(groups.where("n > 1").select("digest", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row")))
    page = page.join(groups, "digest", "left")
    revisit = F.col("first_row").isNotNull() & (F.col("row") != F.col("first_row"))
    payload = F.when(revisit, "").otherwise(F.col("html"))
    record = F.concat(
        F.lit(BEGIN),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\n"),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Date", F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(first_time)) + F.coalesce("id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.when(revisit, _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("first_id").cast("string"), F.lit("null")), F.lit(">")))).otherwise(""),
        F.when(revisit, _header("X-Payload-Length", F.col("bytes"))).otherwise(""),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(END),
        payload,
    )
    records = page.select(record.alias("value"), F.contains(F.concat(F.lit(END), payload), F.lit(END + BEGIN)).alias("odd"))
    folder = shared_folder(pages.sparkSession)
    written = records.where("not odd").select("value").write.option("lineSep", END)
    written.option("maxRecordsPerFile", RECORDS_PER_FILE).text(f"{folder}/plain")
    records.where("odd").select("value").write.option("lineSep", END).option("maxRecordsPerFile", 1).text(f"{folder}/odd")
    return folder


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id, url, url_key, captured_at, record_type,
    payload (null for revisits), payload_bytes, payload_digest, refers_to.

    Bytes and digest of a response are those of the payload read; a revisit has
    them from its headers.  A record whose payload isn't as long as its header
    says fails the read.
    """
    plain = spark.read.option("lineSep", END + BEGIN).text(f"{folder}/plain").where("value <> ''")
    plain = plain.select(F.when(F.startswith("value", F.lit(BEGIN)), F.expr(f"substring(value, {len(BEGIN) + 1})")).otherwise(F.col("value")).alias("value"))
    odd = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/odd").where("length > 0")
    odd = odd.select(F.expr(f"substring(cast(content as string), {len(BEGIN) + 1})").alias("value"))
    both = plain.unionByName(odd)
    head = F.substring_index("value", END, 1)
    both = both.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + {len(END) + 1})").alias("rest"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", f"(?:^|\\n){name}: ([^\\r\\n]*)", 1)
        return F.when(F.contains("head", F.lit(f"\n{name}: ")), found)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    length = field("Content-Length").cast("long")
    # the last record of a file still has the end that the cut took from the others
    extra = F.octet_length("rest") - length
    payload = F.when(extra == 0, F.col("rest")).when(extra == len(END), F.expr(f"substring(rest, 1, length(rest) - {len(END)})")).otherwise(F.raise_error(F.concat(F.lit("record with a wrong length: "), F.col("head"))))
    kind = F.regexp_extract("head", "^([a-z]+)", 1)
    return both.select(
        page("WARC-Record-ID").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        url_key(F.coalesce(field("WARC-Target-URI"), F.lit(""))).alias("url_key"),
        field("WARC-Date").alias("captured_at"),
        kind.alias("record_type"),
        F.when(kind == "response", payload).alias("payload"),
        F.when(kind == "response", F.octet_length(payload).cast("long")).otherwise(field("X-Payload-Length").cast("long")).alias("payload_bytes"),
        F.when(kind == "response", F.sha2(payload, 256)).otherwise(F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "")).alias("payload_digest"),
        F.when(kind == "revisit", page("WARC-Refers-To")).alias("refers_to"),
    )


_FIELDS = ("url_key", "captured_at", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to")
_KINDS = "url_key string, captured_at string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def capture_index(records: DataFrame) -> DataFrame:
    """The captures in the order of URL key, timestamp and page: the partitions of
    the result are ranges, each sorted.  ``capture`` numbers a URL's captures
    from 0 within its range.

    Runs are written sorted, one per task, and merged per range; a URL with very
    many captures is divided by time.  Only the small index rows are moved.
    """
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([run] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], names=[*_FIELDS, "run", "at"])
            at += n

    order = ["url_key", "captured_at", "page_id"]
    local = records.select(*_FIELDS).sortWithinPartitions(*order)
    runs = stored(local.mapInArrow(numbered, f"{_KINDS}, run int, at long"))
    slices_ = runs.repartitionByRange(*order).sortWithinPartitions("run", "at")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[int, list[tuple]] = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in _FIELDS]
            for run, *row in zip(batch.column("run").to_pylist(), *columns, strict=True):
                # nulls first, as in the sort of the runs
                by_run.setdefault(run, []).append((row[0], row[1], row[2] is not None, row[2] or 0, tuple(row)))
        merged = LoserTree([iter(rows) for _, rows in sorted(by_run.items())], key=lambda r: r[:4])
        out: list[tuple] = []
        last, n = None, 0
        for *_, row in merged:
            n = n + 1 if row[0] == last else 0
            last = row[0]
            out.append((*row, n))
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return slices_.mapInArrow(merge, f"{_KINDS}, capture long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*_FIELDS, "capture"])
