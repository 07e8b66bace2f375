"""Readers, writers and incremental jobs."""

from __future__ import annotations

import collections
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from pairforge import schemas
from pairforge.operators import batches, lengths
from pairforge.plans import jobs
from pairforge.sources import ledger, readers, writers
from pairforge.streaming import streams

META = {"recipe_id": 1, "recipe_name": "Ñ", "category": "basic_recipe", "context": "c"}


def record(n, chosen=None):
    return {
        "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": f"q{n}"}],
        "chosen": chosen or f"{n} " + "á" * 60,
        "rejected": f"{n} " + "b" * 30,
        "metadata": META,
    }


def write_lines(path, records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records))


def test_array_file_and_missing_file(spark, tmp_path):
    (tmp_path / "bank.json").write_text(json.dumps([{"recipe_id": 1, "questions": "¿a?"}, {"recipe_id": None}], indent=2))
    rows = readers.read_records(spark, str(tmp_path / "bank.json"), schemas.QUESTION).collect()
    assert [(r["recipe_id"], r["questions"]) for r in rows] == [(1, "¿a?"), (None, None)]
    assert readers.read_or_empty(spark, str(tmp_path / "none.json"), schemas.QUESTION).count() == 0


def test_bad_lines_are_exposed_or_fatal(spark, tmp_path):
    write_lines(tmp_path / "a.json", [record(1), "", "{broken", record(2)])
    kept = readers.read_pairs(spark, str(tmp_path)).cache()
    assert kept.filter(F.col(readers.CORRUPT).isNotNull()).count() == 1
    assert kept.filter(F.col(readers.CORRUPT).isNull()).count() == 2
    with pytest.raises(Exception):
        readers.read_pairs(spark, str(tmp_path), mode="FAILFAST").collect()


def test_salvage_closes_a_cut_array(spark):
    rows = [
        (1, '[{"question":"a"},{"question":"b"}]'),
        (2, ' [{"question":"a"},{"question":"b"}\n'),
        (3, '[{"question":"a"},{"question":"b'),
        (4, '{"question":"a"}'),
        (5, '[{"question":"a"},'),
        (6, '[{"question":"a, } ] \\" {"},{"question":"b","x":[{"y":"}"'),
        (7, '[{"question":"a","x":[1,{"y":"]"}]} , {'),
        (8, "["),
        (9, '[{"question":'),
    ]
    frame = spark.createDataFrame(rows, "id int, body string")
    got = readers.salvage_arrays(frame, "body", schemas.RAW_QUESTION).collect()
    assert sorted((r["id"], r["position"], r["question"], r["salvaged"]) for r in got) == [
        (1, 0, "a", False), (1, 1, "b", False), (2, 0, "a", True), (2, 1, "b", True),
        (3, 0, "a", True), (5, 0, "a", True), (6, 0, 'a, } ] " {', True), (7, 0, "a", True),
    ]


ARRAY = [
    {"question": "plain", "category": "c"},
    {"question": "brackets ]}{[ and , \" \\\\", "category": None},
    {"question": 'a "quoted" }, {"x":1}', "category": "é}ñ"},
    {"question": "ends in a backslash \\\\"},
    {"question": "", "category": "{" * 40, "nested": {"a": [{"b": "}"}, {}]}},
    {},
]


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    """Cuts fall into strings, between brackets and inside nested objects."""
    rng = random.Random(2)
    records = [dict(rng.choice(ARRAY), question_type=str(i)) for i in range(3000)]
    text = json.dumps(records, ensure_ascii=False, indent=1)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(text)
    (tmp_path / "in" / "b.json").write_text(json.dumps(records[:5], separators=(",", ":")))
    (tmp_path / "in" / "c.json").write_text(" [ ] \n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        got = readers.read_large_arrays(spark, str(tmp_path / "in"), schemas.RAW_QUESTION, str(tmp_path / "work"))
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "in")).rdd.getNumPartitions() > 20
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda r: (r.get("question"), r.get("category"), r.get("question_type"))
    assert collections.Counter(key(r.asDict()) for r in rows) == collections.Counter(map(key, records + records[:5]))
    whole = readers.read_records(spark, str(tmp_path / "in"), schemas.RAW_QUESTION)
    assert collections.Counter(map(tuple, whole.collect())) == collections.Counter(map(tuple, rows))


def test_split_choice(spark):
    frame = spark.createDataFrame([("test", 1), ("train", 2), ("dev", 3)], "split string, id int")
    assert [r["id"] for r in readers.pick_split(frame).collect()] == [2]
    assert [r["id"] for r in readers.pick_split(frame, prefer="none").collect()] == [3]


def test_sessions_append_list_and_publish(spark, tmp_path):
    incoming, saved, final = (str(tmp_path / name) for name in ("in", "saved", "final"))
    (tmp_path / "in").mkdir()
    write_lines(tmp_path / "in" / "a.json", [record(1), record(2), record(3, chosen="short")])
    pairs = spark.read.schema(schemas.DPO_PAIR).json(incoming)
    for session in ("20250101_000000", "20250102_000000"):
        writers.append_pairs(pairs, saved, session, "2025-01-01 00:00:00")
    back = readers.read_pairs(spark, saved)
    assert [r[0] for r in readers.list_sessions(spark, saved).collect()] == ["20250102_000000", "20250101_000000"]
    assert readers.read_pairs(spark, saved, "20250101_000000").count() == 2
    assert writers.publish_pairs(back, final) == 4
    lines = [line for part in (tmp_path / "final").glob("part-*") for line in part.read_text().splitlines()]
    assert {tuple(json.loads(line)) for line in lines} == {tuple(schemas.PAIR_COLUMNS)}
    assert all("á" in line for line in lines)


def test_a_repeated_run_leaves_each_row_once(spark, tmp_path):
    saved = str(tmp_path / "saved")
    (tmp_path / "in").mkdir()
    write_lines(tmp_path / "in" / "a.json", [record(i) for i in range(1, 7)])
    pairs = spark.read.schema(schemas.DPO_PAIR).json(str(tmp_path / "in"))
    half = F.when(F.substring("chosen", 1, 1) <= "3", "s1").otherwise("s2")
    stamp = "2025-01-01 00:00:00"
    writers.save_sessions(pairs.withColumn("session_id", half), saved, stamp, "r1")
    writers.save_sessions(pairs.withColumn("session_id", half), saved, stamp, "r1")
    assert sorted(tuple(r) for r in readers.read_pairs(spark, saved).groupBy("session_id").count().collect()) == [("s1", 3), ("s2", 3)]
    writers.append_pairs(pairs, saved, "s2", stamp, "r2")
    assert readers.read_pairs(spark, saved, "s2").count() == 9
    # the repeated run no longer has session s1
    writers.save_sessions(pairs.withColumn("session_id", F.lit("s2")), saved, stamp, "r1")
    assert [r[0] for r in readers.list_sessions(spark, saved).collect()] == ["s2"]
    assert readers.read_pairs(spark, saved).count() == 12

    # a run that stops half way is not read, and leaves the others alone
    class Stop(Exception):
        pass

    def stop(*_):
        raise Stop

    put, writers.put_record = writers.put_record, stop
    try:
        with pytest.raises(Stop):
            writers.append_pairs(pairs, saved, "s3", stamp, "r3")
    finally:
        writers.put_record = put
    assert readers.read_pairs(spark, saved).count() == 12
    writers.append_pairs(pairs, saved, "s3", stamp, "r3")
    assert readers.read_pairs(spark, saved, "s3").count() == 6


def test_raw_session_files(spark, tmp_path):
    write_lines(tmp_path / "session_20250103_070000.jsonl", [record(1), record(2)])
    write_lines(tmp_path / "session_20250104_070000.jsonl", [record(3)])
    write_lines(tmp_path / "other.jsonl", [record(4)])
    names = [r[0] for r in readers.list_sessions(spark, str(tmp_path)).collect()]
    assert names == ["20250104_070000", "20250103_070000"]
    rows = readers.read_session_files(spark, str(tmp_path)).collect()
    assert sorted((r["session_id"], int(r["chosen"][0])) for r in rows) == [
        ("20250103_070000", 1), ("20250103_070000", 2), ("20250104_070000", 3)
    ]


def test_curation_writes_splits_and_csv(spark, tmp_path):
    kind = "array<struct<role:string,content:string>>"
    rows = [(i, "train" if i < 8 else "test", [("user", "w " * i * 10)], [("user", 'say "hi",\nok')]) for i in range(10)]
    frame = spark.createDataFrame(rows, f"id int, split string, chosen {kind}, rejected {kind}")
    measured = lengths.with_lengths(frame)
    numbers = measured.drop("chosen", "rejected", "chosen_text", "rejected_text")
    texts = measured.select("id", "chosen_text", "rejected_text")
    report = jobs.length_curation(frame, numbers, "id", str(tmp_path), lambda some: some.join(texts, "id"), 42)
    metrics = {r["metric"]: r["value"] for r in report.collect()}
    assert (metrics["exceeding"], metrics["split_train"], metrics["split_test"]) == (3.0, 5.0, 2.0)
    assert metrics["sample_5_chosen_length"] == 52.0
    shown = {r["index"]: r["chosen_preview"] for r in spark.read.json(str(tmp_path / "samples")).collect()}
    assert list(shown) == [5, 6, 7] and shown[5].startswith("User: w w")
    stored = spark.read.parquet(str(tmp_path / "splits"))
    assert {r["id"] for r in stored.collect()} == {0, 1, 2, 3, 4, 8, 9}
    flat = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert flat.count() == 5
    assert json.loads(flat.first()["rejected"])[0]["content"] == 'say "hi",\nok'


def test_pair_stream_restarts_without_repeating_rows(spark, tmp_path):
    incoming, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def run():
        stamp = F.to_timestamp(F.lit("2025-01-01 00:00:00"))
        return streams.stream_pairs(spark, incoming, out, state, "s1", stamp, max_files=1)

    write_lines(tmp_path / "in" / "a.json", [record(1), record(2, chosen="short")])
    write_lines(tmp_path / "in" / "b.json", [record(3)])
    def counts():
        rows = streams.stream_outcome(spark, out).collect()
        return sum(r["saved"] for r in rows), sum(r["failed"] for r in rows), len(rows)

    run()
    assert counts() == (2, 1, 2)
    assert readers.read_pairs(spark, out).count() == 2
    run()
    assert readers.read_pairs(spark, out).count() == 2
    write_lines(tmp_path / "in" / "c.json", [record(4)])
    run()
    assert readers.read_pairs(spark, out).count() == 3
    assert counts() == (3, 1, 3)
    # another checkpoint is another run, with batch numbers of its own
    stamp = F.to_timestamp(F.lit("2025-01-01 00:00:00"))
    streams.stream_pairs(spark, incoming, out, str(tmp_path / "other"), "s2", stamp, max_files=2)
    assert counts() == (6, 2, 5)
    assert readers.read_pairs(spark, out, "s2").count() == 3


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """A batch whose first attempt stopped before its end leaves one set of rows."""
    write_lines(tmp_path / "a.json", [record(1), record(2, chosen="short")])
    batch = spark.read.schema(schemas.DPO_PAIR).json(str(tmp_path / "a.json"))
    out, stamp = str(tmp_path / "out"), F.to_timestamp(F.lit("2025-01-01 00:00:00"))
    for _ in range(2):
        streams.save_batch(batch, 7, out, "r", "s", stamp)
    assert readers.read_pairs(spark, out).count() == 1
    assert [tuple(r) for r in streams.stream_outcome(spark, out).collect()] == [("s", "r-000000007", 7, 1, 1)]


def test_ledger_of_many_batches(spark, tmp_path):
    """More batches than Spark remembers for a query, over several runs."""
    folder = ledger.ledger_of(str(tmp_path / "out"))
    for run in ("r1", "r2"):
        for batch in range(5_100):  # as put_record lays them out, without its calls
            row = {"session_id": "s", "run": run, "batch_id": batch, "saved": batch % 7, "failed": 1}
            place = pathlib.Path(ledger._place(folder, f"{run}-{batch:09d}"))
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_text(json.dumps(row) + "\n")
    for batch in range(3):  # again
        ledger.put_record(spark, folder, f"r1-{batch:09d}", [{"session_id": "s", "run": "r1", "batch_id": batch, "saved": batch, "failed": 1}])
    total = streams.stream_outcome(spark, str(tmp_path / "out")).agg(F.sum("saved"), F.sum("failed"), F.count("*")).first()
    assert tuple(total) == (2 * sum(b % 7 for b in range(5_100)), 10_200, 10_200)


def test_flatten_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        write_lines(tmp_path / "in" / f"{n}.json", [record(n)])
    streams.stream_flatten(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), max_files=1)
    rows = spark.read.schema(schemas.FLAT_PAIR).parquet(str(tmp_path / "out")).collect()
    assert [(r["recipe_id"], r["recipe_name"]) for r in rows] == [(1, "Ñ")] * 3


def test_page_stream_skips_known_addresses(spark, tmp_path):
    incoming, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def add(rows):
        spark.createDataFrame(rows, schemas.PAGE).coalesce(1).write.mode("append").parquet(incoming)

    add([(1, "u1", "<h1 class='entry-title'>one</h1>"), (2, "u1", "<h1 class='entry-title'>again</h1>"), (3, "u2", None)])
    streams.stream_pages(spark, incoming, out, state)
    add([(4, "u1", "<h1 class='entry-title'>later</h1>"), (5, "u3", "")])
    streams.stream_pages(spark, incoming, out, state)
    rows = spark.read.parquet(f"{out}/records").collect()
    assert len(rows) == 2 and {r["url"] for r in rows} == {"u1", "u3"}
    assert {r["title"] for r in rows if r["url"] == "u1"} <= {"one", "again"}
    # pages without an address all stay, and an unreadable page does not hide a later one
    add([(6, None, "<p>x</p>"), (7, None, "<p>x</p>"), (8, "u2", "<h1 class='entry-title'>two</h1>"), (9, "u3", "")])
    streams.stream_pages(spark, incoming, out, state)
    rows = spark.read.parquet(f"{out}/records").collect()
    assert sorted(r["url"] or "" for r in rows) == ["", "", "u1", "u2", "u3"]


def test_page_stream_goes_on_after_a_failed_batch(spark, tmp_path, monkeypatch):
    """A batch that fails after its write is run again; known addresses stay known."""
    incoming, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def add(rows):
        spark.createDataFrame(rows, schemas.PAGE).coalesce(1).write.mode("append").parquet(incoming)

    add([(1, "u1", "<p>a</p>"), (2, "u2", "<p>b</p>")])
    streams.stream_pages(spark, incoming, out, state)
    add([(3, "u2", "<p>b</p>"), (4, "u3", "<p>c</p>")])
    real = streams.recipe_records

    def fails(pages, rules):
        real(pages, rules).write.mode("overwrite").parquet(f"{out}/records/batch=half")
        raise RuntimeError("stopped")

    monkeypatch.setattr(streams, "recipe_records", fails)
    with pytest.raises(Exception, match="stopped"):
        streams.stream_pages(spark, incoming, out, state)
    monkeypatch.setattr(streams, "recipe_records", real)
    streams.stream_pages(spark, incoming, out, state)
    rows = spark.read.parquet(f"{out}/records").filter("batch <> 'half'").collect()
    assert sorted(r["url"] for r in rows) == ["u1", "u2", "u3"]


def test_caller_code_may_drop_rows(spark):
    frame = spark.range(10)
    got = batches.map_batches(frame, lambda b: b[b["id"] % 2 == 0], "id long")
    assert {r["id"] for r in got.collect()} == {0, 2, 4, 6, 8}


def test_first_rows_check(spark):
    kind = "array<struct<role:string,content:string>>"
    rows = [(1, None, [("user", " ")]), (2, [("user", "x")], []), (3, None, None)]
    frame = spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}")
    got = lengths.pair_completeness(frame, "id", 2).first().asDict()
    assert got == {"null_chosen": 1, "null_rejected": 0, "blank_chosen": 1, "blank_rejected": 1}
