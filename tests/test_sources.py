from __future__ import annotations

import pytest

from lexigrove.sources import jsonl, manifest, sinks
from lexigrove.sources.tables import table
from lexigrove.streaming import maintain
from tests.util import rows


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "id int, t string")
    jsonl.write_jsonl(df, str(tmp_path / "x"), ["id"], {"generated": "today"})
    assert rows(jsonl.read_jsonl(spark, str(tmp_path / "x/*"), "generated string, id int, t string").drop("generated")) == rows(df)
    assert [r.generated for r in jsonl.read_header(spark, str(tmp_path / "x/*"), "generated string").collect()] == ["today"]


def test_manifest_finds_each_fault(spark, tmp_path):
    for name, text in (("a", "one"), ("b", "two"), ("c", "three")):
        (tmp_path / name).write_text(text)
    declared = spark.createDataFrame(manifest.manifest(spark, [str(tmp_path)]).collect())
    assert {r.status for r in manifest.verify(declared, manifest.manifest(spark, [str(tmp_path)])).collect()} == {"ok"}
    (tmp_path / "a").write_text("eno")
    (tmp_path / "b").write_text("twofold")
    (tmp_path / "c").unlink()
    (tmp_path / "d").write_text("new")
    assert rows(manifest.verify(declared, manifest.manifest(spark, [str(tmp_path)]))) == [("a", "digest"), ("b", "size"), ("c", "missing"), ("d", "undeclared")]


def test_pages(spark, tmp_path):
    df = spark.createDataFrame([("r", 2, "second"), ("r", 1, "first"), ("s", 1, "other")], "root string, rid int, line string")
    sinks.write_pages(df, str(tmp_path / "p"), "root", ["rid"], "line")
    assert [r.value for r in spark.read.text(str(tmp_path / "p/root=r")).collect()] == ["first", "second"]


def test_index_follows_new_files(spark, tmp_path):
    schema = "doc_id bigint, text string"
    write = lambda rows_, mode: spark.createDataFrame(rows_, schema).write.mode(mode).parquet(str(tmp_path / "in"))
    source = spark.createDataFrame([], schema).schema
    write([(1, "a b a"), (2, None)], "overwrite")
    maintain.maintain_index(spark, str(tmp_path / "in"), source, str(tmp_path / "ix"), "doc_id", "text")
    assert rows(maintain.current_index(spark, str(tmp_path / "ix"))) == [("a", 1), ("b", 1)]
    write([(3, "b c")], "append")
    maintain.maintain_index(spark, str(tmp_path / "in"), source, str(tmp_path / "ix"), "doc_id", "text")
    assert rows(maintain.current_index(spark, str(tmp_path / "ix"))) == [("a", 1), ("b", 2), ("c", 1)]


def test_stream_windows_equal_batch(spark, data, tmp_path):
    folder = tmp_path / "events"
    events = spark.read.parquet(f"{data}/events.parquet")
    events.write.parquet(str(folder))
    stream = spark.readStream.schema(events.schema).parquet(str(folder))
    got = maintain.run_to_table(spark, maintain.windowed_counts(stream, "ts", ["event_type"], "1 day", "1 hour"), str(tmp_path / "w"))
    whole = {tuple(r) for r in maintain.windowed_counts(events, "ts", ["event_type"], "1 day", "1 hour").collect()}
    streamed = {tuple(r) for r in got.collect()}
    # In append mode the windows that the watermark hasn't passed stay open.
    assert streamed <= whole and len(streamed) >= len(whole) - 10


def test_publish_replaces_a_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert sinks.publish(spark.range(5), path) == 5
    assert sinks.publish(spark.read.parquet(path).where("id < 3"), path) == 3
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["t.parquet"]


def test_missing_table_names_its_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing.parquet"):
        table(spark, str(tmp_path), "nothing")
