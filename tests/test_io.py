"""Readers, sinks and the streaming monitor on files written by hand."""

from __future__ import annotations

import hashlib
import json

import pytest

from trajlake.sources import readers, sinks
from trajlake.streaming.trace_monitor import monitor


def test_records_of_lines_arrays_containers_and_objects(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n[2]\n{"x": 3}\n')
    (tmp_path / "b.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "c.json").write_text('{"note": 1, "instances": [{"x": 5}]}')
    (tmp_path / "d.json").write_text('{"x": 7}')
    rows = lambda f: [r["raw"] and json.loads(r["raw"]) for r in readers.json_records(spark, str(tmp_path / f)).orderBy("position").collect()]
    assert rows("a.jsonl") == [{"x": 1}, None, {"x": 3}]
    assert rows("b.json") == [{"x": 1}, {"x": 2}]
    assert rows("c.json") == [{"x": 5}] and rows("d.json") == [{"x": 7}]
    (tmp_path / "e.json").write_text('\n {"x": 1}\noops\n{"x": 3}')  # lines, whatever the name
    (tmp_path / "f.jsonl").write_text('{"records":\n [{"x": 8},\n 9]}')  # a document, whatever the name
    (tmp_path / "g h%20i.json").write_text("[]")
    assert rows("e.json") == [{"x": 1}, None, {"x": 3}] and rows("f.jsonl") == [{"x": 8}, None] and rows("g h%20i.json") == []
    lines = [(r["position"], r["raw"] is None) for r in readers.json_records(spark, str(tmp_path / "e.json")).orderBy("position").collect()]
    assert lines == [(2, False), (3, True), (4, False)]
    assert readers.json_records(spark, str(tmp_path)).count() == 3 + 2 + 1 + 1 + 3 + 2


def test_line_numbers_over_blocks_of_a_file(spark, tmp_path):
    text = [("x" * (k * 37 % 90) if k % 7 else "") + str(k) if k % 11 else "" for k in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(text) + "\n")
    (tmp_path / "b.txt").write_text("only")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["value"] for r in sorted((r for r in got if r["file"].endswith("a.txt")), key=lambda r: r["line"])] == text
    assert sorted(r["line"] for r in got if r["file"].endswith("a.txt")) == list(range(1, 3001)) and [(r["line"], r["value"]) for r in got if r["file"].endswith("b.txt")] == [(1, "only")]


def test_only_an_open_last_line_may_be_broken(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "cut.jsonl").write_text('{"a": 1}\n{"a": ')
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    got = {r["job_id"]: (r["status"], r["events"]) for r in readers.trace_status(readers.trace_lines(spark, str(tmp_path))).collect()}
    assert got == {"ok": ("valid", 2), "cut": ("truncated", 1), "bad": ("invalid", 2)}


def test_blobs_are_checked(spark, tmp_path):
    good, bad = hashlib.sha256(b"one").hexdigest(), hashlib.sha256(b"two").hexdigest()
    for digest, content in ((good, b"one"), (bad, b"changed")):
        folder = tmp_path / "sha256" / digest[:2]
        folder.mkdir(parents=True, exist_ok=True)
        (folder / digest).write_bytes(content)
    assert {r["digest"]: r["intact"] for r in readers.blobs(spark, str(tmp_path)).collect()} == {good: True, bad: False}


def test_export_manifest_has_the_files_digests(spark, tmp_path):
    path = str(tmp_path / "out")
    m = sinks.write_jsonl(spark.createDataFrame([("a", 1), ("b", None)], "k string, v int").coalesce(1), path).collect()
    assert len(m) == 1 and m[0]["sha256"] == hashlib.sha256((tmp_path / "out" / m[0]["file"]).read_bytes()).hexdigest()
    assert (tmp_path / "out" / m[0]["file"]).read_text() == '{"k":"a","v":1}\n{"k":"b"}\n'
    nested = spark.createDataFrame([(1, {"z": 1, "a": None}, [("y", 2)])], "b int, a map<string,int>, c array<struct<z string, y int>>")
    assert sinks.write_jsonl(nested, path).count() == 1 and [r["value"] for r in spark.read.text(path).collect()] == ['{"a":{"a":null,"z":1},"b":1,"c":[{"y":2,"z":"y"}]}']
    with pytest.raises(Exception, match="zero"):
        sinks.write_jsonl(spark.range(3).selectExpr("raise_error('zero') as x"), path)
    assert spark.read.text(path).count() == 1  # a failed write leaves what was there
    sinks.append_jsonl(nested, path)
    assert spark.read.text(path).count() == 2
    declared = spark.createDataFrame([("models", "1"), ("tools", " "), ("prompts", "2")], "version_group string, version string")
    assert [r[0] for r in sinks.undeclared_groups(declared).collect()] == ["scenarios", "tools", "images", "evaluators", "exporters"]


def test_allowlists_pages_and_registries(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"repositories": [{"repository": "a/b"}, 7]}')
    (tmp_path / "b.json").write_text('[{"repository": "c/d"}]')
    (tmp_path / "c.json").write_text('{"repository": "e/f"}')
    assert [json.loads(r["raw"] or "null") for r in readers.allowlist_records(spark, str(tmp_path / "a.json")).orderBy("position").collect()] == [{"repository": "a/b"}, None]
    assert [readers.allowlist_records(spark, str(tmp_path / f)).first()["raw"] for f in ("b.json", "c.json")] == ['{"repository":"c/d"}', '{"repository":"e/f"}']
    (tmp_path / "page.json").write_text('{"rows": [{"row_idx": 4, "row": {"x": 1}}, {"row_idx": 5, "row": {"x": 2}}, {"row_idx": 6, "row": 3}]}')
    assert [(r["row_idx"], r["raw"]) for r in readers.paged_rows(spark, str(tmp_path / "page.json"), 5, 2).collect()] == [(5, '{"x":2}')]
    with pytest.raises(ValueError):
        readers.paged_rows(spark, "x", -1, 2)
    (tmp_path / "scenarios").mkdir()
    for k in ("s2", "s1"):
        (tmp_path / "scenarios" / f"{k}.json").write_text(json.dumps({"scenario_id": k}))
    assert [r["scenario_id"] for r in readers.registry_scenarios(spark, str(tmp_path)).collect()] == ["s1", "s2"]
    (tmp_path / "old.jsonl").write_text('{"id": "a"}\n\n{"id": "a"}\nbroken\n{"id": "b"}\n')
    assert sorted(r["id"] for r in readers.resumed(spark, str(tmp_path / "old.jsonl"), "id").collect()) == ["a", "b"]


def test_monitor_follows_sessions_over_batches(spark, tmp_path):
    schema = "session_id string, sequence int, event_type string, call_id string"
    source, out = str(tmp_path / "in"), "monitor_out"
    first = [("s", 0, "model_response", ""), ("s", 1, "tool_requested", "a"), ("t", 0, "tool_finished", "x")]
    second = [("s", 2, "tool_finished", "a"), ("s", 4, "tool_requested", "b")]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(source)
    query = monitor(spark.readStream.schema(schema).parquet(source)).writeStream.outputMode("update").format("memory").queryName(out).option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        query.processAllAvailable()
        spark.createDataFrame(second, schema).coalesce(1).write.mode("append").parquet(source)
        query.processAllAvailable()
        last = {}
        for r in spark.table(out).collect():
            if r["events"] >= last.get(r["session_id"], (0,))[0]:
                last[r["session_id"]] = (r["events"], r["open_calls"], r["violations"])
        assert last == {"s": (4, 1, 1), "t": (1, 0, 1)}
    finally:
        query.stop()
