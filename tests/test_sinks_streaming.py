import json

import pytest
from pyspark.sql import functions as F

from leafquarry.operators import issues as I
from leafquarry.sources import documents, files, sinks
from leafquarry.streaming import incremental


def test_gate_versions_approval(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([(1, "fine")], "doc_id int, text string")
    bad = spark.createDataFrame([(1, "see https:// x")], "doc_id int, text string")
    assert sinks.gated_snapshot(bad, I.text_gates(bad), root) is None
    assert [sinks.gated_snapshot(good, I.text_gates(good), root) for _ in range(2)] == [1, 2]
    with pytest.raises(ValueError):
        sinks.approve(spark, root, 9)
    sinks.approve(spark, root, 1, "ok")
    assert sinks.versions(spark, root) == [1, 2] and sinks.approved(spark, root).count() == 1


def test_golden(spark, rows):
    bodies = spark.createDataFrame([(1, "alpha beta beta")], "page int, text string")
    specs = spark.createDataFrame([(1, ["alpha", "gamma"], ["beta"], {"beta": 1}), (2, ["x"], None, None)], "page int, must_have array<string>, must_not_have array<string>, max_count map<string,int>")
    assert rows(I.golden(bodies, specs, ["page"])) == [(1, "max_count", "beta"), (1, "must_have", "gamma"), (1, "must_not_have", "beta"), (2, "must_have", "x")]


def test_sources(spark, tmp_path):
    (tmp_path / "job" / "page_overrides").mkdir(parents=True)
    (tmp_path / "job" / "page_overrides" / "page_002.md").write_text("new")
    (tmp_path / "page_001.txt").write_text("a \r\n\nb")
    (tmp_path / "a.json").write_text('{"page": 3, "must_have": ["x"]}')
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "f.jsonl").write_text('{"page":1,"kind":"k"}\n{"page":2,"kind":"k"}\n')
    auto = spark.createDataFrame([("job", 1, "old"), ("job", 2, "old")], "job_id string, page int, text string")
    over = files.page_overrides(spark, f"{tmp_path}/*/page_overrides/*.md")
    assert {(r.page, r.text, r.origin) for r in files.with_overrides(auto, over, ["job_id", "page"]).collect()} == {(1, "old", "auto"), (2, "new", "override")}
    assert [(r.page, r.line_no, r.line) for r in files.recognised_text(spark, f"{tmp_path}/page_*.txt").orderBy("line_no").collect()] == [(1, 1, "a"), (1, 2, ""), (1, 3, "b")]
    side = files.sidecar(spark, f"{tmp_path}/*.json", files.GOLDEN).collect()
    assert sorted((r.page, r._corrupt is not None) for r in side if r.page) == [(3, False)] and sum(r._corrupt is not None for r in side) == 1
    assert files.findings(spark, f"{tmp_path}/f.jsonl").count() == 2


def test_layout_pages(spark, tmp_path):
    page = {"doc_id": "d", "page": 1, "width": 595.0, "height": 842.0, "lines": [{"y0": 1.0, "x0": 2.0, "y1": 3.0, "x1": 4.0, "dir_y": 0.9, "spans": [{"text": "a"}, {"text": "b"}]}],
            "tables": [{"bbox": [0.0, 50.0, 9.0, 60.0], "rows": [["x"]]}, {"bbox": [0.0, 5.0, 9.0, 9.0], "rows": [["y"]]}],
            "drawings": [{"x0": 0.0, "y0": 0.0, "x1": 100.0, "y1": 1.0}], "links": [{"uri": "https://a", "y0": 1.0, "x0": 1.0, "anchor": "z"}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    pages = files.layout_pages(spark, f"{tmp_path}/p.json")
    assert files.layout_lines(pages).first().text == "ab"
    assert files.drawing_rules(pages).first()[2:] == (1, 1, 0)
    assert [r.rows[0][0] for r in files.page_tables(pages).orderBy("table_index").collect()] == ["y", "x"]
    assert files.page_links(pages).first().anchor == "z" and files.page_rotation(pages).first().orientation == "rotated_270"
    reads = spark.createDataFrame([("d", 1, 0, "xx"), ("d", 1, 90, "the text and language"), ("d", 1, 270, "the text and language")], "doc_id string, page int, angle int, text string")
    assert files.best_rotation(reads).first().angle == 90
    assert documents.register(spark) == (documents.fitz is not None)


def test_incremental(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for n in (1, 2):
        (src / f"{n}.md").write_text(f"lang- uage {n}")
        query = incremental.ingest(incremental.cleaned(incremental.new_markdown(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.text for r in got.collect()) == ["language 1", "language 2"] and got.where(F.array_contains("fixes", "hyphenation")).count() == 2


def test_streamed_windows_equal_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch = incremental.windowed_counts(events).select("event_type", "n")
    stream = spark.readStream.schema(events.schema).parquet("/root/testdata/sf0.001/events.parq*")
    query = incremental.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert spark.table("w").select("event_type", "n").exceptAll(batch).isEmpty()


def test_registry_json(spark):
    df = spark.createDataFrame([("d", "b", 2), ("d", "a", 1)], "doc_id string, id string, page_start int")
    assert json.loads(sinks.registry_json(df).first().json) == [{"id": "a", "page_start": 1}, {"id": "b", "page_start": 2}]
