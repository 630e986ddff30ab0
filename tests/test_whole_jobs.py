"""Queries that once left part of their rows out, on small tables of their own."""

import __spark_entry__ as entry


def tables(spark, path, **made):
    for name, (data, kind) in made.items():
        spark.createDataFrame(data, kind).write.parquet(f"{path}/{name}.parquet")
    return str(path)


ENTRIES = "job_id string, snapshot_no int, id string, title string, page int"


def test_every_pair_of_snapshots(spark, rows, tmp_path):
    data = [
        ("j", 2, "a", "A", 1), ("j", 2, "b", "B", 2), ("j", 4, "a", "A", 3), ("j", 5, "a", "A", 3), ("j", 5, "c", "C", 4),
        ("j", 6, "n", None, 1), ("k", 1, "a", "A", 1), ("k", 2, "a", "A", 1), ("l", 1, "a", "A", 1),
    ]
    at = tables(spark, tmp_path, manifest_entries=(data, ENTRIES))
    diff = entry.queries()["j13_build_diff"](spark, at).select("job_id", "snapshot_no", "id", "state")
    assert rows(diff) == sorted([
        ("j", 4, "a", "changed"), ("j", 4, "b", "only_old"), ("j", 5, "a", "same"), ("j", 5, "c", "only_new"),
        ("j", 6, "a", "only_old"), ("j", 6, "c", "only_old"), ("j", 6, "n", "only_new"), ("k", 2, "a", "same"),
    ])
    ops = entry.queries()["v17_aligned_diff"](spark, at).select("job_id", "snapshot_no", "tag", "old_from", "old_to", "new_from", "new_to")
    assert rows(ops) == sorted([
        ("j", 4, "equal", 0, 1, 0, 1), ("j", 4, "delete", 1, 2, 1, 1), ("j", 5, "equal", 0, 1, 0, 1), ("j", 5, "insert", 1, 1, 1, 2),
        ("j", 6, "delete", 0, 2, 0, 0), ("k", 2, "equal", 0, 1, 0, 1),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_contents_entries_keep_their_titles(spark, tmp_path):
    said = {
        "a": ("Résumé of Tasks", 3, "Résumé of Tasks — 3"), "b": ("Ｆｕｌｌ width", None, "Ｆｕｌｌ width"), "c": ("Глоссарий", 5, "Глоссарий — 5"),
        "d": ("Levels A1–B2", 7, "Levels A1–B2 — 7"), "e": (" Chapter 2: Évaluation ", 9, "## Chapter 2: Évaluation — 9"), "f": ("3.1. Übersicht", 4, "### 3.1. Übersicht — 4"),
    }
    at = tables(spark, tmp_path, manifest_entries=([("j", 1, i, t, p) for i, (t, p, _) in said.items()], ENTRIES))
    assert {r.id: r.result for r in entry.queries()["c19_toc_entry"](spark, at).collect()} == {i: r for i, (_, _, r) in said.items()}


GROUPS = "doc_id string, group_id string, span_type string, start_page int, end_page int, title string, rotated boolean"


def test_groups_of_one_page(spark, rows, tmp_path):
    data = [("d", "g", "table", 7, None, "T", False), ("d", "h", "table", None, 9, "T", True), ("d", "s", "table", 5, 3, "T", False), ("d", "n", "table", None, None, "T", False)]
    at = tables(spark, tmp_path, span_groups=(data, GROUPS))
    query = lambda name: entry.queries()[name](spark, at)
    assert rows(query("k04_registry").select("id", "page_start", "page_end")) == [("g", 7, 7), ("h", 9, 9), ("s", 3, 5)]
    assert rows(query("w13_gaps").select("gap_lo", "gap_hi")) == [(6, 6), (8, 8)]
    assert rows(query("c33_page_list")) == [("g", "7,1"), ("h", "9,1"), ("s", "3,4,5,1")]
    assert rows(query("k09_handoff").select("slug", "page", "rotation")) == [("g", 7, 0), ("h", 9, 270), ("s", 3, 0)]


def test_paths_of_long_documents(spark, rows, tmp_path):
    chunks = [("d", "a", 1, 25), ("d", "b", 990, 1010), ("d", "c", 1011, None), ("e", "x", 12345, None)]
    at = tables(
        spark, tmp_path, chunks=(chunks, "doc_id string, chunk_id string, start_page int, end_page int"),
        jobs=([("d", "P", "T", "p", (1200,)), ("d", "P", "T", "p", (1200,)), ("e", "P", "T", "p", (None,))], "id string, publisher string, title string, profile string, source struct<expected_page_count: int>"),
        manifest_entries=([("j", n, "a", "A", 1) for n in (7, 999, 1000, 12345)], ENTRIES),
    )
    paths = entry.queries()["k01_chunk_paths"](spark, at).select("chunk_id", "end_page", "out_path")
    assert rows(paths) == [
        ("a", 25, "chunks/a_pages_001-025.pdf"), ("b", 1010, "chunks/b_pages_990-1010.pdf"), ("c", 1200, "chunks/c_pages_1011-1200.pdf"), ("x", None, None),
    ]
    versions = entry.queries()["k06_versions"](spark, at).select("path", "next_version")
    assert rows(versions) == [("versions/007", 12346), ("versions/1000", 12346), ("versions/12345", 12346), ("versions/999", 12346)]


def test_span_text_of_the_fonts_given(spark, rows, tmp_path):
    spans = [
        (1, [("Bold ", "Serifa-Bold", 0), ("more", "Serifa", 16), (" plain", "Serifa", 0)]), (2, [("3", "Wingdings", 0), (" next\u00ad", None, None)]),
        (3, [("3", "Serifa", 0), (None, "Serifa-Bold", 0)]), (4, None),
    ]
    at = tables(spark, tmp_path, pdf_lines=(spans, "line_id long, spans array<struct<text: string, font: string, flags: int>>"))
    assert rows(entry.queries()["c30_span_text"](spark, at)) == [(1, "**Bold more** plain"), (2, "▶ next"), (3, "3")]
