import random

from leafquarry.operators.intervals import coalesce_intervals, points_in_intervals
from leafquarry.operators.lines import longest_cover, merge_chains, overlapping_pairs, page_runs


def test_points_in_intervals(spark, rows):
    rng = random.Random(1)
    spans = [(i, d, a, a + rng.choice([0, 1, 5, 63, 64, 65, 400])) for i in range(80) for d in [rng.choice("ab")] for a in [rng.randint(-70, 300)]]
    points = [(d, p) for d in "ab" for p in range(-80, 500, 7)]
    made = points_in_intervals(spark.createDataFrame(points, "d string, p int"), spark.createDataFrame(spans, "i int, d string, lo int, hi int"), ["d"], "p", "lo", "hi")
    want = sorted((d, p, i) for d, p in points for i, e, a, b in spans if d == e and a <= p <= b)
    assert sorted((r.d, r.p, r.i) for r in made.collect()) == want


def test_swapped_and_null_bounds_cover_nothing(spark):
    spans = spark.createDataFrame([("a", 5, 3), ("a", None, 3), ("a", 3, None)], "d string, lo int, hi int")
    assert points_in_intervals(spark.createDataFrame([("a", 4)], "d string, p int"), spans, ["d"], "p", "lo", "hi").count() == 0


def test_chains_of_the_fixture(spark, rows):
    data = [("t2", 24, 25, "Table 2"), ("x", 146, 147, "X"), ("x", 148, 148, "X (cont.)"), ("x", 160, 161, "X"), ("x", None, 4, "n")]
    df = spark.createDataFrame(data, "g string, lo int, hi int, title string")
    assert rows(merge_chains(df, ["g"])) == [("t2", 24, 25, "Table 2", 1), ("x", 146, 148, "X", 2), ("x", 160, 161, "X", 1)]
    assert rows(coalesce_intervals(df, ["g"], "lo", "hi")) == [("t2", 24, 25, 1), ("x", 146, 148, 2), ("x", 160, 161, 1)]


def test_runs_overlaps_cover(spark, rows):
    pages = spark.createDataFrame([("d", p) for p in (1, 2, 2, 3, 7, None)], "doc string, page int")
    assert rows(page_runs(pages, ["doc"])) == [("d", 1, 3, 3), ("d", 7, 7, 1)]
    spans = spark.createDataFrame([("d", "a", 1, 3), ("d", "b", 3, 4), ("d", "c", 6, 9)], "doc string, i string, lo int, hi int")
    assert rows(overlapping_pairs(spans, ["doc"], "i")) == [("d", "a", 1, 3, True), ("d", "b", 3, 4, True), ("d", "c", 6, 9, False)]
    best = longest_cover(pages.where("page is not null").distinct(), spans, ["doc"], "page", "lo", "hi", ["i"])
    assert sorted((r.page, r.i) for r in best.collect()) == [(1, "a"), (2, "a"), (3, "a"), (7, "c")]
