import random

from pyspark.sql import functions as F

from leafquarry.functions.look import fold_look, look, squeezed
from leafquarry.operators.snapshots import latest, snapshot_changes

SCHEMA = "job string, snap int, id string, title string, page int, at int, series string, salt int"


def changes(df):
    return snapshot_changes(df, "job", "snap", "id", {"title": squeezed(look(F.col("title"))), "page": F.col("page")}, "at")


def brute(data):
    held = {}
    for job, snap, key, title, page, at, *_ in data:
        if None in (job, snap, key):
            continue
        rank = (at is not None, at or 0, title is not None, title or "", page is not None, page or 0)
        if (job, snap, key) not in held or rank > held[(job, snap, key)][0]:
            held[(job, snap, key)] = (rank, None if title is None else " ".join(fold_look(title).split()), page)
    out = []
    for job in {k[0] for k in held}:
        snaps = sorted({k[1] for k in held if k[0] == job})
        for old, new in zip(snaps, snaps[1:]):
            a = {k[2]: v[1:] for k, v in held.items() if k[:2] == (job, old)}
            b = {k[2]: v[1:] for k, v in held.items() if k[:2] == (job, new)}
            for key in a.keys() | b.keys():
                if key not in a:
                    out.append((job, new, key, "added"))
                elif key not in b:
                    out.append((job, new, key, "removed"))
                elif a[key] != b[key]:
                    out.append((job, new, key, "changed"))
    return sorted(out)


def test_against_brute_force(spark, rows):
    rng = random.Random(4)
    titles = ["Intro", "lntro", "Ｉntro", "In tro", "Intro ", "intro", None, "", "Résumé", "Résumé"]
    data = [
        (rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([1, 2, 4, 5, None]), rng.choice(["x", "y", "z", "w", None]),
         rng.choice(titles), rng.choice([1, 2, None]), rng.choice([1, 2, 3, None]), "clash", 3)
        for _ in range(700)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(changes(df).select("job", "snap", "id", "change_type")) == brute(data)
    assert rows(changes(df.unionByName(df)).drop("changed_fields")) == brute(data)


def test_fields_and_spaces(spark, rows):
    df = spark.createDataFrame(
        [("j", 1, "a", "T  x", 1, 1, "", 0), ("j", 3, "a", " T x", 1, 1, "", 0), ("j", 4, "a", "t x", None, 1, "", 0)], SCHEMA
    )
    assert rows(changes(df)) == [("j", 4, "a", "changed", ["title", "page"])]


def test_empty(spark, rows):
    assert rows(changes(spark.createDataFrame([], SCHEMA))) == []


def test_latest_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (None, 9, "q")], "k int, at int, v string")
    assert rows(latest(df, ["k"], "at", ["v"])) == [(1, "b")]
