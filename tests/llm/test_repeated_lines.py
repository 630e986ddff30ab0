import random
import re

from leafquarry.functions.look import fold_look
from leafquarry.llm import repeated_lines as R

LINES = "line_id long, doc string, text string, source string, shard int, page int, line_no int"


def brute(lines, docs, least=5, share=(1, 5)):
    docs = {d: s or "" for d, s in docs if d is not None}
    size, held, keys = {}, {}, {}
    for s in docs.values():
        size[s] = size.get(s, 0) + 1
    for i, d, t, *_ in lines:
        if t and d in docs and i is not None and re.search(r"[^\W\d_]", t):
            key = (docs[d], re.sub(r"\d+", "0", " ".join(fold_look(fold_look(t).casefold()).split())))
            held.setdefault(key, set()).add(d)
            keys[i] = key
    return sorted(i for i, k in keys.items() if len(held[k]) >= least and len(held[k]) * share[1] >= size[k[0]] * share[0])


def frames(spark, lines, docs):
    return spark.createDataFrame(lines, LINES).drop("none"), spark.createDataFrame(docs, "doc string, source string")


def test_against_brute_force(spark):
    rng = random.Random(2)
    docs = [(f"d{i}", rng.choice(["hot"] * 3 + ["a", "b", None])) for i in range(90)] + [(None, "a")]
    forms = ["Share this", "SHARE  this", "Ｓhare this", "Sha​re this ", "Page 12", "Page 3", "12", "...", "", None, "rare one", "© 2024 all"]
    lines = [(i, rng.choice([d for d, _ in docs] + ["gone"]), rng.choice(forms + [f"body {rng.choice('abcdefgh')}{rng.choice('xyz')}"] * 2), "clash", 1, 1, 1) for i in range(1500)]
    lines += lines[:200]
    got = sorted(r.line_id for r in R.repeated_lines(*frames(spark, lines, docs)).collect())
    assert got == brute(lines, docs) and 0 < len(got) < 1500


def test_shards_and_words(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_DOCS", 50)
    docs = [(f"d{i}", "s") for i in range(700)]
    lines = [(i, f"d{i}", "Notice" if i % 4 == 0 else "Other" if i % 7 == 0 else f"text {chr(97 + i % 26)}{chr(97 + i // 26)}", "", 0, 1, 1) for i in range(700)]
    assert sorted(r.line_id for r in R.repeated_lines(*frames(spark, lines, docs)).collect()) == brute(lines, docs)


def test_share_at_the_border(spark):
    docs = [(f"d{i}", "s") for i in range(35)]
    lines = [(i, f"d{i}", "Same", "", 0, 1, 1) for i in range(7)]
    assert R.repeated_lines(*frames(spark, lines, docs)).count() == 7
    assert R.repeated_lines(*frames(spark, lines, [*docs, ("d99", "s")])).count() == 0


def test_empty_and_cleaned(spark, rows):
    lines, docs = frames(spark, [], [])
    assert R.repeated_lines(lines, docs).count() == 0
    some, _ = frames(spark, [(1, "d", "a", "", 0, 1, 1), (2, "d", "b", "", 0, 1, 2), (2, "d", "b", "", 0, 1, 2), (3, "d", None, "", 0, 1, 3)], [])
    found = spark.createDataFrame([(1,)], "line_id long")
    assert rows(R.cleaned_documents(some, found)) == [("d", 1, "b\n", 2, 1)]
