import random

import pytest

from leafquarry.llm import leakage as K

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru", "ta", "vo", "shi") for b in ("bel", "dor", "fin", "gat", "hul", "jim", "lat", "mor")]


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    i = spark.createDataFrame(items, "item_id long, text string, suite string")
    return {(r.doc_id, r.item_id): r for r in K.leaked(d, i).collect()}


def test_whole_part_altered(spark):
    rng = random.Random(1)
    item = passage(rng, 40)
    other = passage(rng, 30)
    filler = "plain words that no item holds at all"
    changed = list(item)
    for k in (4, 12, 20, 28, 36):
        changed[k] = "zzz"
    docs = [
        (1, f"{filler} {' '.join(item)}. {filler}"), (2, f"{filler} {' '.join(item[10:22])} {filler}"), (3, f"{filler} {' '.join(item[10:21])} {filler}"),
        (4, f"{filler}, {' '.join(changed)}"), (5, " ".join(w.upper() + "," for w in item[5:20])), (6, "\n".join(f"{w[:2]}-\n{w[2:]}" for w in item[5:20])),
        (7, " ".join(w.replace("a", "а") for w in item[:14])), (8, None), (9, ""), (10, " ".join([*item[:10], *item[12:24]])),
        (11, " ".join(x for w in item[:8] for x in (w, "zzz"))), (12, " ".join(other[:15] + item[:15])), (13, (filler + " ") * 20_000 + " ".join(item[:13])),
    ]
    found = leaks(spark, [(*d, 5) for d in docs], [(100, " ".join(item), "s"), (101, " ".join(item), "s"), (102, " ".join(other), "s"), (103, None, "s"), (None, "x", "s")])
    want = {(d, i) for d in (1, 2, 4, 5, 6, 7, 10, 12, 13) for i in (100, 101)} | {(12, 102)}
    assert set(found) == want
    assert found[(4, 100)].edits == 5 and found[(4, 100)].words == 40 and found[(4, 100)].slots_consistent
    assert {r.kind for r in found.values()} == {"exact", "altered"} and len(K.leaked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "b")], "item_id long, text string")).columns) == 7


def brute(words, item):
    """Exhaustive: longest equal run, and whether some pair of stretches aligns within the limits."""
    n, m = len(words), len(item)
    if any(words[i : i + 12] == item[j : j + 12] for i in range(n - 11) for j in range(m - 11)):
        return True
    for j in range(m):
        for i in range(n):
            if words[i] != item[j]:
                continue
            dist = [[99] * (n - i + 1) for _ in range(m - j + 1)]
            for b in range(m - j + 1):
                for a in range(n - i + 1):
                    if a == b == 0:
                        dist[0][0] = 0
                        continue
                    best = 99
                    if a and b:
                        best = dist[b - 1][a - 1] + (words[i + a - 1] != item[j + b - 1])
                    if a:
                        best = min(best, dist[b][a - 1] + 1)
                    if b:
                        best = min(best, dist[b - 1][a] + 1)
                    dist[b][a] = best
                    edge = max(0, min(20 - b, m - b))  # words changed at the ends
                    if a and b + edge >= 20 and words[i + a - 1] == item[j + b - 1] and 8 * (best + edge) <= b + edge:
                        return True
    return False


@pytest.mark.parametrize("seed", range(12))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    item = passage(rng, 30)
    known = K.Vocabulary([], item)
    for _ in range(6):
        words = list(item[rng.randint(0, 6) : rng.randint(22, 30)])
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(words))
            words[k : k + rng.choice([0, 1, 1])] = rng.choice([["zzz"], ["zzz"], []])
        words = ["yyy"] * 3 + words + ["xxx"] * 3
        (h, at), (g, by) = (K.windows(known.code(w), w) for w in (words, item))
        diagonals = [p - q for x, p in zip(h, at) for y, q in zip(g, by) if x == y]
        twice = sorted({int(d) for d in diagonals if diagonals.count(d) >= 2})
        made = K.evidence(K.Side(" ".join(words), known), K.Side(" ".join(item), known), twice)
        assert (made is not None and made[0] != "refilled") == brute(words, item)


def asked(a, b, v, w, x, y, z, unit="km", a2=None):
    return (
        f"From {a} some {v} boats took {w} crates to {b} over {x} {unit} and then {y} men of {a2 or a} sold {z} crates"
        f" so how many of the {v} boats of {b} took {w} crates?"
    )


QUESTION = asked("Hollowmere", "Wrenmouth", 12, 30, 7, 41, 9)


def test_refilled_questions(spark):
    docs = [
        (1, "Now then. " + asked("Ostrevane", "Junaskar", 55, 99, 31, 8, 6) + " Nobody knew."), (2, asked("Wrenmouth", "Hollowmere", 13, 31, 8, 40, 2, "miles")),
        (3, asked("Ostrevane", "Junaskar", 55, 99, 31, 8, 6, a2="Marrowdale")), (4, asked("Junaskar", "Junaskar", 55, 99, 31, 8, 6)), (5, QUESTION.upper()), (6, QUESTION.title()),
        (7, "From Ostrevane some 55 boats took 99 crates."),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, QUESTION), (2, "Two of Wrenmouth and Hollowmere lie in Kestrelby, 7 miles from here.")], "item_id long, text string")
    made = {(r.doc_id, r.item_id): r for r in K.leaked(d, i).collect()}
    assert {k: r.kind for k, r in made.items()} == {(1, 1): "refilled", (2, 1): "refilled", (5, 1): "exact", (6, 1): "exact"}
    assert made[(1, 1)].words == 34 and made[(1, 1)].edits == 11 and made[(1, 1)].slots_consistent and made[(1, 1)].run < 12
    without = {(r.doc_id, r.item_id) for r in K.leaked(d, i, slots=False).collect()}
    assert without == {(5, 1), (6, 1)}  # the placeholders are what finds the others
    in_blocks = {(r.doc_id, r.item_id) for r in K.leaked(d, i, block_words=10).collect()}
    assert {(5, 1), (6, 1), (1, 1)} <= in_blocks


def test_names_and_codes():
    texts = ["The boat of Hollowmere took 12 km to Wrenmouth today.", "Why did Hollowmere wait 3 hours for it in Wrenmouth? The end (New) Boat"]
    seen = [x for t in texts for x in K.capitals_in(t)]
    names = {w for w, inner, _ in seen if inner} - {w for w, _, low in seen if low}
    assert names == {"hollowmere", "wrenmouth", "new"}
    known = K.Vocabulary(names, {w for w, *_ in seen} - names)
    code = lambda t: known.code(K._parts(t)).tolist()
    assert code("boat of Wrenmouth took 99 hours to HOLLOWMERE") == code("Boat of Ostrevane took 7 km to Junaskar")
    assert code("boat xyz Xyz 12th")[1:] == [0, K.NAME, 0]


def test_windows_of_placeholders_need_their_words():
    known = K.Vocabulary(["rome"], ["to"])
    a, b, c = ("1 2 3 4 5".split(), "1 2 3 4 6".split(), "1 2 Rome to to".split())
    (h, _), (g, _), (k, _) = (K.windows(known.code(x), x) for x in (a, b, c))
    assert h[0] != g[0] and K.windows(known.code(a), a)[0][0] == h[0]
    assert K.windows(known.code(["7", "8", "Oslo", "to", "to"]), c)[0][0] == k[0]


def test_repeated_ids_hot_passages_and_empty(spark):
    item = passage(random.Random(3), 30)
    docs = [(1, " ".join(item)), (1, " ".join(item)), (1, "other text"), (None, " ".join(item)), (2, " ".join(item * 50))]
    assert set(leaks(spark, [(*d, 0) for d in docs], [(k, " ".join(item), "s") for k in range(40)])) == {(d, k) for d in (1, 2) for k in range(40)}
    assert leaks(spark, [], []) == {} and leaks(spark, [(1, "x", 1)], []) == {}
