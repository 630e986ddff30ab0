import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafquarry.llm import packing as P


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        prices = np.where(rng.random(12) < 0.6, rng.random(12), 0.0)
        best = np.zeros(13)
        for room in range(1, 13):
            best[room] = max([0.0, *(best[room - k - 1] + prices[k] for k in range(room))])
        worth, config = P.knapsack(prices, np.arange(1, 13), 12)
        assert (config * np.arange(1, 13)).sum() <= 12 and abs((config * prices).sum() - best[12]) < 1e-9 and abs(worth - best[12]) < 1e-9


def histograms():
    rng = np.random.default_rng(1)
    k = np.arange(512)
    hard = np.zeros(512, dtype=int)  # longest first needs 11 containers here where 9 do
    hard[[259, 135, 131, 119]] = 6000, 6000, 6000, 12000
    return {
        "dense": rng.integers(50, 200, 512), "harmonic": (1e6 / (k + 1)).astype(int), "bell": (1e5 * np.exp(-(((k - 150) / 60.0) ** 2))).astype(int),
        "hard": hard, "sparse": np.where(rng.random(512) < 0.05, rng.integers(1, 100, 512), 0), "none": np.zeros(512, dtype=int), "one": np.eye(1, 512, 511, dtype=int)[0],
    }


@pytest.mark.parametrize("name", list(histograms()))
def test_program_reaches_its_bound(name):
    need = histograms()[name]
    program = P.Program(need, 512).solve()
    assert program.steps < P.STEPS and program.value <= (1 + P.GAP) * program.bound + 1e-9
    assert program.bound <= 1e-6 + (need * np.arange(1, 513)).sum() / 512 * 1.2 or name in ("sparse", "one")
    for config in program.configs:
        assert (config * program.sizes).sum() <= 512
    if need.any():
        assert (np.array(program.configs)[: len(program.use)].T @ program.use >= program.demand * (1 - 1e-9)).all()
        assert sorted(np.concatenate(program.groups)) == np.nonzero(need)[0].tolist()


def containers(need, runs):
    """Room used per container and items served per class."""
    room, served = {}, np.zeros(len(need), dtype=int)
    for k in range(len(need)):
        own = [r for r in runs if r[0] == k]
        for (_, start, per, first), nxt in zip(own, [*[r[1] for r in own[1:]], need[k]]):
            for rank in range(start, nxt):
                b = first + (rank - start) // per
                room[b] = room.get(b, 0) + k + 1
                served[k] += 1
    return room, served


def test_plan_serves_every_item_within_capacity():
    rng = np.random.default_rng(5)
    for scale in (1, 30, 400):
        need = rng.integers(0, 3 * scale, 64)
        runs, bins = P.plan_containers(need, 64)
        room, served = containers(need, runs)
        assert (served == need).all() and max(room.values(), default=0) <= 64 and max(room, default=-1) < bins


def test_the_program_decides_the_filling():
    need = histograms()["hard"]
    empty = P.Program(need, 512)
    assert P.plan_containers(need, 512)[1] == 9000
    assert P.plan_containers(need, 512, empty)[1] == 11000
    small = need // 100
    assert P.plan_containers(small, 512)[1] <= 92 < P.plan_containers(small, 512, P.Program(small, 512))[1]


def test_fill(spark):
    rng = random.Random(7)
    texts = [(i, "é" * n if i % 3 else "x" * n, "clash") for i, n in enumerate([0, 1, 50, 51, 100, 101, 333, *(rng.randint(0, 130) for _ in range(400))])]
    df = spark.createDataFrame([*texts, (9999, None, "")], "item long, text string, size string")
    made = P.fill(df, P.byte_pieces(100), 100, grains=20).collect()
    by_item, by_box = {}, {}
    for r in made:
        by_item.setdefault(r.item, []).append(r)
        by_box[r.container] = by_box.get(r.container, 0) + r["size"]
    assert max(by_box.values()) <= 100 and set(by_item) == {i for i, *_ in texts}
    for i, t, _ in texts:
        size = len(t.encode())
        assert sum(r["size"] for r in by_item[i]) == size and (len(by_item[i]) > 1) == (size > 100)
        assert sorted(r.piece_no for r in by_item[i]) == list(range(len(by_item[i])))


def test_pieces_end_at_characters():
    assert P._cut_bytes("ééé", 3) == [2, 2, 2]
    assert P._cut_bytes("", 3) == []
    assert sum(P._cut_bytes("a😀b" * 1000, 64)) == 6000
    with pytest.raises(ValueError):
        P._cut_bytes("aé", 1)


def test_split_texts(spark):
    df = spark.createDataFrame([(1, "x" * 10), (2, "x" * 11), (3, ""), (4, None), (5, "x" * 99)], "item long, text string")
    assert {r.item for r in P.split_texts(P.fill(df, P.byte_pieces(10), 10)).collect()} == {2, 5}


def test_hot_class_is_ranked_in_shards(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 10)
    df = spark.range(300).selectExpr("id as item", "repeat('x', 30) as text")
    made = P.fill(df, P.byte_pieces(100), 100).groupBy("container").count().collect()
    assert len(made) == 100 and {r["count"] for r in made} == {3}


def test_empty(spark):
    df = spark.createDataFrame([], "item long, text string")
    assert P.fill(df, P.byte_pieces(10), 10).where(F.lit(True)).count() == 0


def test_tokenizer_pieces(spark):
    public = pytest.importorskip("public_tokenizers")  # the package of public vocabulary files that /opt/tokenizers links to
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [(1, "The working paper " * 30), (2, "short"), (3, ""), (4, None), (5, "é<|endoftext|>" * 9)]
    df = spark.createDataFrame(texts, "item long, text string")
    made = P.fill(df, P.tokenizer_pieces(path, 64), 64, grains=64).collect()
    size, box = {}, {}
    for r in made:
        size[r.item] = size.get(r.item, 0) + r["size"]
        box[r.container] = box.get(r.container, 0) + r["size"]
    assert set(size) == {1, 2, 3, 5} and max(box.values()) <= 64
    assert size[1] == len(tok.encode(texts[0][1], add_special_tokens=False).ids) and size[2] == len(tok.encode("short").ids) and size[3] == 0
