"""Filling containers of one capacity with items of varying length.

The items are only seen through their length histogram: lengths are rounded up to grains of the capacity and lie in
groups of neighbouring lengths that each hold a share of the volume. A configuration linear program over the groups says
how often each way to fill a container is used. It is solved by multiplicative weights: groups not yet served become
dearer, an unbounded knapsack by dynamic programming prices the next configuration, and known configurations are used
again while their price is near the last knapsack's. Every pricing also gives a lower bound (the dual), and the program
runs until its solution is within GAP of it. Rounding follows the running total of the solution, so that it decides the
containers at every scale; a group's place goes to its longest lengths left, and room that rounding leaves goes to
others, longest first. All of it works on the histogram, whatever the number of items. Items then find their container
by arithmetic on their rank within their class, so no task ever holds more than a shard of one class.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

GRAINS = 512  # length classes; rounding up wastes at most capacity / GRAINS of an item's room
GROUPS = 96  # groups of neighbouring classes that the program tells apart, of about equal volume
GAP = 0.02  # the program runs until its value is at most this share above its lower bound
STEPS = 60_000  # steps after which the best solution so far is taken; it comes with its bound
SHARD_ROWS = 250_000  # items of a length class ranked by one task


def byte_sizes(text: Column) -> Column:
    """Tokens of a text when each UTF-8 byte is one token."""
    return F.octet_length(text)


def _cut_bytes(text: str, capacity: int) -> list[int]:
    data, sizes, at = text.encode("utf-8", "surrogatepass"), [], 0
    while at < len(data):
        end = min(at + capacity, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if end == at:
            raise ValueError(f"a character is longer than the capacity of {capacity} bytes")
        sizes.append(end - at)
        at = end
    return sizes


def byte_pieces(capacity: int) -> Callable[[Column], Column]:
    """Column function: sizes of the pieces of a text, each at most `capacity` bytes and ending at a whole character."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _cut_bytes(t, capacity) for t in texts.to_pylist()], pa.list_(pa.int32()))

    def pieces(text: Column) -> Column:
        size = byte_sizes(text)
        return F.coalesce(cut.asNondeterministic()(F.when(size > capacity, text)), F.array(size))  # only oversized texts go to Python

    return pieces


def tokenizer_pieces(path: str, capacity: int) -> Callable[[Column], Column]:
    """Column function like byte_pieces, in tokens of the public tokenizer file at `path` (JSON of the tokenizers library).

    The file is opened by each worker, so the path must be readable there. Special strings count as ordinary text.
    """
    opened: dict = {}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cut(texts: pa.Array) -> pa.Array:
        if not opened:
            from tokenizers import Tokenizer

            opened["t"] = Tokenizer.from_file(path)
            opened["t"].encode_special_tokens = True
        said = [t or "" for t in texts.to_pylist()]
        counts = [len(e.ids) for e in opened["t"].encode_batch(said, add_special_tokens=False)]
        made = [[capacity] * (n // capacity) + ([n % capacity] if n % capacity or not n else []) for n in counts]
        return pa.array([None if t is None else m for t, m in zip(texts.to_pylist(), made, strict=True)], pa.list_(pa.int32()))

    return cut.asNondeterministic()


def knapsack(prices: np.ndarray, sizes: np.ndarray, grains: int) -> tuple[float, np.ndarray]:
    """Worth and counts of the dearest configuration: how often each class (of `sizes` grains) is in a container.

    A class is offered once, twice, four times and so on, which reaches every number of it.
    """
    best, offers = np.zeros(grains + 1), []
    for k in np.nonzero(prices > 0)[0]:
        n = 1
        while (room := int(sizes[k]) * n) <= grains:
            made = best[: grains + 1 - room] + prices[k] * n
            better = made > best[room:]
            best[room:] = np.where(better, made, best[room:])
            offers.append((k, n, room, better))
            n *= 2
    counts, left = np.zeros(len(prices), dtype=np.int64), grains
    for k, n, room, better in reversed(offers):
        if left >= room and better[left - room]:
            counts[k] += n
            left -= room
    return float(best[grains]), counts


def group_classes(need: np.ndarray, most: int = GROUPS) -> list[np.ndarray]:
    """Classes (index + 1 grains) that occur, longest first, in groups of about 1 / most of the volume."""
    held = np.nonzero(need)[0][::-1]
    volume = need[held].astype(float) * (held + 1)
    part = np.ceil(np.cumsum(volume) / volume.sum() * most - 1e-9) if len(held) else held
    return [held[part == p] for p in np.unique(part)]


class Program:
    """A solved configuration program: groups, configurations (counts per group) with their use, value and lower bound."""

    def __init__(self, need: np.ndarray, grains: int) -> None:
        self.grains = grains
        self.groups = group_classes(need)
        self.sizes = np.array([g[0] + 1 for g in self.groups], dtype=np.int64)  # a group's longest length
        self.demand = np.array([need[g].sum() for g in self.groups], dtype=float)
        self.configs: list[np.ndarray] = []
        self.use: np.ndarray = np.zeros(0)
        self.value, self.bound, self.steps = (np.inf, 0.0, 0) if len(self.groups) else (0.0, 0.0, 0)
        self._index: dict[bytes, int] = {}
        self._rows = np.zeros((0, len(self.groups)))  # configurations in shares of the demand

    def _known(self, config: np.ndarray) -> int:
        key = config.tobytes()
        if key not in self._index:
            self._index[key] = len(self.configs)
            self.configs.append(config)
            self._rows = np.vstack([self._rows, config / self.demand])
        return self._index[key]

    def _price(self, weights: np.ndarray) -> tuple[float, int]:
        """The dearest configuration under the weights; their sum over its worth bounds the program from below."""
        worth, config = knapsack(weights / self.demand, self.sizes, self.grains)
        self.bound = max(self.bound, float(weights.sum()) / worth)
        return worth, self._known(config)

    def solve(self, gap: float = GAP, steps: int = STEPS, slack: float = 0.01, check: int = 200) -> Program:
        if not len(self.groups):
            return self
        for k, size in enumerate(self.sizes):
            config = np.zeros(len(self.sizes), dtype=np.int64)
            config[k] = min(self.grains // size, int(self.demand[k]))
            self._known(config)
        weights = self.demand * self.sizes / (self.demand * self.sizes).sum()  # by volume
        eps = 0.25
        while self.value > self.bound * (1 + gap) and self.steps < steps:
            weights = self._phase(weights, eps, gap, slack, check)
            eps = max(eps / 2, 0.005)
        return self

    def _phase(self, weights: np.ndarray, eps: float, gap: float, slack: float, check: int) -> np.ndarray:
        """Ten checks' steps at one rate; the mean of the prices is priced too, it bounds better than any of them."""
        used, served, mean = np.zeros(len(self.configs)), np.zeros(len(weights)), np.zeros(len(weights))
        dearest = np.inf
        for at in range(1, 10 * check + 1):
            worth = self._rows @ weights
            j = int(worth.argmax())
            if not worth[j] >= (1 - slack) * dearest:  # weights only fall, so the last knapsack stays an upper bound
                dearest, j = self._price(weights)
            used = np.append(used, np.zeros(len(self.configs) - len(used)))
            mean += weights / dearest
            step = 1 / self._rows[j].max()
            used[j] += step
            served += self._rows[j] * step
            weights = np.maximum(weights * np.exp(-eps * step * self._rows[j]), 1e-40)
            top = weights.max()
            weights, dearest = weights / top, dearest / top
            if at % check == 0:
                least = float(served.min())
                if least > 0 and used.sum() / least < self.value:
                    self.value, self.use = float(used.sum()) / least, used / least
                self._price(mean)
                if self.value <= self.bound * (1 + gap):
                    break
        self.steps += at
        return weights


def plan_containers(need: np.ndarray, grains: int, program: Program | None = None) -> tuple[list[tuple[int, int, int, int]], int]:
    """Runs (class, first rank, slots per container, first container) in order of class and rank; number of containers.

    The items of a class from a run's first rank on fill its containers in turn, that many in each.
    """
    program = Program(need, grains).solve() if program is None else program
    runs: list[tuple[int, int, int, int]] = []
    left, placed, bins = need.astype(np.int64).copy(), np.zeros(len(need), dtype=np.int64), 0
    sizes = np.arange(1, len(need) + 1)

    def use(config: np.ndarray, times: int) -> None:
        nonlocal bins
        for k in np.nonzero(config)[0]:
            runs.append((int(k), int(placed[k]), int(config[k]), bins))
            placed[k] += int(config[k]) * times
            left[k] -= int(config[k]) * times
        bins += times

    def topped(wanted: np.ndarray) -> np.ndarray:
        """Classes for a configuration of groups: a group's longest ones left, then what fits, longest first."""
        config = np.zeros(len(need), dtype=np.int64)
        for g in np.nonzero(wanted)[0]:
            places = int(wanted[g])
            for k in program.groups[g]:
                n = min(places, int(left[k]))
                config[k] += n
                places -= n
                if not places:
                    break
        room = grains - int((config * sizes).sum())
        while room > 0:
            fits = np.nonzero((left > config) & (sizes <= room))[0]
            if not len(fits):
                break
            k = int(fits[-1])
            config[k] += min(int(left[k] - config[k]), room // (k + 1))
            room = grains - int((config * sizes).sum())
        return config

    def spend(wanted: np.ndarray, times: int) -> None:
        """The configuration `times` times; whenever a class runs out, its place goes to what is left of others."""
        while times > 0 and left.any():
            now = topped(wanted)
            held = now > 0
            n = min(times, int((left[held] // now[held]).min()))
            use(now, n)
            times -= n

    order = sorted(zip(program.use.tolist(), program.configs, strict=False), key=lambda uc: (-uc[0], uc[1].tobytes()))
    total = 0.0
    for x, config in order:  # rounded along the running total, so that the containers add up to the program's
        spend(config, int(total + x) - int(total))
        total += x
    while left.any():  # what rounding left: equal containers at once, so the work depends on the classes alone
        spend(np.zeros(len(program.groups), dtype=np.int64), 1 << 60)
    return sorted(runs), bins


def _classes(size: Column, grains: int, capacity: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size * grains / F.lit(capacity))).cast("int") - 1


def _histogram(parts: DataFrame, grains: int) -> np.ndarray:
    need = np.zeros(grains, dtype=np.int64)
    for r in parts.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect():
        need[r.cls] = r.n
    return need


def fill(items: DataFrame, pieces: Callable[[Column], Column], capacity: int, grains: int = GRAINS) -> DataFrame:
    """Every item assigned to containers: item, piece_no, n_pieces, size, container.

    items: item (unique), text. pieces gives the sizes of a text's pieces: one if the text fits, several of at most
    the capacity otherwise; only those texts are split. Items with a null text are left out; an empty text takes one
    grain. Texts are read and sized once; the sizes lie in the shared folder while containers are planned. What
    reaches the driver are counts of classes and of their shards, one for SHARD_ROWS items.
    """
    spark = items.sparkSession
    grains = min(grains, capacity)
    parts = cut(pieces_table(items, pieces).withColumn("cls", _classes(F.col("size"), grains, capacity)))
    need = _histogram(parts, grains)
    runs, _ = plan_containers(need, grains)
    shards = np.maximum(1, -(-need // SHARD_ROWS))
    n_shards = F.element_at(F.array(*[F.lit(int(n)) for n in shards]), F.col("cls") + 1)
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("item", "piece_no"), n_shards).cast("int"))
    table = np.zeros((grains, int(shards.max(initial=1))), dtype=np.int64)
    for r in parts.groupBy("cls", "shard").agg(F.count(F.lit(1)).alias("n")).collect():
        table[r.cls, r.shard] = r.n
    offsets = np.concatenate([np.zeros((grains, 1), dtype=np.int64), np.cumsum(table, axis=1)[:, :-1]], axis=1)
    held = spark.sparkContext.broadcast((offsets, np.array(runs, dtype=np.int64).reshape(-1, 4)))

    @F.arrow_udf(T.LongType())
    def container(classes: pa.Array, shards: pa.Array, numbers: pa.Array) -> pa.Array:
        first, steps = held.value
        k, s, rn = (np.asarray(x.to_numpy(zero_copy_only=False)).astype(np.int64) for x in (classes, shards, numbers))
        rank = first[k, s] + rn - 1
        span = np.int64(1) << 40
        at = np.searchsorted(steps[:, 0] * span + steps[:, 1], k * span + rank, side="right") - 1
        return pa.array(steps[at, 3] + (rank - steps[at, 1]) // steps[at, 2])

    rn = F.row_number().over(Window.partitionBy("cls", "shard").orderBy("item", "piece_no"))
    return parts.withColumn("rn", rn).select(
        "item", "piece_no", "n_pieces", "size", container("cls", "shard", "rn").alias("container")
    )


def split_texts(filled: DataFrame) -> DataFrame:
    """Items that the filling spread over several containers, because no container holds them whole: item."""
    spread = filled.groupBy("item").agg(F.min("container").alias("first"), F.max("container").alias("last"))
    return spread.where("first <> last").select("item")


def program_report(items: DataFrame, pieces: Callable[[Column], Column], capacity: int, grains: int = GRAINS) -> tuple[float, float, int]:
    """Value and lower bound of the configuration program over the items, and its number of configurations in use."""
    grains = min(grains, capacity)
    program = Program(_histogram(pieces_table(items, pieces).select(_classes(F.col("size"), grains, capacity).alias("cls")), grains), grains).solve()
    return program.value, program.bound, int((program.use > 0).sum())


def pieces_table(items: DataFrame, pieces: Callable[[Column], Column]) -> DataFrame:
    """item, piece_no, n_pieces, size of every text; null texts are left out."""
    sized = items.where("text is not null and item is not null").select("item", pieces(F.col("text")).alias("sizes"))
    return sized.select("item", F.size("sizes").alias("n_pieces"), F.posexplode("sizes").alias("piece_no", "size"))
