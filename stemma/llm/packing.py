"""Filling fixed-capacity containers with items of varying length.

Items larger than a container are cut into full pieces and a rest; nothing else is split.  Only the histogram of
piece lengths reaches the driver, at most one bin for each length up to the capacity.  On it:

1. *Combinations.*  Shallow combinations that fill the window exactly are searched: one length repeated any
   number of times with one other or none, and any three lengths.  Every search looks at all of them and keeps,
   for each length, the one that lacks most in the present fit (for three lengths a maximum over sums, one
   vector operation per length, spread over the cluster where there are many lengths).
2. *Non-negative least squares.*  Repeat counts of the combinations kept are fitted to the histogram by projected
   gradient with momentum, and the search goes on from what is still lacking, until no combination
   improves the fit.
3. *Rounding.*  Counts are rounded down and placed, and what remains is fitted again until no count reaches one.
4. *The rest* is packed greedily on counts, always the longest length that still fits.

The plan is a table of ranges: the items of one length with ranks from a to b go to these containers at this offset.
Ranks come from salted row numbers with prefix sums, so no length gathers in one task.  All capacities are
served in one pass over the items.

Defined results: null texts and texts without tokens take no room and come out with null container; repeated
documents are packed like others; ties of equal length are ranked by hash and id; capacities that are null or
below 1 are refused; a capacity listed under two names is packed under each; without documents there are no
containers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PER_SALT = 100_000
#: Lengths for which one search is shared out over the cluster; the search itself is the same.
SPREAD_FROM = 20_000
WIDTH = 3


def three_lengths(gain: np.ndarray, some: np.ndarray, capacity: int) -> np.ndarray:
    """(n, 3): for each length of ``some`` the three lengths filling the window that gain most in sum.

    gain: by length from 0 to the capacity, minus infinity for lengths that do not occur.
    """
    out = np.zeros((len(some), WIDTH), dtype=np.int64)
    for i, a in enumerate(some.tolist()):
        rest = capacity - a
        if rest < 2:
            continue
        half = rest // 2
        # b up to half, c the other part, read backwards
        sums = gain[1 : half + 1] + gain[rest - 1 : rest - half - 1 : -1]
        b = int(sums.argmax()) + 1
        if np.isfinite(sums[b - 1]):
            out[i] = a, b, rest - b
    return out[out[:, 0] > 0]


def repeated_lengths(gain: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, times), each (n, 3): for each length the best number of repeats with one other length or none."""
    cols, times = [], []
    for a in lengths.tolist():
        k = np.arange(1, capacity // a + 1)
        rest = capacity - k * a
        other = np.where(rest > 0, gain[rest], 0.0)
        value = (k * gain[a] + other) / np.sqrt(k * k + (rest > 0))
        best = int(value.argmax())
        if np.isfinite(value[best]):
            r = int(rest[best])
            cols.append((a, r or a, a))
            times.append((int(k[best]), int(r > 0), 0))
    return np.array(cols, dtype=np.int64).reshape(-1, WIDTH), np.array(times, dtype=np.int64).reshape(-1, WIDTH)


def _search_three(spark: SparkSession | None, gain: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    if spark is None or len(lengths) < SPREAD_FROM:
        return three_lengths(gain, lengths, capacity)
    shared = spark.sparkContext.broadcast((gain, lengths))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, all_ = shared.value
        for b in batches:
            yield pd.DataFrame(three_lengths(g, all_[b["id"].to_numpy()], capacity), columns=["a", "b", "c"])

    parts = max(spark.sparkContext.defaultParallelism, len(lengths) // 500)
    return spark.range(0, len(lengths), 1, parts).mapInPandas(rows, "a long, b long, c long").toPandas().to_numpy()


def refit(cols: np.ndarray, times: np.ndarray, weight: np.ndarray, counts: np.ndarray, x: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative repeat counts of the kept combinations by projected gradient, every step no longer than its column allows."""
    size = len(counts)
    flat = cols.ravel()
    w = weight[flat] * times.ravel()
    target = weight * counts
    forward = lambda v: np.bincount(flat, np.repeat(v, WIDTH) * w, size)
    backward = lambda r: (r[flat] * w).reshape(-1, WIDTH).sum(axis=1)
    step = 1.0 / np.maximum(backward(forward(np.ones(len(cols)))), 1e-12)
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.clip(y - step * backward(forward(y) - target), 0, None)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def least_squares(counts: np.ndarray, capacity: int, spark: SparkSession | None = None, rounds: int = 80, steps: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, times, repeats) of the combinations that fit the histogram; longer lengths weigh more.

    counts: by length from 0 to the capacity.  The fit ends when no combination gains half an item in norm any more,
    or when a round brings the distance down by less than a ten-thousandth.
    """
    lengths = np.nonzero(counts)[0]
    weight = np.sqrt(np.arange(capacity + 1) / capacity + 0.05)
    cols, times, x = np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64), np.zeros(0)
    fit, before = np.zeros(capacity + 1), np.inf
    for _ in range(rounds):
        lack = weight * (weight * counts - fit)
        gain = np.full(capacity + 1, -np.inf)
        gain[lengths] = lack[lengths]
        two, n_two = repeated_lengths(gain, lengths, capacity)
        three = _search_three(spark, gain, lengths, capacity)
        found = np.vstack([np.hstack([two, n_two]), np.hstack([three, np.ones_like(three)])])
        norm = np.sqrt(((weight[found[:, :WIDTH]] * found[:, WIDTH:]) ** 2).sum(axis=1))
        value = (gain[found[:, :WIDTH]] * found[:, WIDTH:]).sum(axis=1)
        found = found[value > 0.5 * norm]
        if len(found) == 0:
            break
        # equal combinations once, whatever length they were found from
        found[:, :WIDTH], found[:, WIDTH:] = (np.take_along_axis(z, np.argsort(found[:, :WIDTH], axis=1, kind="stable"), axis=1) for z in (found[:, :WIDTH].copy(), found[:, WIDTH:].copy()))
        keep = x > 1e-9
        cols, times, x = cols[keep], times[keep], x[keep]
        both = np.vstack([np.hstack([cols, times]), found])
        both, first = np.unique(both, axis=0, return_index=True)
        start = np.concatenate([x, np.zeros(len(found))])[first]
        cols, times = both[:, :WIDTH], both[:, WIDTH:]
        x = refit(cols, times, weight, counts, start, steps)
        flat = cols.ravel()
        fit = np.bincount(flat, np.repeat(x, WIDTH) * weight[flat] * times.ravel(), capacity + 1)
        now = float(((weight * counts - fit)[lengths] ** 2).sum())
        if now > 0.9999 * before:
            break
        before = now
    return cols, times, x


def plan(histogram: dict[int, int], capacity: int, spark: SparkSession | None = None, combine: bool = True) -> tuple[pd.DataFrame, int, int]:
    """(ranges, containers, containers filled by combinations).

    A range: length, start and end rank, first container, offset, by_pattern.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    used = np.zeros(capacity + 1, dtype=np.int64)
    ranges: list[tuple[int, int, int, int, int, bool]] = []
    containers = 0

    def place(parts: list[tuple[int, int]], repeat: int, by_pattern: bool) -> None:
        """repeat containers, each holding times items of every length."""
        nonlocal containers
        offset = 0
        for length, times in parts:
            for _ in range(times):
                ranges.append((length, int(used[length]), int(used[length]) + repeat, containers, offset, by_pattern))
                used[length] += repeat
                left[length] -= repeat
                offset += length
        containers += repeat

    while combine and left.any():
        cols, times, x = least_squares(left.astype(float), capacity, spark)
        before = containers
        for p in np.argsort(-x, kind="stable"):
            want = int(x[p] + 1e-6)
            if want < 1:
                break
            need: dict[int, int] = {}
            for length, k in zip(cols[p].tolist(), times[p].tolist()):
                if k:
                    need[length] = need.get(length, 0) + k
            repeat = min(want, *(int(left[a]) // k for a, k in need.items()))
            if repeat > 0:
                place(sorted(need.items(), reverse=True), repeat, True)
        if containers == before:
            break
    by_pattern = containers
    # the rest greedily, on counts: the longest length, then always the longest that fits
    while True:
        open_ = np.nonzero(left)[0]
        if len(open_) == 0:
            break
        room, parts = capacity, []
        taken: dict[int, int] = {}
        top = len(open_)
        while room > 0:
            top = int(np.searchsorted(open_[:top], room, side="right"))
            if top == 0:
                break
            length = int(open_[top - 1])
            times_ = min(room // length, int(left[length]))
            parts.append((length, times_))
            taken[length] = times_
            room -= length * times_
            top -= 1
        place(parts, min(int(left[a]) // k for a, k in taken.items()), False)
    return pd.DataFrame(ranges, columns=["length", "start", "end", "container", "offset", "by_pattern"]), containers, by_pattern


def pieces(docs: DataFrame, doc_id: str, tokens: str, budgets: dict[str, int]) -> DataFrame:
    """(budget, doc_id, piece_no, n_tokens) for every budget: the document, or full pieces and the rest of a larger one."""
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("budget"), F.lit(c).cast("long").alias("capacity")) for b, c in budgets.items()]))
    rows = docs.select(F.col(doc_id), F.col(tokens).cast("long").alias("n"), each.alias("b")).select(doc_id, "n", "b.*")
    many = F.greatest(F.ceil(F.col("n") / F.col("capacity")), F.lit(1)).cast("int")
    parts = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(1), many)))
    rest = F.col("n") - (F.col("piece_no") - 1) * F.col("capacity")
    return parts.select("budget", doc_id, "piece_no", F.least(rest, F.col("capacity")).cast("int").alias("n_tokens"))


def ranked(items: DataFrame, total: int) -> DataFrame:
    """Add ``rank``, from 0 within each budget and length; each length is spread over salts."""
    salts = max(8, -(-total // PER_SALT))
    ids = [c for c in items.columns if c not in ("n_tokens", "budget")]
    group = ["budget", "n_tokens"]
    salted = items.withColumn("salt", F.pmod(F.xxhash64(*ids), F.lit(salts)))
    counts = salted.groupBy(*group, "salt").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy(*group).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = Window.partitionBy(*group, "salt").orderBy(*ids)
    return (
        salted.withColumn("r", F.row_number().over(inside) - 1)
        .join(base, [*group, "salt"])
        .withColumn("rank", F.col("r") + F.col("base"))
        .drop("r", "base", "salt")
    )


def pack(docs: DataFrame, doc_id: str, tokens: str, budgets: dict[str, int]) -> DataFrame:
    """(budget, doc_id, piece_no, n_tokens, container_id, start_token, filled_by) of every piece for every budget.

    filled_by: ``combination`` or ``rest``.  Rows of one document are told apart by their ids only.
    """
    for name, capacity in budgets.items():
        if capacity is None or capacity < 1:
            raise ValueError(f"capacity {capacity} of {name} is below 1")
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"budget string, {doc_id} {kind}, piece_no int, n_tokens int, container_id bigint, start_token int, filled_by string"
    if not budgets:
        return spark.createDataFrame([], schema)
    all_pieces = pieces(docs, doc_id, tokens, budgets)
    full = all_pieces.where("n_tokens > 0")
    rows = full.groupBy("budget", "n_tokens").agg(F.count(F.lit(1)).alias("c")).collect()
    plans = {}
    for name, capacity in budgets.items():
        histogram = {r["n_tokens"]: r["c"] for r in rows if r["budget"] == name}
        ranges, _, _ = plan(histogram, capacity, spark)
        # one number line for all lengths: base of the length plus rank
        bases, at = np.zeros(capacity + 1, dtype=np.int64), 0
        for length in sorted(histogram):
            bases[length] = at
            at += histogram[length]
        ranges["g"] = bases[ranges["length"].to_numpy(dtype=np.int64)] + ranges["start"].to_numpy(dtype=np.int64)
        ranges = ranges.sort_values("g")
        plans[name] = (bases, *(ranges[c].to_numpy(dtype=np.int64) for c in ("g", "container", "offset")), ranges["by_pattern"].to_numpy(dtype=bool))
    shared = spark.sparkContext.broadcast(plans)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, b in batch.groupby("budget", sort=False):
                bases, start, first, offset, by_pattern = shared.value[name]
                g = bases[b["n_tokens"].to_numpy()] + b["rank"].to_numpy()
                i = np.searchsorted(start, g, side="right") - 1
                b = b.drop(columns="rank")
                b["container_id"] = first[i] + (g - start[i])
                b["start_token"] = offset[i].astype("int32")
                b["filled_by"] = np.where(by_pattern[i], "combination", "rest")
                yield b

    placed = ranked(full, sum(r["c"] for r in rows)).select("budget", doc_id, "piece_no", "n_tokens", "rank").mapInPandas(assign, schema)
    none = [F.lit(None).cast("bigint").alias("container_id"), F.lit(None).cast("int").alias("start_token"), F.lit(None).cast("string").alias("filled_by")]
    return placed.unionByName(all_pieces.where("n_tokens <= 0").select("budget", doc_id, "piece_no", "n_tokens", *none))
