"""Best-fit packing: a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits into one sequence. The LP
asks for the fewest configurations that cover the histogram. It is solved by
multiplicative weights: each length carries a price, a knapsack dynamic
program finds the configuration of highest price, and a small step lowers the
prices of what it covers. Prices scaled so that no configuration costs more
than 1 are a dual solution, so every round gives a lower bound; the epochs go
on with smaller steps until solution and bound meet, and basis exchange with
the same knapsack closes what gap they leave. The fractional solution is
rounded down and the small remainder placed best fit, so the configurations
partition the histogram exactly and sequences have no holes.

The histogram has at most ``capacity`` entries at any input size, so solving
it on the driver is bounded. Which piece goes where follows from its rank
among the pieces of its length: sequence and offset are read from the list of
configurations inside the tasks, without another shuffle.

Defined results: lengths must be 1..capacity; an empty histogram gives no
configuration; equal lengths are interchangeable and ordered by (doc_id,
piece); rows with equal (doc_id, piece) are ordered arbitrarily but each gets
a place of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import gapless_rank, materialise


def best_configuration(price: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Knapsack by dynamic programming: counts per length of the configuration with the highest total price.

    Among equal prices the largest length is taken first.
    """
    cap = len(price) - 1
    if present.sum() <= 96:
        return _best_of_few(price, np.flatnonzero(present)[::-1], cap)
    value = np.where(present, price, -np.inf)[::-1].copy()  # value[cap - l]: price of length l
    best, pick = np.zeros(cap + 1), np.zeros(cap + 1, dtype=np.int64)
    for c in range(1, cap + 1):
        gain = value[cap - c : cap] + best[:c]  # lengths c, c - 1, ..., 1 on top of free spaces 0, 1, ..., c - 1
        k = int(gain.argmax())
        if gain[k] > best[c - 1] + 1e-12:
            best[c], pick[c] = gain[k], c - k
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(cap + 1, dtype=np.int64), cap
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return counts


def _best_of_few(price: np.ndarray, sizes: np.ndarray, cap: int) -> np.ndarray:
    """The same length by length: spaces that differ by multiples of a length are a column, and a running maximum does it."""
    tables = [np.zeros(cap + 1)]
    for size in sizes.tolist():
        deep = cap // size + 1
        paid = np.arange(deep)[:, None] * price[size]
        grid = np.full(deep * size, -np.inf)
        grid[: cap + 1] = tables[-1]
        grid = np.maximum.accumulate(grid.reshape(deep, size) - paid, axis=0) + paid
        tables.append(np.maximum(grid.ravel()[: cap + 1], tables[-1]))
    counts, c = np.zeros(cap + 1, dtype=np.int64), cap
    for k in range(len(sizes), 0, -1):
        while tables[k][c] > tables[k - 1][c] + 1e-12:
            counts[sizes[k - 1]] += 1
            c -= int(sizes[k - 1])
    return counts


def starting_prices(hist: np.ndarray) -> np.ndarray:
    """Feasible dual prices of largest value among the shares of a sequence and the dual feasible functions
    floor((k + 1) x) / k of the share x (x itself where (k + 1) x is whole): no configuration costs more than 1."""
    size = np.arange(len(hist))
    cap = len(hist) - 1
    best = size / cap
    for k in range(1, 100):
        whole = size * (k + 1) % cap == 0
        price = np.where(whole, size / cap, size * (k + 1) // cap / k)
        if hist @ price > hist @ best * (1 + 1e-9):
            best = price
    return best


def reprice(hist: np.ndarray, price: np.ndarray, rate: float, rounds: int) -> tuple[np.ndarray, float]:
    """Multiplicative weights: (mean of the rounds' prices, best dual bound).

    A round takes the dearest of all configurations as far as its scarcest length goes and lowers the price of each of its
    lengths by exp(-rate * the part covered). The prices of a round, scaled so that no configuration costs more than 1, are
    a feasible dual solution; so is their mean, scaled again. What they pay for every piece is a lower bound of the LP.
    """
    goal, on = hist.astype(float), hist > 0
    w, total, spent, bound = price * on, np.zeros(len(hist)), 0.0, 0.0
    for _ in range(rounds):
        w = w / w.max()
        counts = best_configuration(w, on)
        at = np.flatnonzero(counts)
        dual = w / (counts @ w)
        bound = max(bound, float(hist @ dual))
        part = counts[at] / goal[at]
        times = 1 / part.max()
        total += times * dual
        spent += times
        w[at] *= np.exp(-rate * times * part)
    mean = total / spent
    mean /= mean.max()
    return mean, max(bound, float(hist @ mean / (best_configuration(mean, on) @ mean)))


def covering(hist: np.ndarray, price: np.ndarray, step: float, rate: float) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used, in fractions, so that every length is covered exactly.

    Each round takes the configuration of highest price among the lengths not covered yet, for ``step`` of its scarcest
    length or for what is left of it, and lowers the prices of its lengths by exp(-rate * the part covered).
    """
    goal = hist.astype(float)
    rest, w = goal.copy(), price.copy()
    used: dict[bytes, float] = {}
    while (present := rest > 1e-9 * goal).any():
        w = np.where(present, np.maximum(w / w[present].max() if w[present].max() > 0 else 0.0, 1e-9 * np.arange(len(w))), 0.0)
        counts = best_configuration(w, present)
        at = np.flatnonzero(counts)
        times = float((np.minimum(rest[at], step * goal[at]) / counts[at]).min())
        rest[at] -= times * counts[at]
        w[at] *= np.exp(-rate * times * counts[at] / goal[at])
        used[counts.tobytes()] = used.get(counts.tobytes(), 0.0) + times
    return [(np.frombuffer(k, dtype=np.int64), t) for k, t in used.items()]


def exchange(hist: np.ndarray, rounds: int, gap: float) -> tuple[list[tuple[np.ndarray, float]], float]:
    """(fractional solution, dual bound) by basis exchange with the knapsack as pricing step: the LP's optimum if it ends
    within ``rounds``. The basis has one configuration per length, so rounding down loses little."""
    at = np.flatnonzero(hist)
    goal, cap = hist[at].astype(float), len(hist) - 1
    basis, bound = np.diag(cap // at).astype(float), 0.0
    for k in range(rounds + 1):
        inverse = np.linalg.inv(basis)
        x = np.maximum(inverse @ goal, 0)
        price = np.zeros(cap + 1)
        price[at] = np.maximum(inverse.sum(0), 0)
        counts = best_configuration(price, price > 0)
        value = counts @ price
        bound = max(bound, float(hist @ price / value))
        if value <= 1 + 1e-9 or x.sum() <= bound * (1 + gap / 10) or k == rounds:
            break
        into = inverse @ counts[at]
        out = np.where(into > 1e-9, x / np.where(into > 1e-9, into, 1), np.inf).argmin()
        basis[:, out] = counts[at]
    found = []
    for column, times in zip(basis.T, x, strict=True):
        counts = np.zeros(cap + 1, dtype=np.int64)
        counts[at] = np.rint(column)
        found.append((counts, float(times)))
    return found, bound


def best_fit(left: np.ndarray) -> list[np.ndarray]:
    """One configuration after the other: the largest length left, then the largest that fits, until nothing is left."""
    left, out = left.copy(), []
    while left.any():
        counts, space = np.zeros(len(left), dtype=np.int64), len(left) - 1
        while space > 0:
            fits = np.flatnonzero(left[1 : space + 1])
            if not len(fits):
                break
            size = int(fits[-1]) + 1
            times = min(space // size, int(left[size]))
            counts[size] += times
            left[size] -= times
            space -= times * size
        out.append(counts)
    return out


def rounded(hist: np.ndarray, used: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, int]]:
    """The fractional solution rounded down; what that leaves (less than one sequence per configuration, so bounded at any
    input size) goes best fit."""
    left, found = hist.astype(np.int64).copy(), {}
    for counts, times in used:
        whole = int(times + 1e-9)
        if whole:
            left -= whole * counts
            found[counts.tobytes()] = found.get(counts.tobytes(), 0) + whole
    for counts in best_fit(left):
        found[counts.tobytes()] = found.get(counts.tobytes(), 0) + 1
    return [(np.frombuffer(k, dtype=np.int64), n) for k, n in found.items()]


def solve(hist: np.ndarray, gap: float = 1e-3, epochs: int = 4) -> tuple[list[tuple[np.ndarray, int]], float]:
    """(configurations and how many sequences use them, the dual bound). Together exactly ``hist``.

    Prices are first the shares of a sequence. Epochs of multiplicative weights with ever smaller steps follow, each from
    the prices of the one before, until the best rounded solution is within one sequence, or the part ``gap``, of the best
    dual bound. Where the epochs leave a gap (their solutions are near the optimum long before their bounds are), basis
    exchange closes it; its rounds are bounded by work, and the best solution and bound found then stand.
    """
    lengths, size = int((hist > 0).sum()), np.arange(len(hist)) / (len(hist) - 1)
    few = lengths <= 256
    start = starting_prices(hist)
    bound, best = max(float(hist @ size), float(hist @ start)), None
    price = size
    for epoch in range(epochs if few else 2):
        step = 0.5**epoch
        if epoch:
            first = 0.98 * start + 0.02 * size if epoch == 1 else price
            price, found = reprice(hist, first, step / 2, 4 * lengths if few else lengths)
            bound = max(bound, found)
        configs = rounded(hist, covering(hist, price, step if few else 1.0, 0.5 / step if epoch else 0.1))
        if best is None or _sequences(configs) < _sequences(best):
            best = configs
        if _met(best, bound, gap):
            return best, bound
    used, found = exchange(hist, 50 + int(2e10 / lengths**3) if lengths > 30 else 1000, gap)
    configs = rounded(hist, used)
    return (configs if _sequences(configs) < _sequences(best) else best), max(bound, found)


def _sequences(configs: list[tuple[np.ndarray, int]]) -> int:
    return sum(n for _, n in configs)


def _met(configs: list[tuple[np.ndarray, int]], bound: float, gap: float) -> bool:
    least = np.ceil(bound - 1e-6)
    return _sequences(configs) <= max(least + 1, least * (1 + gap))


def configurations(hist: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(counts per length, how many sequences use them): together exactly ``hist``. ``hist[l]``: pieces of length l."""
    return solve(hist)[0] if hist.any() else []


def places(configs: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """For every (length, run of ranks): where the run begins, its first sequence, items per sequence, first offset."""
    rows, taken, sequence = [], {}, 0
    for counts, times in configs:
        offset = 0
        for size in np.flatnonzero(counts)[::-1]:
            per = int(counts[size])
            first = taken.get(int(size), 0)
            rows.append((int(size), first, sequence, per, offset))
            taken[int(size)] = first + per * times
            offset += per * int(size)
        sequence += times
    cols = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return {"key": cols[:, 0] << 48 | cols[:, 1], "first": cols[:, 1], "sequence": cols[:, 2], "per": cols[:, 3], "offset": cols[:, 4]}


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, length, ...); extra columns stay."""
    pieces = materialise(spark, pieces, "pieces")
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        hist[size] = n
    table = places(configurations(hist))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(table["key"], size << 48 | r, side="right") - 1
        r = r - table["first"][at]
        per = table["per"][at]
        return pd.DataFrame({"sequence_id": table["sequence"][at] + r // per, "offset": table["offset"][at] + (r % per) * size})

    salts = int(max(64, hist.sum() // 200_000))
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece"], "__rank", salts)
    placed = ranked.withColumn("__at", place("length", "__rank"))
    return placed.select(*pieces.columns, "__at.sequence_id", "__at.offset")
