"""Packing documents into token sequences as a cutting-stock problem.

A document's ids end with an end id.  Whole sequences are cut off its front; what remains, and
every shorter document, is an item.  Items count by length class (``UNIT`` tokens wide), and this
histogram, at most length / UNIT numbers, is all that reaches the driver.  There a linear program
over patterns (how many items of each class share a sequence) is solved by column generation: a
knapsack by dynamic programming prices new patterns with the classes' dual values until the total is
within ``GAP`` of its bound.  The rounded-down patterns are used as often as the solution says, the
few items left over are packed best fit decreasing.  Documents are ranked within their class, and
a rank finds its sequence and its place by position in the list of patterns.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import stage, text_of
from starmill.llm.tokens import default_path, token_bytes

LENGTH = 4096
UNIT = 8
END_ID = 2
GAP = 2e-3
#: Patterns that one round of the linear program adds at most.
POOL = 64


# --- tokens ----------------------------------------------------------------------------


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """The documents' pieces: ``doc_id``, ``start``, ``length``, ``ids`` (bytes), ``doc_tokens``.

    A piece is ``length`` ids long, a document's last piece what remains.  A null text is empty
    and makes one piece, the end id.
    """
    path = path or default_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], token_bytes(batch["text"], path), strict=True):
                ids += struct.pack("<I", end_id)
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(part) // 4, part, total))
                if len(rows) >= 500:
                    yield _frame(rows)
                    rows = []
            if rows:
                yield _frame(rows)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long"
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


# --- cutting stock -----------------------------------------------------------------------


def _knapsack(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack for every room up to ``capacity``: the worth, and the class put in last (-1: none).

    ``widths`` ascend.
    """
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fits = np.searchsorted(widths, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fits[room]
        if n:
            worth = best[room - widths[:n]] + values[:n]
            i = int(worth.argmax())
            if worth[i] > best[room] + 1e-12:
                best[room], last[room] = worth[i], i
    return best, last


def _filled(last: list[int], widths: list[int], room: int) -> np.ndarray:
    """How many of each class the knapsack puts in ``room``."""
    counts = np.zeros(len(widths), dtype=np.int64)
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= widths[last[room]]
    return counts


def _best_pattern(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of widths within ``capacity``."""
    best, last = _knapsack(values, widths, capacity)
    return float(best[capacity]), _filled(last.tolist(), widths.tolist(), capacity)


def _best_patterns(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The worth of the best pattern, and for each class the best pattern that holds one of it."""
    best, last = _knapsack(values, widths, capacity)
    last, sizes = last.tolist(), widths.tolist()
    found = np.array([_filled(last, sizes, capacity - size) for size in sizes])
    found[np.arange(len(sizes)), np.arange(len(sizes))] += 1
    return float(best[capacity]), found


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination.  The driver's process calls no threaded linear algebra, which may hang there."""
    n = len(matrix)
    both = np.hstack([matrix.astype(np.float64), np.eye(n)])
    for i in range(n):
        j = i + int(np.abs(both[i:, i]).argmax())
        both[[i, j]] = both[[j, i]]
        both[i] /= both[i, i]
        factors = both[:, i].copy()
        factors[i] = 0
        both -= factors[:, None] * both[i]
    return both[:, n:]


def _first_basis(widths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A pattern (column) for each class and how often it is used: the widest left first, then what fits.

    Each pattern is used until a class of it is exhausted, and stands in that class's place.  Later
    patterns hold none of that class, so the columns are independent.
    """
    n = len(widths)
    left = demand.copy()
    patterns, used = np.zeros((n, n), dtype=np.int64), np.zeros(n)
    open_classes = list(range(n - 1, -1, -1))
    sizes = widths.tolist()
    while open_classes:
        counts, room = {}, capacity
        for i in open_classes:
            if sizes[i] <= room:
                counts[i], room = divmod(room, sizes[i])
        out = min(counts, key=lambda i: left[i] / counts[i])
        times = left[out] / counts[out]
        for i, count in counts.items():
            patterns[i, out] = count
            left[i] = max(left[i] - times * count, 0.0)
        used[out] = times
        open_classes.remove(out)
    return patterns, used


def linear_program(widths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, fractions included: within ``gap`` of the fewest.

    Any dual values over the worth of the best pattern for them bound the optimum from below; the
    best bound so far is kept, with the values that gave it.  It begins with what the widths alone
    need.  The first basis fills sequences with the widest first.  Each round prices two points, the
    present values and the middle between them and the best ones, which swings less, and takes
    from both the ``POOL`` best patterns that hold this or that class; the basis changes until none of
    them improves it.  The end is a total within ``gap`` of the bound, or within half a
    sequence, or a bound that says that nothing improves; each round improves, so it comes.

    Demands get small seeded shares on top, else equal ratios could exchange the same patterns for
    ever.
    """
    n = len(widths)
    demand = demand + np.random.default_rng(1).random(n) * 1e-2
    patterns, used = _first_basis(widths, demand, capacity)  # column j: pattern of basis place j
    if used.sum() <= (demand * widths).sum() / capacity * (1 + gap):
        return patterns.T, used
    inverse = _inverse(patterns)
    bound, centre = float((demand * widths).sum()) / capacity, widths / capacity
    changes = 0
    while True:
        values = inverse.sum(axis=0)
        worth, found = _best_patterns(values, widths, capacity)
        total = float(used.sum())
        level = float((demand * values).sum()) / worth
        if level > bound:
            bound, centre = level, values / worth
        if worth <= 1 + 1e-9 or total <= bound * (1 + gap) or total - bound < 0.5:
            break
        found = np.unique(np.vstack([found, _best_patterns((values + centre) / 2, widths, capacity)[1]]), axis=0)
        pool = found[np.argsort(-(found * values).sum(axis=1), kind="stable")[:POOL]]
        while True:
            gains = (pool * inverse.sum(axis=0)).sum(axis=1)
            pattern = pool[int(gains.argmax())]
            if gains.max() <= 1 + 1e-9:
                break
            direction = (inverse * pattern).sum(axis=1)
            rising = direction > 1e-9
            ratios = np.full(n, np.inf)
            ratios[rising] = np.maximum(used[rising], 0) / direction[rising]
            out = int(ratios.argmin())
            used = used - ratios[out] * direction
            used[out] = ratios[out]
            patterns[:, out] = pattern
            pivot = inverse[out] / direction[out]
            inverse -= direction[:, None] * pivot
            inverse[out] = pivot
            changes += 1
            if changes % 500 == 0:  # rounding errors must not add up
                inverse = _inverse(patterns)
                used = (inverse * demand).sum(axis=1)
    return patterns.T, np.maximum(used, 0)


def _best_fit(classes: list[int], capacity: int) -> list[dict[int, int]]:
    """Best fit decreasing; one dictionary (class to count) per sequence."""
    by_room: dict[int, list[dict[int, int]]] = {}
    for width in sorted(classes, reverse=True):
        room = next((r for r in range(width, capacity) if by_room.get(r)), capacity)
        counts = by_room[room].pop() if room < capacity else {}
        counts[width] = counts.get(width, 0) + 1
        by_room.setdefault(room - width, []).append(counts)
    return [counts for group in by_room.values() for counts in group]


def plan(histogram: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns (class to count) with the number of sequences cut by each; every item is in one."""
    if not histogram:
        return []
    widths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[w] for w in widths.tolist()], dtype=np.float64)
    patterns, used = linear_program(widths, demand, capacity, gap)
    left = demand.astype(np.int64)
    chosen: list[tuple[dict[int, int], int]] = []
    for pattern, times in zip(patterns, np.floor(used + 1e-6).astype(np.int64), strict=True):
        held = pattern > 0
        times = int(min(times, (left[held] // pattern[held]).min()))
        if times > 0:
            left -= times * pattern
            chosen.append(({int(w): int(c) for w, c in zip(widths[held], pattern[held], strict=True)}, times))
    rest = [int(w) for w, n in zip(widths, left, strict=True) for _ in range(int(n))]
    return chosen + [(counts, 1) for counts in _best_fit(rest, capacity)]


def _places(chosen: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per class, by ascending rank: where each pattern's share begins, its first sequence, items a sequence."""
    lists: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for counts, times in chosen:
        for width, count in counts.items():
            lists.setdefault(width, []).append((taken.get(width, 0), first, count))
            taken[width] = taken.get(width, 0) + count * times
        first += times
    return {width: tuple(np.array(column, dtype=np.int64) for column in zip(*rows, strict=True)) for width, rows in lists.items()}


# --- assignment ------------------------------------------------------------------------


def pack(cut: DataFrame, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """``cut`` (any columns, a ``length`` of 1 to ``length``) with ``sequence_id`` and ``offset``.

    Every row is in one sequence, offsets are gapless from 0, no sequence is longer than
    ``length``.  Rows of equal length are told apart by where they are stored, so repeated rows
    and null ids each get a place of their own.  No rows: no sequences.
    """
    capacity = length // unit
    kept = [c for c in cut.columns]
    rows = stage(
        cut.withColumn("__class", F.ceil(F.col("length") / unit).cast("int"))
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__row", F.monotonically_increasing_id()),
        "packing",
    )
    shares = stage(rows.groupBy("__class", "__part").agg(F.count("*").alias("__n")), "packing-shares")
    histogram = {r[0]: r[1] for r in shares.groupBy("__class").agg(F.sum("__n")).collect()}
    places = _places(plan(histogram, capacity))

    before = Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("__class", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = Window.partitionBy("__class", "__part").orderBy("__row")
    ranked = rows.withColumn("__rank", F.row_number().over(local) - 1).join(shares, ["__class", "__part"])
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.col("__before"))

    def placed(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence = np.zeros(len(classes), dtype=np.int64)
        slot = np.zeros(len(classes), dtype=np.int64)
        of, rank = classes.to_numpy(), ranks.to_numpy()
        for width in np.unique(of):
            here = of == width
            begins, first, count = places[int(width)]
            i = np.searchsorted(begins, rank[here], side="right") - 1
            sequence[here] = first[i] + (rank[here] - begins[i]) // count[i]
            slot[here] = (rank[here] - begins[i]) % count[i]
        return pd.DataFrame({"sequence_id": sequence, "slot": slot})

    assign = F.pandas_udf(placed, "sequence_id long, slot long")
    assigned = ranked.withColumn("__at", assign("__class", "__rank"))
    inside = Window.partitionBy("__at.sequence_id").orderBy(F.desc("__class"), "__at.slot").rowsBetween(Window.unboundedPreceding, -1)
    return assigned.select(
        *kept,
        F.col("__at.sequence_id").alias("sequence_id"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )


def digest(cut: DataFrame) -> DataFrame:
    """``cut`` with ``ids_crc32`` in the place of ``ids``."""
    return cut.select(*[F.crc32("ids").alias("ids_crc32") if c == "ids" else c for c in cut.columns])


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``ids`` (bytes), ``n_tokens``: the packed rows joined by offset and padded.

    ``packed`` has ``ids``.  A sequence whose length is a power of two is not padded.
    """
    parts = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens")
    )
    joined = parts.withColumn("ids", F.expr("aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids))"))
    even = F.bit_count("n_tokens") == 1
    padding = F.repeat(F.lit(struct.pack("<I", pad_id).hex()), F.when(even, 0).otherwise(length - F.col("n_tokens")).cast("int"))
    return joined.select("sequence_id", F.concat("ids", F.unhex(padding)).alias("ids"), "n_tokens")
