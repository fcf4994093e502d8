"""Exact top-k by inner product with a pivot table.

Every vector has its distances to a fixed set of pivots.  For a query q and a candidate c the
triangle inequality gives |d(q, p) - d(c, p)| <= d(q, c) for each pivot p; the largest of these
lower bounds L turns into an upper bound of the score, since 2 q.c = |q|^2 + |c|^2 - d(q, c)^2.
Candidates are evaluated in the order of their bounds until the next bound lies below the k-th
score: everything after it is eliminated without being evaluated, and the result is exact.

Candidates are packed into blocks by the tasks that read them, ordered by their nearest pivot
and the distance to it.  A run of ``GROUP`` neighbours shares one bound, from the least and the
largest distance to each pivot: in 64 dimensions one score costs less than a bound of 64
pivots.  Scores of a group are one matrix product, in floating point only where every sum is a
whole number that the type holds; vectors too long for that lie in blocks of their own and are
bounded and evaluated one by one.

Query blocks meet candidate blocks as stored tables, slice by slice (a Cartesian product of
partitions): neither side is broadcast, copied or shuffled, and a task holds one slice of queries,
one candidate block and the best ``k`` so far.  A bounded sample of candidates (``sample`` rows,
those with the smallest hashes of their ids) supplies the pivots, by farthest-first choice, and a
first k-th score for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import bounded_batches, stage, stage_counted

PIVOTS = 64
SAMPLE = 2048
#: Rows of a block and of a group, fewer of wide vectors.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 2048
GROUP = 256
#: Blocks of candidates, which pass one after another, and of queries, which are held, of a task.
CANDIDATE_SLICE = 32
QUERY_SLICE = 16
_AT_ONCE = 128
_GROUPS_AT_ONCE = 4
_QUERIES_AT_ONCE = 1024
_MOST = np.iinfo(np.int64)
#: Squared lengths under which all products of two vectors, and their sums, are whole numbers of 24 or 53 bits.
_SHORT, _LONGER = 2.0**24, 2.0**51


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``vec``: floor(scale * x) of each component, as longs (the largest long beyond that).

    Rows take no part when the key or the vector is null, or a component is null or not finite.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec"),
    )


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of one width; what a shorter vector lacks counts as zero."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def _rows(vectors: pa.ListArray, width: int) -> np.ndarray:
    """:func:`_matrix` of an Arrow column."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(vectors), width).astype(np.int64)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    out[np.repeat(np.arange(len(vectors)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _squares(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.float64) ** 2).sum(axis=1)


def _kinds(squares: np.ndarray) -> np.ndarray:
    """0, 1: products of two such vectors are exact as floats of 32 or of 64 bits; 2: they may not be."""
    return (squares >= _SHORT).astype(np.int8) + (squares >= _LONGER)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    points, pivots = points.astype(np.float64), pivots.astype(np.float64)
    squares, pivot_squares = (points**2).sum(axis=1), (pivots**2).sum(axis=1)
    if squares.max(initial=0.0) < _LONGER and pivot_squares.max(initial=0.0) < _LONGER:  # whole numbers, so nothing cancels
        return np.sqrt(squares[:, None] + pivot_squares - 2 * (points @ pivots.T))
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct points: each as far as possible from those before it."""
    if not len(points):
        return points
    chosen = [0]
    gap = _distances(points, points[:1])[:, 0]
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _sizes(width: int) -> tuple[int, int]:
    """Rows of a candidate block and of a query block."""
    each = 8 * max(width, 1)
    return max(GROUP, min(CANDIDATE_BLOCK, (32 << 20) // each)), max(1, min(QUERY_BLOCK, (8 << 20) // each))


def _narrow(points: np.ndarray) -> bytes:
    low, high = points.min(initial=0), points.max(initial=0)
    fits = (t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return points.astype(next(fits)).tobytes()


def _wide(points: bytes, count: int, width: int) -> np.ndarray:
    return np.frombuffer(points, dtype=f"<i{len(points) // (count * width)}" if width else "<i8").reshape(count, width)


def _bunches(batches: Iterator[pa.RecordBatch], size: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``size`` rows at a time, the last time fewer: ids and points."""
    ids, points, rows = [], [], 0
    for batch in batches:
        at = 0
        while at < len(batch):
            part = batch.slice(at, size - rows)
            ids.append(part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64))
            points.append(_rows(part.column("vec"), width))
            at, rows = at + len(part), rows + len(part)
            if rows == size:
                yield np.concatenate(ids), np.concatenate(points)
                ids, points, rows = [], [], 0
    if rows:
        yield np.concatenate(ids), np.concatenate(points)


def _cut(kinds: np.ndarray, order: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places in ``order``, cut into blocks of one kind."""
    for kind in np.unique(kinds):
        rows = order[kinds[order] == kind]
        for at in range(0, len(rows), size):
            yield int(kind), rows[at : at + size]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


_BLOCK = "block long, kind int, ids binary, points binary, low binary, high binary"
_ASKED = "q_block long, q_kind int, q_ids binary, q_points binary, q_floors binary"


def _packed(size: int, width: int, pivots: np.ndarray):
    """Packs (vec_id, vec) rows into blocks, with the least and largest distances of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, points in _bunches(batches, min(4 * size, max(size, (16 << 20) // (8 * max(width, 1)))), width):
            table = _distances(points, pivots)
            nearest = table.argmin(axis=1)  # there is a pivot where there are candidates
            order = np.lexsort((table[np.arange(len(ids)), nearest], nearest))
            for kind, rows in _cut(_kinds(_squares(points)), order, size):
                starts, own = np.arange(0, len(rows), GROUP), table[rows]
                yield _batch(
                    block=pa.array([number], pa.int64()),
                    kind=pa.array([kind], pa.int32()),
                    ids=[ids[rows].astype("<i8").tobytes()],
                    points=[_narrow(points[rows])],
                    low=[np.minimum.reduceat(own, starts).astype("<f4").tobytes()],
                    high=[np.maximum.reduceat(own, starts).astype("<f4").tobytes()],
                )
                number += 1

    return run


def _asked(size: int, width: int, seed_ids: np.ndarray, seeds: np.ndarray, k: int):
    """Packs queries into blocks with their k-th best scores among the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, points in _bunches(batches, size, width):
            for kind, rows in _cut(_kinds(_squares(points)), np.arange(len(ids)), size):
                yield _batch(
                    q_block=pa.array([number], pa.int64()),
                    q_kind=pa.array([kind], pa.int32()),
                    q_ids=[ids[rows].astype("<i8").tobytes()],
                    q_points=[_narrow(points[rows])],
                    q_floors=[_floors(ids[rows], points[rows], kind, seed_ids, seeds, k).astype("<i8").tobytes()],
                )
                number += 1

    return run


def _floors(ids: np.ndarray, points: np.ndarray, kind: int, seed_ids: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that ``k`` of its candidates reach: the k-th among the seeds."""
    out = np.full(len(ids), _MOST.min, dtype=np.int64)
    if kind == 2:
        for at, (query_id, query) in enumerate(zip(ids, points, strict=True)):
            scores = np.sort(_scores(seeds[seed_ids != query_id], query))[::-1]
            out[at] = scores[k - 1] if len(scores) >= k else _MOST.min
        return out
    kinds = _kinds(_squares(seeds))
    seed_ids, seeds, kind = seed_ids[kinds < 2], seeds[kinds < 2], max(kind, kinds[kinds < 2].max(initial=0))
    if len(seeds) >= k:
        scores = _floats(points, kind) @ _floats(seeds, kind).T
        scores[ids[:, None] == seed_ids] = -np.inf
        kth = np.partition(scores, len(seeds) - k, axis=1)[:, len(seeds) - k].astype(np.float64)
        out[kth > -np.inf] = kth[kth > -np.inf].astype(np.int64)
    return out


def _floats(points: np.ndarray, kind: int) -> np.ndarray:
    return points.astype(np.float64 if kind else np.float32)


def _scores(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond the range of a long, the nearest long."""
    if not len(points) or not points.shape[1]:
        return np.zeros(len(points), dtype=np.int64)
    high = float(np.abs(points.astype(np.float64)).max()) * float(np.abs(query.astype(np.float64)).max()) * len(query)
    if high < 2.0**62:
        return points @ query
    exact = (points.astype(object) * query.astype(object)).sum(axis=1)
    return np.array([min(max(int(s), _MOST.min), _MOST.max) for s in exact], dtype=np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~scores))[:k]  # ~s falls as s rises, over all longs
    return ids[order], scores[order]


def _search(query_id: int, query: np.ndarray, q_table: np.ndarray, block: dict, floor: float, k: int):
    """The query's best ``k`` of one block, and how many candidates were evaluated: each has a bound of its own."""
    ids, points, table, squares = block["ids"], block["points"], block["table"], block["squares"]
    own = ids == query_id
    lower = np.abs(table - q_table).max(axis=1) if table.shape[1] else np.zeros(len(ids))
    far = table.max(axis=1, initial=0.0) + q_table.max(initial=0.0)
    lower = np.maximum(lower - 1e-12 * far, 0.0)
    total = squares + float((query.astype(np.float64) ** 2).sum())
    upper = np.maximum((total - lower**2) / 2 + 1e-9 * total + 1.0, float(_MOST.min))
    upper[own] = -np.inf
    order = np.argsort(-upper, kind="stable")
    kept_ids, kept = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    least, done = floor, 0
    while done < len(order) and upper[order[done]] >= least and upper[order[done]] > -np.inf:
        rows = order[done : done + _AT_ONCE]
        rows = rows[(upper[rows] >= least) & ~own[rows]]
        done += _AT_ONCE
        scores = _scores(points[rows], query)
        kept_ids, kept = _best(np.concatenate([kept_ids, ids[rows]]), np.concatenate([kept, scores]), k)
        if len(kept) == k:
            least = max(least, float(kept[-1]) - abs(float(kept[-1])) * 1e-12)
    return kept_ids, kept, min(done, len(order))


class _Block:
    """A candidate block."""

    def __init__(self, row: dict, width: int):
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        self.kind, count = row["kind"], len(self.ids)
        self.points = _wide(row["points"], count, width)
        self.squares = _squares(self.points)
        self.starts = np.arange(0, count, GROUP)
        self.low, self.high = (np.frombuffer(row[x], dtype="<f4").reshape(len(self.starts), -1) for x in ("low", "high"))
        self.most = np.maximum.reduceat(self.squares, self.starts)
        self._floats, self._table = {}, None

    def floats(self, kind: int) -> np.ndarray:
        if kind not in self._floats:
            self._floats[kind] = _floats(self.points, kind)
        return self._floats[kind]

    def rows(self, groups: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(self.starts[g], min(self.starts[g] + GROUP, len(self.ids))) for g in np.sort(groups)])

    def alone(self, pivots: np.ndarray) -> dict:
        """What :func:`_search` needs."""
        if self._table is None:
            self._table = _distances(self.points, pivots)
        return {"ids": self.ids, "points": self.points.astype(np.int64), "table": self._table, "squares": self.squares}


class _Best:
    """A query block with its pivot table, and the best ``k`` of each of its queries so far."""

    def __init__(self, row: dict, width: int, k: int, pivots: np.ndarray):
        self.ids = np.frombuffer(row["q_ids"], dtype="<i8").copy()
        count = len(self.ids)
        self.kind, self.k, self.count = row["q_kind"], k, count
        self.points = _wide(row["q_points"], count, width).astype(np.int64 if row["q_kind"] == 2 else np.float64 if row["q_kind"] else np.float32)
        self.squares = _squares(self.points)
        self.pivots = pivots
        self.columns = np.ascontiguousarray(_distances(self.points, pivots).T, dtype=np.float32)
        self.least = np.frombuffer(row["q_floors"], dtype="<i8").copy()  # what a score must reach
        self.last = np.full(count, _MOST.max)  # up to this id a score that just reaches it counts
        self.have = np.zeros(count, dtype=np.int64)
        self.best, self.best_ids = np.zeros((count, k), dtype=np.int64), np.zeros((count, k), dtype=np.int64)
        self.new, self.waiting, self.evaluated = [], 0, 0

    def offer(self, block: _Block) -> None:
        """Evaluates the groups of a block in the order of their bounds, until no query has a bound that its k-th score leaves."""
        if max(self.kind, block.kind) == 2:
            return self._offer_alone(block)
        upper = self._bounds(block)
        order = np.argsort(-upper.max(axis=0), kind="stable")
        for at in range(0, len(order), _GROUPS_AT_ONCE):
            least = self._least()
            if not (upper[:, order[at:]] >= least[:, None]).any():
                break
            groups = order[at : at + _GROUPS_AT_ONCE]
            asks = np.flatnonzero((upper[:, groups] >= least[:, None]).any(axis=1))
            rows = block.rows(groups) if len(asks) else ()
            for some in range(0, len(asks), _QUERIES_AT_ONCE):
                self._evaluate(block, asks[some : some + _QUERIES_AT_ONCE], rows)

    def _least(self) -> np.ndarray:
        least = self.least.astype(np.float64)
        return least - np.abs(least) * 1e-12

    def _bounds(self, block: _Block) -> np.ndarray:
        """An upper bound of the scores of each query with each group."""
        gap = np.zeros((len(block.starts), self.count), dtype=np.float32)
        one = np.empty_like(gap)
        for mine, low, high in zip(self.columns, block.low.T, block.high.T, strict=True):
            np.maximum(gap, np.subtract(low[:, None], mine, out=one), out=gap)
            np.maximum(gap, np.subtract(mine, high[:, None], out=one), out=gap)
        far = self.columns.max(axis=0, initial=0.0) + block.high.max(axis=1, initial=0.0)[:, None]
        lower = np.maximum(gap - 1e-6 * far, 0.0).astype(np.float64)
        total = self.squares + block.most[:, None]
        return np.maximum((total - lower**2) / 2 + 1e-9 * total + 1.0, float(_MOST.min)).T

    def _evaluate(self, block: _Block, asks: np.ndarray, rows: np.ndarray) -> None:
        kind = max(self.kind, block.kind)
        mine = _floats(self.points if len(asks) == self.count else self.points[asks], kind)
        scores = mine @ block.floats(kind)[rows].T
        self.evaluated += scores.size
        least = self.least[asks].astype(scores.dtype)
        some = np.flatnonzero(scores.max(axis=1) >= least)  # few queries once their best are good
        scores = scores[some]
        ask, row = np.divmod(np.flatnonzero(scores >= least[some, None]), len(rows))
        self._add(asks[some[ask]], block.ids[rows[row]], scores[ask, row].astype(np.int64))

    def _offer_alone(self, block: _Block) -> None:
        alone, least = block.alone(self.pivots), self._least()
        points, table = self.points.astype(np.int64), _distances(self.points, self.pivots)
        for at in range(self.count):
            ids, scores, evaluated = _search(int(self.ids[at]), points[at], table[at], alone, least[at], self.k)
            self.evaluated += evaluated
            self._add(np.full(len(ids), at), ids, scores)

    def _add(self, asks: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        least = self.least[asks]
        good = ((scores > least) | (scores == least) & (ids <= self.last[asks])) & (ids != self.ids[asks])
        self.new.append((asks[good], ids[good], scores[good]))
        self.waiting += int(good.sum())
        if self.waiting > 2 * self.k * self.count:
            self.merge()

    def merge(self) -> None:
        """Puts what was found among the best ``k``."""
        if not self.waiting:
            return
        asks, ids, scores = (np.concatenate(x) for x in zip(*self.new, strict=True))
        old_ask, old = np.nonzero(np.arange(self.k) < self.have[:, None])
        asks, ids, scores = np.concatenate([old_ask, asks]), np.concatenate([self.best_ids[old_ask, old], ids]), np.concatenate([self.best[old_ask, old], scores])
        order = np.lexsort((ids, ~scores, asks))  # ~s falls as s rises, over all longs
        asks, ids, scores = asks[order], ids[order], scores[order]
        counts = np.bincount(asks, minlength=self.count)
        rank = np.arange(len(asks)) - np.repeat(np.cumsum(counts) - counts, counts)
        top = rank < self.k
        self.best[asks[top], rank[top]], self.best_ids[asks[top], rank[top]] = scores[top], ids[top]
        self.have = np.minimum(counts, self.k)
        full = self.have == self.k
        self.least[full], self.last[full] = self.best[full, -1], np.maximum(self.best_ids[full, -1], _MOST.min + 1) - 1
        self.new, self.waiting = [], 0

    def rows(self) -> pa.RecordBatch:
        self.merge()
        asks, at = np.nonzero(np.arange(self.k) < self.have[:, None])
        return _batch(query_id=self.ids[asks], vec_id=self.best_ids[asks, at], score=self.best[asks, at])


def _evaluated(k: int, width: int, pivots: np.ndarray):
    """The best ``k`` of each query among a task's candidate blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Best] = {}
        number, block = None, None
        for batch in batches:
            for at in range(len(batch)):
                cell = lambda name, batch=batch, at=at: batch.column(name)[at].as_py()
                if cell("block") != number:
                    number, block = cell("block"), _Block({x: cell(x) for x in ("kind", "ids", "points", "low", "high")}, width)
                if (q := cell("q_block")) not in found:
                    found[q] = _Best({x: cell(x) for x in ("q_kind", "q_ids", "q_points", "q_floors")}, width, k, pivots)
                found[q].offer(block)
        while found:
            yield found.popitem()[1].rows()

    return run


def _sample(candidates: DataFrame, rows: int, sample: int) -> DataFrame:
    """Up to ``sample`` of the ``rows`` candidates, those with the smallest hashes of their ids.

    Hashes beyond a limit are left out where they are read, so that the tasks don't each send
    ``sample`` rows; where an id has many rows, fewer ids than expected may lie below the limit, which is then raised.
    """
    hashed = F.xxhash64("vec_id")
    share = (1.25 * sample + 64) / max(rows, 1)
    while True:
        some = candidates if share >= 1 else candidates.where(hashed <= int(_MOST.min + share * 2.0**64))
        found, counts = stage_counted(some.orderBy(hashed, "vec_id").limit(sample), "topk-sample", F.lit(True), n=F.count(F.lit(1)))
        if share >= 1 or counts["n"] >= sample:
            return found
        share *= 16


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 10, pivots: int = PIVOTS, sample: int = SAMPLE
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best candidates of each query.

    Both inputs have ``vec_id`` and ``vec`` (longs).  Ties go to the smaller vec_id.  A query's
    candidates are the rows under other ids; rows that repeat an id or a vector are candidates
    each.  An id that asks twice asks with its smallest vector.  Of two vectors of different
    length the shorter counts as filled up with zeros.  No queries or no candidates: no rows.
    """
    spark = bounded_batches(candidates.sparkSession)
    widest, rows = F.coalesce(F.max(F.size("vec")), F.lit(0)), F.count(F.lit(1))
    queries, asking = stage_counted(queries.groupBy("vec_id").agg(F.min("vec").alias("vec")), "topk-queries", F.lit(True), n=rows, width=widest)
    offered = candidates.agg(widest.alias("width"), rows.alias("n")).first()
    width = max(asking["width"], offered["width"])
    seeds = _sample(candidates, offered["n"], sample).toPandas()
    seed_ids, points = seeds["vec_id"].to_numpy(dtype=np.int64), _matrix(seeds["vec"], width)
    chosen = farthest_first(points, pivots)

    block, asked_block = _sizes(width)
    blocks, offered = stage_counted(candidates.select("vec_id", "vec").mapInArrow(_packed(block, width, chosen), _BLOCK), "topk-blocks", F.lit(True), n=rows)
    slices = -(-asking["n"] // (QUERY_SLICE * asked_block)) or 1
    asked = stage(
        queries.coalesce(slices).mapInArrow(_asked(asked_block, width, seed_ids, points, k), _ASKED), "topk-asked"
    )
    tasks = -(-2 * spark.sparkContext.defaultParallelism // slices)
    shares = max(-(-offered["n"] // CANDIDATE_SLICE), min(offered["n"], tasks), 1)
    met = blocks.coalesce(shares).hint("shuffle_replicate_nl").crossJoin(asked.coalesce(slices))
    found = met.mapInArrow(_evaluated(k, width, chosen), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
