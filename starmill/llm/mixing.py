"""Mixing sources to target weights by systematic sampling, in DataFrame functions alone.

Sources share the words of all documents by their weights; a target stops at ``MOST`` times what its
source holds, and the excess goes to the others by weight until none is above.  Each document of a
source expects target / source_size copies.  Within a source the documents stand in the order of
their sizes, their expected copies are summed up from the front, one random offset is added, and a
document is emitted once for each whole number its share of the sum crosses.  In the order of sizes
every stretch of the sum takes documents of nearly one size, so the words taken stay within about
one document of the target.

Expected copies count in units of ``1 / ONE``, so prefix sums are whole numbers: reruns agree, on
any number of partitions.  Only the remainder of a sum by ``ONE`` decides what a document crosses.

Documents are dealt out by ranges of (source, size, doc_id, place), so a source that holds a third of
them, or a doc_id repeated as often, lies on many partitions; each is numbered on its own, and what
the partitions before it hold is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import stage

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 1
ONE = 1 << 30
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words of the whole text, null: 0) and the ``keep`` columns."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), *[F.col(c).alias(f"__keep_{c}") for c in keep])


def _dealt(rows: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """``rows`` dealt out by ranges, stored with the number of their range (``__part``)."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return stage(rows.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), label)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``weight``, ``target`` from one row per ``source`` with ``source_size``.

    Weights repeat over the sources by code point, null last.  The targets of a table without a
    word are 0.
    """
    rows = _dealt(sizes, [F.col("source").isNull(), "source"], "mix-sources")
    held = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    held = held.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = Window.partitionBy("__part").orderBy(F.col("source").isNull(), "source")
    rank = F.row_number().over(local) - 1 + F.col("__before")
    ranked = rows.join(held, "__part").withColumn("__rank", rank)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")

    limit = F.col("source_size") * most
    level, full = 0.0, -1
    while True:  # each round, sources above their limit give the excess away
        above = limit < F.lit(level) * F.col("weight")
        total, spent, open_weight, now = ranked.agg(
            F.sum("source_size"), F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.count_if(above)
        ).first()
        if now == full or not open_weight:
            break
        full, level = now, (total - spent) / open_weight
    return ranked.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and the ``keep`` columns.

    One row for every row of ``docs``, ``copies`` of it in the mix; ``taken`` is their words.  A
    null text has no words, null sources are one source, null doc_ids stay null and stand first.
    Rows equal in doc_id, source and size share what their stretch takes, in any order.  A source
    without a word takes nothing.  An empty table gives no rows.
    """
    rows = stage(sized(docs, keep).withColumn("__place", F.monotonically_increasing_id()), "mix-sizes")
    rows = _dealt(rows, [F.col("source").isNull(), "source", "size", "doc_id", "__place"], "mix-ranges")

    # One row for each range and source: what lies in it, what it expects, what stands before it.
    shares = stage(rows.groupBy("__part", "source").agg(F.count("*").alias("__n"), F.sum("size").alias("__size")), "mix-shares")
    sources = targets(shares.groupBy("source").agg(F.sum("__size").alias("source_size")), weights, most)
    each = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE + 0.5)).otherwise(0)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 256)
    offset = F.conv(F.substring(draw, 1, 8), 16, 10).cast("long") % ONE
    sources = sources.select("source", "source_size", "target", each.cast("long").alias("__each"), offset.alias("__offset"))
    before = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("__part", "source", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    shares = shares.alias("a").join(sources.alias("b"), F.expr("a.source <=> b.source")).select("__part", "a.source", "__before", *[f"b.{c}" for c in sources.columns[1:]])

    local = Window.partitionBy("__part", "source").orderBy("size", "doc_id", "__place")
    ranked = rows.withColumn("__rank", F.row_number().over(local) - 1).alias("r")
    ranked = ranked.join(shares.alias("s"), F.expr("r.__part = s.__part AND r.source <=> s.source"))
    rank, one = F.col("__rank") + F.col("__before"), F.lit(ONE)
    # The documents of a source expect the same, so the sum before one is its rank times that.
    summed = (rank % one) * (F.col("__each") % one) % one + F.col("__offset")
    crossed = F.floor((summed + F.col("__each")) / one) - F.floor(summed / one)
    result = ranked.select(
        "r.doc_id", "r.source", "r.size", "source_size", "target", crossed.cast("long").alias("copies"), *[F.col(f"r.__keep_{c}").alias(c) for c in keep]
    )
    return result.withColumn("taken", F.col("copies") * F.col("size"))


def emitted(mixed: DataFrame) -> DataFrame:
    """The documents of the mix: each row of ``mixed`` once for each copy, numbered from 1 (``copy``)."""
    copies = F.transform(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)).cast("int")), lambda i: i.cast("long"))
    return mixed.where("copies > 0").withColumn("copy", F.explode(copies))
