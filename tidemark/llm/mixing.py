"""Mixing sources to target weights by systematic sampling.

Each document of a source expects ``target / source size`` copies. Within a
source the documents stand in order of size; the expected copies are summed
along that order, one random offset is added, and a document is emitted once
for each integer that its stretch of the running sum crosses. As the order is
by size, every stretch of sizes is sampled evenly and the words taken come near
the target whatever the sizes are.

The running sum needs a document's place in its source. Rows are range
partitioned by (source, size, ties), so a hot source lies across many
partitions: places are counted within a partition, and the counts of earlier
partitions are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, prepare, stored, with_row_id

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """One row per source of ``sizes`` (``source``, ``size``): ``source_size``, ``weight``, ``target``.

    Sources in code point order, null last, take the ``weights`` in turn. A
    target is weight times a common level, or ``most`` times the source's size
    where that is less; the level is the one at which the targets add up to
    ``share`` times all sizes. Sorted by the level at which a source is full,
    the full ones come first, so one running sum finds them.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(most)).withColumn("full", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("full", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, 0)
    per = (
        per.withColumn("all", F.sum("source_size").over(everything) * float(share))
        .withColumn("later", F.sum("weight").over(everything) - F.sum("weight").over(upto))
        .withColumn("is_full", F.sum("cap").over(upto) + F.col("full") * F.col("later") <= F.col("all"))
        .withColumn("spent", F.coalesce(F.sum(F.when(F.col("is_full"), F.col("cap"))).over(everything), F.lit(0.0)))
        .withColumn("open", F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(everything))
    )
    level = F.col("weight") * (F.col("all") - F.col("spent")) / F.col("open")
    target = F.when(F.col("is_full"), F.col("cap")).otherwise(F.least(level, F.col("cap")))
    return per.select("source", "source_size", "weight", target.alias("target"))


def offset(seed: int, source: Column) -> Column:
    """The random offset of a source, in [0, 1): from a digest of its name and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("<null>"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def taken_copies(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 0
) -> DataFrame:
    """``rows`` (``source``, ``size``, ``tie``, more) plus ``source_size``, ``target``, ``copies``."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(tasks, F.asc_nulls_last("source"), "size", "tie")
    placed = stored(placed.withColumn("part", F.spark_partition_id()), "placed")
    targets = stored(source_targets(placed, weights, share, most), "targets")
    counts = placed.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    counts = counts.join(targets, counts.source.eqNullSafe(targets.source)).select(
        counts.source.alias("s"), F.col("part").alias("p"), "before", "source_size", "target", offset(seed, counts.source).alias("u")
    )
    place = F.row_number().over(Window.partitionBy("source", "part").orderBy("size", "tie"))
    placed = placed.withColumn("place", place)
    joined = placed.join(counts, placed.source.eqNullSafe(counts.s) & (placed.part == counts.p))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.col("before") + F.col("place")
    copies = F.floor(upto * rate + F.col("u")) - F.floor((upto - 1) * rate + F.col("u"))
    return joined.withColumn("copies", copies.cast("long")).select(*rows.columns, "source_size", "target", "copies")


def _tie() -> Column:
    """Order among documents of one source and size: by digest of the id, then of the text."""
    return F.concat(*[F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) for c in ("doc_id", "text")])


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """``docs``, each row as often as the mix takes it (0 to ``most`` times), columns unchanged.

    Sizes are words; a null text has none. A null source is a source of its
    own, after all others. Rows of size 0 are sampled like others. Repeated
    rows count each for itself; equal rows may be taken a different number of
    times. A table without words gives no rows.
    """
    prepare(docs.sparkSession)
    rid, times = fresh(docs.columns), fresh(docs.columns)
    whole = with_row_id(docs, "docs", rid)
    rows = whole.select(F.col(rid).alias("rid"), "source", word_count().alias("size"), _tie().alias("tie"))
    kept = taken_copies(rows, weights, share, most, seed).filter("copies > 0")
    kept = kept.select(F.col("rid").alias(rid), F.sequence(F.lit(1), F.col("copies").cast("int")).alias(times))
    return whole.join(kept, rid).withColumn(times, F.explode(times)).drop(rid, times)


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``source``, ``copies``."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "source", word_count().alias("size"), _tie().alias("tie"))
    planned = taken_copies(rows, weights, share, most, seed)
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )
