"""Mixing sources to target weights along a time-varying curriculum; DataFrame functions only.

Each source has a weight schedule, piecewise linear over training time 0..1. Its integral, scaled to the words the
source may give, is the cumulative demand; a document's place in the source's own seeded order is a word offset, and
inverting the demand at that offset gives its training position. Documents are then range-sorted by position.

A source that must give more than it has is passed over again, up to `cap` times. Offsets come from a two-level
prefix sum: words per (source, slice of the hash order) first, then within slices, so that no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored, table, word_count

#: (time, weight) knots of each weight class: the first fades, the second stays, the third grows.
CURRICULUM = {1: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}
SLICE_ROWS, LEAST_SLICES, CELL_SLICES = 4096, 256, 64


def _inverse(knots: tuple, part: Column) -> Column:
    """Time at which `part` (0..1) of the schedule's integral is reached."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, at, out = sum(areas), 0.0, None
    for (t0, v0), (t1, v1), area in zip(knots, knots[1:], areas):
        rest = part * F.lit(total) - F.lit(at)
        curve = (v1 - v0) / (t1 - t0)
        under = F.sqrt(F.greatest(F.lit(0.0), F.lit(v0 * v0) + F.lit(2 * curve) * rest))
        x = F.lit(t0) + F.coalesce(F.lit(2.0) * rest / F.nullif(F.lit(v0) + under, F.lit(0.0)), F.lit(0.0))
        out = F.when(rest <= F.lit(area), x) if out is None else out.when(rest <= F.lit(area), x)
        at += area
    return F.least(F.lit(1.0), out.otherwise(F.lit(1.0)))


def targets(sizes: DataFrame, cap: int = 3, classes: int = 3) -> DataFrame:
    """(key, source_size) of each source to weight, target: weights 1..classes by key order share all words; a target
    stops at cap times its source's size and what is over goes to the others by weight, until none is above.

    The level of that filling is the greatest of the levels after stopping the k sources with the least room a weight.
    The two global windows run over one row a source, not over documents."""
    ranked = sizes.withColumn("weight", (F.row_number().over(W.orderBy("key")) - 1) % classes + 1)
    order = W.orderBy(F.col("source_size") * F.lit(float(cap)) / F.col("weight"), "key")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest)
    levels = ranked.withColumn("level", level)
    top = F.max("level").over(W.partitionBy())
    return levels.withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), top * F.col("weight"))).drop("level")


def mix(docs: DataFrame, cap: int = 3, classes: int = 3, curriculum: dict = CURRICULUM, keep: list[str] | None = None) -> DataFrame:
    """Columns of docs (or only those of `keep`, the rest is not shuffled) plus `mix`: size, source_size, target, taken, weight and passes (pass, words, position).

    A pass is one use of the document; passes that take no word have a null position. Documents are ordered within
    their source by the MD5 of doc_id and text; the words at the end of the last pass may be part of a document. Null
    texts have size 0, a null source is a source of its own, a null doc_id hashes as an empty string. Equal rows are taken
    one after the other. An input column named mix is replaced. Very long texts count whole. Empty in, empty out.

    Where the text is not kept, words are counted once and only narrow rows are written and shuffled."""
    text = F.col("text").cast("string")
    kept = [c for c in (docs.columns if keep is None else keep) if c != "mix"]
    own = F.struct(
        F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1")).alias("key"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))).alias("h"),
        word_count(text).alias("size"),
    )
    # input columns travel in one struct, so that their names cannot clash
    keyed = docs.select(F.struct(*kept).alias("_row"), own.alias("mix"))
    if "text" not in kept:
        keyed = stored(keyed, "sizes")
    slices = max(LEAST_SLICES, (docs if "text" in kept else keyed).count() // SLICE_ROWS)
    head = F.conv(F.substring(F.col("mix.h"), 1, 8), 16, 10).cast("long")
    sliced = keyed.withColumn("_slice", F.floor(head * F.lit(slices) / F.lit(2**32)).cast("long")).withColumn("_key", F.col("mix.key"))
    # a handful of rows a slice: a file for each partition of the shuffle would cost more than the rows
    cells = stored(sliced.groupBy("_key", "_slice").agg(F.sum("mix.size").alias("words")).coalesce(max(1, slices // CELL_SLICES)), "cells")
    goals = targets(cells.groupBy(F.col("_key").alias("key")).agg(F.sum("words").alias("source_size")), cap, classes)
    earlier = W.partitionBy("_key").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(goals, F.col("_key") == F.col("key")).drop("key", "words")
    within = W.partitionBy("_key", "_slice").orderBy("mix.h", "mix.size").rowsBetween(W.unboundedPreceding, -1)
    placed = sliced.join(cells, ["_key", "_slice"]).withColumn("offset", F.col("offset") + F.coalesce(F.sum("mix.size").over(within), F.lit(0)))
    demand = F.floor(F.col("target") + 0.5)
    start = lambda p: F.col("offset") + F.col("source_size") * p

    def position(p: Column) -> Column:
        part, out = start(p).cast("double") / F.nullif(demand, F.lit(0)).cast("double"), None
        for c, knots in sorted(curriculum.items()):
            out = F.when(F.col("weight") == c, _inverse(knots, part)) if out is None else out.when(F.col("weight") == c, _inverse(knots, part))
        return out

    words = lambda p: F.least(F.greatest(demand - start(p), F.lit(0)), F.col("mix.size")).cast("long")
    passes = F.array(*[F.struct(F.lit(p + 1).alias("pass"), words(F.lit(p)).alias("words"), F.when(start(F.lit(p)) < demand, position(F.lit(p))).alias("position")) for p in range(cap)])
    taken = sum((words(F.lit(p)) for p in range(1, cap)), words(F.lit(0)))
    done = F.struct(F.col("mix.size").alias("size"), "source_size", "target", taken.alias("taken"), F.col("weight").cast("int").alias("weight"), F.col("mix.h").alias("order_key"), passes.alias("passes"))
    return placed.select(*[F.col("_row")[c].alias(c) for c in kept], done.alias("mix"))


def by_first_position(mixed: DataFrame) -> DataFrame:
    """Range-sort documents by the position of their first pass; those that are not taken come last."""
    return mixed.orderBy(F.col("mix.passes")[0]["position"].asc_nulls_last(), F.col("mix.order_key"))


def schedule(mixed: DataFrame) -> DataFrame:
    """One row for each pass that takes words, range-sorted by training position (column mix_pass)."""
    rows = mixed.withColumn("mix_pass", F.explode(F.filter("mix.passes", lambda p: p["words"] > 0)))
    return rows.orderBy("mix_pass.position", "mix.order_key")


def op2_mixing_sources(spark, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each, range-sorted by first position."""
    mixed = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return by_first_position(mixed).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", F.round(F.col("mix.passes")[0]["position"], 9).alias("position")
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS k, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY k),
r AS (SELECT *, CAST((row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS BIGINT) AS w FROM s),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3.0::DOUBLE / w, k
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
           / CAST(sum(w) OVER (ORDER BY source_size * 3.0::DOUBLE / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM r),
t AS (SELECT k, source_size, w, least(source_size * 3.0::DOUBLE, max(level) OVER () * w) AS target FROM l),
o AS (
  SELECT d.doc_id, d.size, t.*, CAST(floor(t.target + 0.5) AS BIGINT) AS need,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.k ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t USING (k)),
p AS (SELECT *, start::DOUBLE / nullif(need, 0)::DOUBLE AS f FROM o)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(need - start, 0), size) + least(greatest(need - start - source_size, 0), size)
            + least(greatest(need - start - 2 * source_size, 0), size) AS BIGINT) AS taken,
       CASE WHEN start < need THEN round(CASE w
         WHEN 1 THEN CASE WHEN f <= 0.625 THEN 2.0 * f / (1.5 + sqrt(greatest(0.0, 2.25 - 2.0 * f)))
                          ELSE 0.5 + 2.0 * (f - 0.625) / (1.0 + sqrt(greatest(0.0, 1.0 - 2.0 * (f - 0.625)))) END
         WHEN 2 THEN 2.0 * f / (1.0 + sqrt(1.0))
         ELSE CASE WHEN f <= 0.375 THEN 2.0 * f / (0.5 + sqrt(greatest(0.0, 0.25 + 2.0 * f)))
                   ELSE 0.5 + 2.0 * (f - 0.375) / (1.0 + sqrt(greatest(0.0, 1.0 + 2.0 * (f - 0.375)))) END END, 9) END AS position
FROM p
"""
