"""Joins on spans, lists and graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import collapsed
from ..plans import lists


def maximal_spans(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, start, length, ...) that no longer span of the same key contains; equal spans all stay.

    A span is inside a longer one exactly if some span that begins no later ends no earlier and is longer. Ordered by
    start, then by length downwards, that is: the greatest end so far reaches its end, equal spans not counted. One
    window instead of a join of all pairs."""
    end = F.col("start") + F.col("length")
    one = df.groupBy(key, "start", "length").agg(F.lit(1).alias("one"))
    before = W.partitionBy(key).orderBy("start", F.desc("length")).rowsBetween(W.unboundedPreceding, -1)
    kept = one.withColumn("reach", F.max(end).over(before)).filter(F.col("reach").isNull() | (F.col("reach") < end)).select(key, "start", "length")
    return df.join(kept, [key, "start", "length"], "left_semi")


def not_listed(df: DataFrame, column: str, words: frozenset[str]) -> DataFrame:
    """Rows whose word, in lower case and without closing signs, is not in a list of at most a few hundred words."""
    table = df.sparkSession.createDataFrame([(w,) for w in sorted(words)], "_listed string")
    return df.join(F.broadcast(table), F.rtrim(F.lower(F.trim(column)), F.lit(",.:;")) == F.col("_listed"), "left_anti")


def listed(df: DataFrame, column: str, words: frozenset[str]) -> DataFrame:
    table = df.sparkSession.createDataFrame([(w,) for w in sorted(words)], "_listed string")
    return df.join(F.broadcast(table), F.rtrim(F.lower(F.trim(column)), F.lit(",.:;")) == F.col("_listed"), "left_semi")


def is_slash_list(text: Column) -> Column:
    """A slash-separated list of kept tokens only."""
    parts = F.filter(F.split(text, "/"), lambda p: F.trim(p) != "")
    return F.contains(text, F.lit("/")) & (F.size(parts) > 0) & F.forall(parts, lambda p: F.lower(F.trim(p)).isin(*sorted(lists.KEPT_TOKENS)))


def classify(originals: DataFrame, entities: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, original) with the label of the first entity (key, n, text, label) of the same key that holds it or lies in
    it, in lower case and with single spaces; no row without one."""
    a = originals.select(key, "original", collapsed(F.col("original")).alias("a")).distinct()
    b = entities.select(key, "n", "label", collapsed(F.col("text")).alias("b"))
    hit = a.join(b, (a[key] == b[key]) & (F.contains("a", F.col("b")) | F.contains("b", F.col("a")))).drop(b[key])
    return hit.groupBy(key, "original").agg(F.min_by("label", "n").alias("label"))


def route(requests: DataFrame, directions: list[str] | None = None) -> DataFrame:
    """(src, tgt, document_mode) to pair, pivot, document_mode, status: the direct direction, else over English (without
    document mode), else unsupported. Slovak counts as Czech. Languages beyond the list are unknown."""
    spark = requests.sparkSession
    edges = [d.split("-") for d in (directions or lists.DIRECTIONS)]
    table = spark.createDataFrame([(d[-2], d[-1], len(d) == 3) for d in edges], "s string, t string, doc boolean")
    rows = requests.withColumn("_s", F.when(F.col("src") == "sk", "cs").otherwise(F.col("src"))).withColumn("_t", F.when(F.col("tgt") == "sk", "cs").otherwise(F.col("tgt")))
    direct = table.select(F.col("s").alias("_s"), F.col("t").alias("_t"), F.col("doc").alias("document_mode"), F.lit(True).alias("direct"))
    plain = table.filter(~F.col("doc"))
    first, second = plain.filter("t = 'en'").select(F.col("s").alias("_s")), plain.filter("s = 'en'").select(F.col("t").alias("_t"))
    hops = first.withColumn("mid", F.lit("en")).join(second.withColumn("mid", F.lit("en")), "mid").drop("mid").withColumn("two", F.lit(True))
    out = rows.join(F.broadcast(direct), ["_s", "_t", "document_mode"], "left").join(F.broadcast(hops), ["_s", "_t"], "left")
    known = F.col("_s").isin(*sorted(lists.LANGUAGES)) & F.col("_t").isin(*sorted(lists.LANGUAGES))
    status = F.when(~known, "unknown_language").when(F.col("direct"), "direct").when(F.col("two"), "pivot").otherwise("unsupported")
    pair = F.when(status == "direct", F.concat_ws("-", F.when(F.col("document_mode"), "doc"), "_s", "_t")).when(status == "pivot", F.concat("_s", F.lit("->en->"), "_t"))
    return out.select("src", "tgt", F.col("_t").alias("target"), pair.alias("pair"), (status == "pivot").alias("pivot"), (F.col("document_mode") & (status == "direct")).alias("document_mode"), status.alias("status"))
