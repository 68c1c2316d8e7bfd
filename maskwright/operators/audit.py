"""Residual audit of masked text: what still looks like personal data, by severity; JVM expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import many
from ..plans import catalog, prefilter
from ..plans.audit_rules import LEVELS, at_least

HOLE = chr(0xE400)
LEAKS = "array<struct<pattern:string,match:string,severity:string,position:int>>"


def holed(text: Column) -> Column:
    """The text with each placeholder as one private character."""
    return F.when(F.regexp_like(text, F.lit("[A-Z][0-9]")), F.regexp_replace(text, "(?U)" + catalog.placeholder_pattern(), HOLE)).otherwise(text)


def leaks_of(text: Column, digit: Column, originals: Column, threshold: str = "high") -> Column:
    """array<struct<pattern,match,severity,position>> of a holed text, in rule order, then position.

    Matches over a hole, or equal to an original, are no leaks. Rules below the threshold are not even planned; a rule
    that needs a digit or a literal is not tried on texts without."""
    known = F.coalesce(originals, F.array().cast("array<string>"))

    rules = at_least(threshold)

    def may(rule) -> Column:
        words, digits = prefilter.needs(rule.pattern)
        tests = [digit] if digits else []
        if 0 < len(words) <= 4:
            tests.append(reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(w)) for w in words]))
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    labels, levels = (F.array(*[F.lit(x) for x in y]) for y in zip(*[(r.label, r.severity) for r in rules]))
    found = many(text, ["(?U)" + r.pattern for r in rules], [may(r) for r in rules])
    fresh = F.filter(found, lambda s: ~F.contains(s["val"], F.lit(HOLE)) & ~F.array_contains(known, s["val"]))
    return F.transform(fresh, lambda s: F.struct(F.get(labels, s["n"]).alias("pattern"), s["val"].alias("match"), F.get(levels, s["n"]).alias("severity"), s["start"].alias("position"))).cast(LEAKS)


def audit(masked: DataFrame, threshold: str = "high", text: str = "anonymized", replacements: str | None = "replacements") -> DataFrame:
    """masked with a column leaks, with places in the text whose placeholders count as one character; null text has none
    (null)."""
    known = F.col(f"{replacements}.original") if replacements else F.lit(None).cast("array<string>")
    rows = masked.withColumn("_holed", holed(F.col(text))).withColumn("_digit", F.regexp_like("_holed", F.lit(r"(?U)\d")))
    return rows.withColumn("leaks", F.when(F.col("_holed").isNotNull(), leaks_of(F.col("_holed"), F.col("_digit"), known, threshold))).drop("_holed", "_digit")


def exploded(audited: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each leak. The outer form keeps the optimizer from testing the costly array a second time, earlier."""
    return audited.select(key, F.explode_outer("leaks").alias("leak")).filter(F.col("leak").isNotNull()).select(key, "leak.*")


def summary(leaks: Column) -> Column:
    """One line: each severity with its count, three examples and how many more; empty without leaks."""
    parts = []
    for level in LEVELS:
        own = F.filter(leaks, _at(level))
        examples = F.concat_ws(", ", F.transform(F.slice(own, 1, 3), lambda x: F.concat(x["pattern"], F.lit("='"), F.substring(x["match"], 1, 30), F.lit("'"))))
        more = F.when(F.size(own) > 3, F.concat(F.lit(" (+"), (F.size(own) - 3).cast("string"), F.lit(" more)"))).otherwise("")
        parts.append(F.when(F.size(own) > 0, F.concat(F.lit(level.upper() + ": "), F.size(own).cast("string"), F.lit("× — "), examples, more)))
    line = F.concat_ws("; ", *parts)
    return F.when(line != "", F.concat(F.lit("Audit detected residual PII patterns in anonymized output: "), line)).otherwise("")


def _at(level: str):
    return lambda x: x["severity"] == level


def by_severity(leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, severity, n, examples (the first three in rule order) of exploded leaks."""
    return leaks.groupBy(key, "severity").agg(F.count("*").alias("n"), F.slice(F.collect_list("pattern"), 1, 3).alias("examples"))


def strict(audited: DataFrame) -> DataFrame:
    """The same rows; reading a row with a leak fails the query."""
    clean = F.coalesce(F.size("leaks"), F.lit(0)) <= 0
    said = F.concat(F.lit("Audit detected "), F.size("leaks").cast("string"), F.lit(" residual PII pattern(s) in anonymized output"))
    return audited.withColumn("leaks", F.when(clean, F.col("leaks")).otherwise(F.raise_error(said).cast(LEAKS)))
