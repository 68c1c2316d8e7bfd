"""Detection without masking: every rule on its own, as columns and rows; JVM expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import many
from ..functions.text import valid_ico
from ..plans import catalog, prefilter

#: Common kinds in plain ASCII, so that every engine reads the patterns alike.
ASCII = {
    "EMAIL": r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]*[A-Za-z0-9_]",
    "IPV4": r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])\b",
    "CARD": r"\b(?:4[0-9]{3}|5[1-5][0-9]{2}|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720|6011|65[0-9]{2}|35[0-9]{2}|30[0-5][0-9]|36[0-9]{2}|62[0-9]{2})"
    r"[ \t\r\n-]?[0-9]{4}[ \t\r\n-]?[0-9]{4}[ \t\r\n-]?[0-9]{4}\b",
    "PHONE": r"\+[0-9]{1,3}[ \t\r\n-]?\(?[0-9]{1,5}\)?[ \t\r\n-]?[0-9]{3,5}[ \t\r\n-]?[0-9]{3,5}\b",
    "MAC": r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b",
    "UUID": r"\b[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-4[0-9A-Fa-f]{3}-[89ABab][0-9A-Fa-f]{3}-[0-9A-Fa-f]{12}\b",
    "URL": r"https?://[^ \t\r\n\"'<>]+",
}


def detect_ascii(df: DataFrame, kinds: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kind, n (from 0 within key and kind) and value of every match."""
    parts = [F.transform(F.regexp_extract_all(text, F.lit(ASCII[k]), F.lit(0)), _numbered(k)) for k in kinds]
    found = F.concat(*[F.coalesce(p, F.array().cast("array<struct<kind:string,n:int,value:string>>")) for p in parts])
    return _rows(df, key, found).select(key, "e.kind", "e.n", "e.value")


def _rows(df: DataFrame, key: str, found: Column) -> DataFrame:
    """One row for each element; the outer form keeps the optimizer from testing the costly array a second time, earlier."""
    return df.select(key, F.explode_outer(found).alias("e")).filter(F.col("e").isNotNull())


def _numbered(kind: str):
    return lambda v, i: F.struct(F.lit(kind).alias("kind"), i.alias("n"), v.alias("value"))


def _guard(text: Column, rule: catalog.Rule) -> Column:
    """Cheap test that a text can match a rule at all."""
    words, digit = prefilter.needs(rule.pattern, rule.ignore_case)
    tests = [F.regexp_like(text, F.lit(r"(?U)\d"))] if digit else []
    if words and len(words) <= 12 and all(w.isascii() for w in words) and not rule.ignore_case:
        low = F.lower(text)
        tests.append(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def detect(df: DataFrame, rules: list[catalog.Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, rule (number in the list), prefix, label, start, end, value: every match of every rule, overlaps included.

    Rules that keep a keyword give the value after it. Rules with a checksum give only values that pass it."""
    rules = catalog.ALL if rules is None else rules
    patterns = [catalog.jvm(r) if r is not catalog.SECTION_ITEM else "(?m)" + catalog.jvm(r) for r in rules]
    out = []
    # one projection for each batch of rules keeps the generated code small
    for first in range(0, len(rules), BATCH):
        own, regexes = rules[first : first + BATCH], patterns[first : first + BATCH]
        known = {k: F.array(*[F.lit(x) for x in v]) for k, v in (("prefix", [r.prefix for r in own]), ("label", [r.label for r in own]), ("mode", [r.mode for r in own]), ("pattern", regexes))}
        found = many(F.col(text), regexes, [_guard(F.col(text), r) for r in own])
        if any(r.mode == "ico" for r in own):
            found = F.filter(found, _passes(known))
        out.append(_rows(df, key, F.transform(found, _described(first, known))).select(key, "e.*"))
    return reduce(DataFrame.unionByName, out)


BATCH = 56


def _passes(known: dict[str, Column]):
    return lambda s: (F.get(known["mode"], s["n"]) != "ico") | valid_ico(s["val"])


def _described(first: int, known: dict[str, Column]):
    """A match with its rule; of a rule that keeps its keyword, the value after it."""

    def row(s: Column) -> Column:
        of = lambda k: F.get(known[k], s["n"])
        keeps = of("mode") == "value"
        head, value = (F.call_function("regexp_extract", s["val"], of("pattern"), F.lit(g)) for g in (1, 2))
        start = s["start"] + F.when(keeps, F.length(head)).otherwise(0)
        end = F.when(keeps, start + F.length(value)).otherwise(s["end"])
        return F.struct((s["n"] + first).alias("rule"), of("prefix").alias("prefix"), of("label").alias("label"), start.alias("start"), end.alias("end"), F.trim(F.when(keeps, value).otherwise(s["val"])).alias("value"))

    return row


def mask_typed(text: Column, kinds: list[str]) -> Column:
    """Every match of the ASCII kinds, in this order, becomes its kind in brackets, without a number."""
    return reduce(lambda t, k: F.regexp_replace(t, ASCII[k], f"[{k}]"), kinds, text)


def placeholder_map(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, kind, n, value) to key, kind, value (as first seen), placeholder, n_seen: distinct values in lower case and
    without outer space are numbered in the order of their first place."""
    from pyspark.sql.window import Window as W

    folded = found.withColumn("k", F.lower(F.trim("value")))
    first = folded.groupBy(key, "kind", "k").agg(F.min("n").alias("first"), F.min_by("value", "n").alias("value"), F.count("*").alias("n_seen"))
    number = F.row_number().over(W.partitionBy(key, "kind").orderBy("first"))
    return first.select(key, "kind", "value", F.concat("kind", number.cast("string")).alias("placeholder"), "n_seen")
