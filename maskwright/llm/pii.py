"""PII by bootstrapped contextual extraction; DataFrame functions only.

Seeds are spans of four strict rules. What stands beside a seed gives lexical patterns: the word or two words to its left,
the words on both sides, and a label with its separator and the seed's shape. Patterns and the identifier-like tokens
(instances) they stand beside form a graph with one edge for each distinct pair. In each round a
pattern's confidence for a kind is the share of that kind among its distinct instances, and an instance not yet known
gets 1 - prod(1 - confidence) over its patterns, if its shape suits the kind. Patterns that enough distinct instances
support at high confidence then give their unseen identifiers as further spans.

Only spans and contexts are shuffled, never texts, and edges are deduplicated in each task before that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import apart, many, none_found, spans
from .common import dropped, row_key, stored, table
from .spans import counted, joined

KINDS = ("email", "ip", "card", "phone")
#: Forms of the base rules that try a run of characters once, where it starts, instead of at each of its characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z@._%+-]*(?:[0-9][A-Za-z@._%+-]*){4}|[A-Za-z0-9._%+-]+@)[A-Za-z0-9@._%+-]{6,}+"
NEAR = 64  # characters on each side that a lexical pattern may span; a longer word counts by those of its letters
ROUNDS, SUPPORT, CONFIDENT = 3, 3, 0.8


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = _digits(s)

    def add(a: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int")
        return a + F.when(i % 2 == 0, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """array<struct<start,end,rank,kind,val,left,right>> of the four base rules in this order; text must not be null."""
    small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
    digit = F.regexp_like(text, F.lit("[0-9]"))
    found = many(text, [EMAIL, IP, CARD, PHONE], [F.contains(text, F.lit("@")), digit, digit, F.contains(text, F.lit("+"))], NEAR)

    def passes(s: Column) -> Column:
        return (
            F.when(s["n"] == 1, F.forall(F.split(s["val"], r"\."), small))
            .when(s["n"] == 2, (F.length(_digits(s["val"])) <= 19) & _luhn(s["val"]))
            .when(s["n"] == 3, F.length(_digits(s["val"])).between(9, 15))
            .otherwise(True)
        )

    kinds = F.array(*map(F.lit, KINDS))
    return F.transform(F.filter(found, passes), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["n"].alias("rank"), F.get(kinds, s["n"]).alias("kind"), *[s[c].alias(c) for c in ("val", "left", "right")]))


def _shapes(val: Column) -> Column:
    """Kinds whose shape a token without a base match may have."""
    n = F.length(_digits(val))
    plain = F.regexp_like(val, F.lit(r"^\+?[0-9.-]+$"))
    return F.array_compact(
        F.array(
            F.when(F.regexp_like(val, F.lit(r"^[^@]+@[^@]+$")), "email"),
            F.when(F.regexp_like(val, F.lit(r"^[0-9]{1,3}(\.[0-9]{1,3}){3,}$")), "ip"),
            F.when(plain & n.between(12, 19), "card"),
            F.when(plain & n.between(7, 15), "phone"),
        )
    )


def _patterns(s: Column) -> Column:
    """Lexical patterns of a span with its context: 1, 2 words to the left; B, the words on both sides; L, a label with
    its separator (more than spaces) and the shape of what follows (digits as 9, letters as a)."""
    left, right = F.lower(s["left"]), F.lower(s["right"])
    one = F.regexp_extract(left, r"(\p{L}+)[^\p{L}]{0,8}$", 1)
    two = F.regexp_extract(left, r"(\p{L}+[^\p{L}]{1,8}\p{L}+)[^\p{L}]{0,8}$", 1)
    gap = F.regexp_replace(F.regexp_extract(left, r"\p{L}([^\p{L}]{1,8})$", 1), r"\s+", "")
    after = F.regexp_extract(right, r"^[^\p{L}]{0,8}(\p{L}+)", 1)
    shape = F.regexp_replace(F.regexp_replace(s["val"], "[0-9]", "9"), r"\p{L}+", "a")
    made = (
        F.when(one != "", F.concat(F.lit("1:"), one)),
        F.when(two != "", F.concat(F.lit("2:"), F.regexp_replace(two, r"[^\p{L}]+", " "))),
        F.when((one != "") & (after != ""), F.concat(F.lit("B:"), one, F.lit(" "), after)),
        F.when((one != "") & (gap != ""), F.concat(F.lit("L:"), one, gap, F.lit(" "), shape)),
    )
    return F.array_compact(F.array(*made))


def _observed(docs: DataFrame) -> DataFrame:
    """rid, doc_id, base (spans), seen: array of (start, end, kind or null, val, patterns) for seeds and other tokens."""
    text = F.col("_text")
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")).withColumn("rid", row_key("doc_id", "_text"))
    rows = rows.withColumn("base", base_spans(text)).withColumn("tokens", F.when(F.regexp_like(text, F.lit("[0-9@]")), spans(text, TOKEN, NEAR)).otherwise(none_found(NEAR)))
    rows = rows.withColumn("free", apart(F.col("tokens"), F.col("base")))
    one = lambda s, kind: F.struct(s["start"].alias("start"), s["end"].alias("end"), kind.cast("string").alias("kind"), F.lower(s["val"]).alias("val"), _patterns(s).alias("patterns"))
    seen = F.concat(F.transform("base", lambda s: one(s, s["kind"])), F.transform("free", lambda s: one(s, F.lit(None))))
    return rows.select("rid", "doc_id", F.transform("base", lambda s: s.dropFields("val", "left", "right")).alias("base"), seen.alias("seen"))


def _occurrences(seen: DataFrame) -> DataFrame:
    each = seen.select("rid", F.explode("seen").alias("s"))
    return each.select("rid", "s.start", "s.end", "s.kind", "s.val", F.explode("s.patterns").alias("pattern"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(pattern, val, kind or null) distinct edges to the (pattern, val, kind) that confident patterns discover."""
    seeds = edges.filter("kind is not null").select("val", "kind").distinct().withColumn("score", F.lit(1.0))
    open_ = edges.filter("kind is null").select("pattern", "val", F.explode(_shapes(F.col("val"))).alias("kind"))
    sizes = edges.groupBy("pattern").agg(F.countDistinct("val").alias("n"))
    known, patterns = stored(seeds, "instances"), None
    for _ in range(rounds):
        backed = edges.select("pattern", "val").distinct().join(known, "val").groupBy("pattern", "kind").agg(F.sum("score").alias("backing"))
        scored = backed.filter(F.col("backing") >= support).join(sizes, "pattern").withColumn("confidence", F.col("backing") / F.col("n"))
        if patterns is not None:
            dropped(patterns)
        patterns = stored(scored.filter(F.col("confidence") >= confident).select("pattern", "kind", "confidence"), "patterns")
        # a pattern alone proves no more than its own confidence, several add up
        doubt = F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("confidence"))))
        found = open_.join(patterns, ["pattern", "kind"]).groupBy("val", "kind").agg((1 - F.exp(doubt)).alias("score"))
        fresh = stored(seeds.unionByName(found.join(seeds.select("val"), "val", "left_anti")), "instances")
        dropped(known)
        known = fresh
    good = known.filter(F.col("score") >= confident - 1e-9).select("val", "kind")
    return open_.join(patterns.select("pattern", "kind"), ["pattern", "kind"]).join(good, ["val", "kind"]).select("pattern", "val", "kind").distinct()


def find_pii(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """doc_id, base and found of every row: arrays of (start, end, rank, kind), base within found.

    A null text counts as empty; repeated rows and rows without doc_id are all returned. Other columns are ignored.
    Empty in, empty out. Offsets are code points, ends exclusive. A document's spans do not depend on row order. Whole texts
    are searched, however long, in time linear in their length and nearly so in their matches."""
    seen = stored(_observed(docs), "seen")
    spots = _occurrences(seen)
    edges = stored(spots.select("pattern", "val", "kind").distinct(), "graph")
    new = stored(bootstrap(edges, rounds, support, confident), "discovered")
    rank = reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), enumerate(KINDS), F.when(F.lit(False), -1))
    hits = spots.filter("kind is null").drop("kind").join(new, ["pattern", "val"]).select("rid", "start", "end", F.struct(rank.alias("rank"), "kind").alias("k"))
    # a token that several kinds claim goes to the first of them
    hits = hits.groupBy("rid", "start", "end").agg(F.min("k").alias("k")).select("rid", F.struct("start", "end", "k.rank", "k.kind").alias("s"))
    more = stored(hits.groupBy("rid").agg(F.array_sort(F.collect_list("s")).alias("more")), "more")
    kind = "array<struct<start:int,end:int,rank:int,kind:string>>"
    return seen.join(more, "rid", "left").select("doc_id", F.col("base").cast(kind).alias("base"), F.concat(F.col("base").cast(kind), F.coalesce(F.col("more").cast(kind), F.array().cast(kind))).alias("found"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts and digest of the base spans, and all spans with those that contexts add."""
    rows = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *[counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(F.col("base"), "kind"), 256).alias("base_sha256"), joined(F.col("found"), "kind").alias("spans"))
