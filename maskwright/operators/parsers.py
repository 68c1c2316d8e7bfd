"""Parsers of annotation formats, as column expressions and window queries; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.spans import spans
from ..functions.text import CJK_CHARS, rgb_hex, type_label
from ..plans import lists

LINES = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


# ---------------------------------------------------------------- tokens with B/I/O tags


def smart_join(tokens: Column) -> Column:
    """Tokens joined by spaces, but none before closing signs, after opening ones, or between Han and kana letters."""
    cjk = lambda c: F.regexp_like(c, F.lit(CJK_CHARS))

    def step(a: Column, t: Column) -> Column:
        tight = t.isin(*".,;:!?)]}%/") | a["last"].isin(*"([{/") | (cjk(F.right(a["last"], F.lit(1))) & cjk(F.left(t, F.lit(1))))
        return F.struct(F.when(a["first"], t).when(tight, F.concat(a["out"], t)).otherwise(F.concat(a["out"], F.lit(" "), t)).alias("out"), t.alias("last"), F.lit(False).alias("first"))

    begin = F.struct(F.lit("").alias("out"), F.lit("").alias("last"), F.lit(True).alias("first"))
    return F.aggregate(tokens, begin, step, lambda a: a["out"])


def conll_entities(df: DataFrame, key: str = "doc_id", text: str = "conll") -> DataFrame:
    """Two-column token lists to entities: key, entity (from 1), type, label, text, tokens, nested.

    A token with a B- tag begins an entity, whose first B- tag is its type and the rest are nested; an I- tag goes on, or
    begins one if none is open; O and blank lines close. Lines of another width are passed over. Sessions are numbered
    by a running sum over the document's lines, then grouped."""
    lines = df.select(key, F.posexplode(F.split(text, LINES, -1)).alias("pos", "raw")).withColumn("line", F.regexp_replace("raw", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    parts = F.split("line", "\t", -1)
    rows = lines.filter((F.col("line") == "") | (F.size(parts) == 2)).select(key, "pos", (F.col("line") == "").alias("blank"), parts[0].alias("token"), F.element_at(parts, -1).alias("tags"))
    tags = F.filter(F.split("tags", r"\|"), lambda t: t != "")
    strip = lambda prefix: F.transform(F.filter(tags, lambda t: F.startswith(t, F.lit(prefix))), lambda t: F.substring(t, 3, 1 << 20))
    rows = rows.withColumn("out", F.col("blank") | (F.col("tags") == "O")).withColumn("starts", F.when(~F.col("out"), strip("B-"))).withColumn("inside", F.when(~F.col("out"), strip("I-")))
    order = W.partitionBy(key).orderBy("pos")
    rows = rows.withColumn("begins", ~F.col("out") & ((F.size("starts") > 0) | F.coalesce(F.lag("out").over(order), F.lit(True))))
    rows = rows.withColumn("session", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))).filter(~F.col("out"))
    kind = F.coalesce(F.try_element_at("starts", F.lit(1)), F.try_element_at("inside", F.lit(1)), F.lit("?"))
    nested = F.when(F.size("starts") > 0, F.slice("starts", 2, 1 << 20)).otherwise(F.array().cast("array<string>"))
    found = rows.groupBy(key, "session").agg(
        F.min_by(kind, "pos").alias("type"), F.min_by(nested, "pos").alias("nested"), F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("t")
    )
    return found.select(key, F.col("session").alias("entity"), "type", type_label(F.col("type")).alias("label"), smart_join(F.col("t.token")).alias("text"), F.col("t.token").alias("tokens"), "nested")


def to_conll(tokens: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tokens (key, sentence, n from 0, form) and disjoint spans (key, sentence, start, length, type) to key, conll: one
    line a token with B- or I- and the type, or O, and a blank line after each sentence."""
    begins = spans.select(key, "sentence", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("i"), "start", "type")
    tags = begins.select(key, "sentence", (F.col("start") + F.col("i")).alias("n"), F.concat(F.when(F.col("i") == 0, "B-").otherwise("I-"), "type").alias("tag"))
    lines = tokens.join(tags, [key, "sentence", "n"], "left").groupBy(key, "sentence").agg(
        F.array_sort(F.collect_list(F.struct("n", F.concat("form", F.lit("\t"), F.coalesce("tag", F.lit("O"))).alias("line")))).alias("t")
    )
    whole = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("sentence", F.concat(F.array_join("t.line", "\n"), F.lit("\n\n")).alias("s")))).alias("s"))
    return whole.select(key, F.array_join("s.s", "").alias("conll"))


# ---------------------------------------------------------------- ten-column tokens


def conllu_tokens(df: DataFrame, key: str = "doc_id", text: str = "conllu") -> DataFrame:
    """Ten-column sentences to tokens: key, sentence, id, form, lemma, upos, xpos, feats (map), head, deprel, token_range.

    Comments, multiword and empty tokens and shorter lines are passed over; sentences without tokens do not count."""
    lines = df.select(key, F.posexplode(F.split(text, LINES, -1)).alias("pos", "raw")).withColumn("line", F.regexp_replace("raw", r"(?U)[\s\x1c-\x1f]+$", ""))
    p = F.split("line", "\t", -1)
    rows = lines.filter((F.col("line") == "") | (~F.startswith("line", F.lit("#")) & (F.size(p) >= 10) & ~F.regexp_like(p[0], F.lit("[-.]"))))
    order = W.partitionBy(key).orderBy("pos")
    gap = F.coalesce(F.lag(F.col("line") == "").over(order), F.lit(True))
    rows = rows.withColumn("begins", (F.col("line") != "") & gap).withColumn("sentence", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    some = lambda c: F.when(c != "_", c)
    pairs = F.filter(F.split(p[5], r"\|"), lambda kv: F.contains(kv, F.lit("=")))
    split = F.transform(pairs, lambda kv: F.struct(F.substring_index(kv, "=", 1).alias("k"), F.regexp_replace(kv, "^[^=]*=", "").alias("v")))
    last = F.filter(split, lambda s: F.lit(True))
    feats = F.map_from_entries(F.aggregate(last, F.array().cast("array<struct<k:string,v:string>>"), lambda a, s: F.concat(F.filter(a, lambda x: x["k"] != s["k"]), F.array(s))))
    place = F.regexp_extract(p[9], r"TokenRange=([0-9]+):([0-9]+)", 1), F.regexp_extract(p[9], r"TokenRange=([0-9]+):([0-9]+)", 2)
    return rows.filter("line <> ''").select(
        key, "sentence", p[0].cast("int").alias("id"), p[1].alias("form"), p[2].alias("lemma"), p[3].alias("upos"), some(p[4]).alias("xpos"), feats.alias("feats"),
        some(p[6]).cast("int").alias("head"), some(p[7]).alias("deprel"), F.when(place[0] != "", F.array(place[0].cast("int"), place[1].cast("int"))).alias("token_range"),
    )


# ---------------------------------------------------------------- annotated text

ANNOTATED = r"(\[[\p{L}\p{N}_#]+\]|[\p{L}\p{N}_]+)_\[([^\]]+)\]"


def annotated(text: Column) -> dict[str, Column]:
    """PLACEHOLDER_[original] text to anonymized, and replacements with placeholder, original and 50 characters before."""
    found = spans(text, ANNOTATED)

    def row(s: Column) -> Column:
        first = F.greatest(s["start"] - 50, F.lit(0))
        return F.struct(
            F.regexp_extract(s["val"], ANNOTATED, 1).alias("placeholder"), F.regexp_extract(s["val"], ANNOTATED, 2).alias("original"), F.substring(text, first + 1, s["start"] - first).alias("before")
        )

    return {"anonymized": F.regexp_replace(text, ANNOTATED, "$1"), "replacements": F.transform(found, row)}


# Ends of business names.
SUFFIX = r"(?iU)\b(s\.\s*r\.\s*o|sr\.o|a\.\s*s|spol|k\.\s*s|v\.\s*o\.\s*s|z\.\s*s|o\.\s*p\.\s*s)\b"


def fragmentation(raw: Column, source: Column) -> dict[str, Column]:
    """glued: placeholders with a word stuck to them (placeholder, word); leftover: business suffixes of the source that
    are still outside the annotations, sorted."""
    glue = r"(?U)\b([FIA]ABBR\d+)([A-Za-zÁ-ž]+)"
    pairs = F.transform(F.regexp_extract_all(raw, F.lit(glue), F.lit(0)), lambda m: F.struct(F.regexp_extract(m, glue, 1).alias("placeholder"), F.regexp_extract(m, glue, 2).alias("word")))
    ends = lambda t: F.transform(F.regexp_extract_all(t, F.lit(SUFFIX), F.lit(0)), lambda m: F.replace(F.lower(m), F.lit(" "), F.lit("")))
    return {"glued": pairs, "leftover": F.sort_array(F.array_intersect(ends(source), ends(F.regexp_replace(raw, r"_\[[^\]]+\]", ""))))}


def restore_stopped(text: Column, replacements: Column, stop: frozenset[str] = lists.STOP_WORDS) -> dict[str, Column]:
    """Masked text and its replacements (array of structs with placeholder and original): those whose original is on the
    stop list go, and the first place of their placeholder becomes the original again."""
    common = lambda r: F.lower(F.trim(r["original"])).isin(*sorted(stop))

    def back(t: Column, r: Column) -> Column:
        at = F.instr(t, r["placeholder"])
        return F.when(at > 0, F.concat(F.substring(t, F.lit(1), at - 1), F.trim(r["original"]), F.substring(t, at + F.length(r["placeholder"]), F.length(t)))).otherwise(t)

    return {"anonymized": F.aggregate(F.filter(replacements, common), text, back), "replacements": F.filter(replacements, lambda r: ~common(r)), "n_restored": F.size(F.filter(replacements, common))}


# ---------------------------------------------------------------- readability reports


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


METRIC = r"""(?is)<span[^>]*data-tooltip="([^"]+)"[^>]*>\s*-\s*([^:<]+):\s*([^<]+)</span>"""


def stats(html: Column) -> dict[str, Column]:
    """metrics (map of label to value and tooltip), sentences, tokens, version, processing_time_s of a report's HTML."""
    one = F.transform(
        F.regexp_extract_all(html, F.lit(METRIC), F.lit(0)),
        lambda m: F.struct(
            _clean(F.regexp_extract(m, METRIC, 2)).alias("k"),
            F.struct(_clean(F.regexp_extract(m, METRIC, 3)).alias("value"), _clean(F.regexp_replace(F.regexp_extract(m, METRIC, 1), "<br/?>", " ")).alias("tooltip")).alias("v"),
        ),
    )
    kind = "array<struct<k:string,v:struct<value:string,tooltip:string>>>"
    metrics = F.map_from_entries(F.aggregate(one, F.array().cast(kind), lambda a, s: F.concat(F.filter(a, lambda x: x["k"] != s["k"]), F.array(s)).cast(kind)))
    counts, got = r"(?i)number of sentences:\s*([0-9]+),\s*tokens:\s*([0-9]+)", lambda p, g: F.nullif(F.regexp_extract(html, p, g), F.lit(""))
    return {
        "metrics": metrics,
        "sentences": got(counts, 1).cast("int"),
        "tokens": got(counts, 2).cast("int"),
        "version": F.nullif(_clean(F.regexp_extract(html, r"(?i)PONK\s*<span[^>]*>([^<]+)</span>", 1)), F.lit("")),
        "processing_time_s": got(r"(?i)Processing time:\s*([0-9.]+)\s*s", 1).try_cast("double"),
    }


RULE = "struct<cz_name:string,cz_doc:string,en_name:string,en_doc:string,order:int,foreground_color:struct<red:int,green:int,blue:int>>"


def activated_rules(df: DataFrame, key: str = "doc_id", html: str = "features", info: str = "rule_info") -> DataFrame:
    """Rules of a JSON object that the HTML names at least once: key, id, names, count, color, rank by the rule's order
    (none or 0 last)."""
    used = df.select(key, F.explode(F.regexp_extract_all(html, F.lit(r"app1RuleHoverStart\('([\p{L}\p{N}_]+)'\)"), F.lit(1))).alias("id")).groupBy(key, "id").agg(F.count("*").alias("count"))
    defined = df.select(key, F.posexplode(F.map_entries(F.coalesce(F.from_json(info, f"map<string,{RULE}>"), F.create_map().cast(f"map<string,{RULE}>")))).alias("pos", "e"))
    rows = defined.select(key, "pos", F.col("e.key").alias("id"), "e.value.*").join(used, [key, "id"])
    fg = F.col("foreground_color")
    weight = F.coalesce(F.nullif("order", F.lit(0)), F.lit(999))
    rank = F.row_number().over(W.partitionBy(key).orderBy(weight, "pos"))
    return rows.select(key, "id", "cz_name", "cz_doc", "en_name", "en_doc", "count", F.when(fg.isNotNull(), rgb_hex(fg["red"], fg["green"], fg["blue"])).alias("color"), "order", rank.alias("rank"))


def lexical_surprise(text: Column) -> dict[str, Column]:
    """distribution and colors of a JSON report, and its words in three bands (levels to 6, to 12, beyond)."""
    data = F.from_json(text, "struct<distribution:map<string,int>,colours:map<string,string>>")
    shares = F.coalesce(data["distribution"], F.create_map().cast("map<string,int>"))
    level = lambda e: e["key"].try_cast("int")
    total = lambda test: F.aggregate(F.filter(F.map_entries(shares), lambda e: level(e).isNotNull() & test(level(e))), F.lit(0), lambda a, e: a + e["value"])
    return {
        "distribution": shares,
        "colors": F.coalesce(data["colours"], F.create_map().cast("map<string,string>")),
        "common": total(lambda n: n <= 6),
        "surprising": total(lambda n: (n > 6) & (n <= 12)),
        "very_surprising": total(lambda n: n > 12),
    }


def speech_acts(text: Column) -> Column:
    """Map of the kinds of sentences to their colours in a JSON report."""
    return F.coalesce(F.from_json(text, "struct<colours:map<string,string>>")["colours"], F.create_map().cast("map<string,string>"))


# ---------------------------------------------------------------- entities


def split_romance(df: DataFrame) -> DataFrame:
    """Entity rows (type, label, text, ...): a person "X de Place" becomes a person X and a place, unless Place is a known
    last part of names. Adds split (long) and warning."""
    name = r"^(.+?)\s+(de|del|della|do|da)\s+([A-ZÁ-Ž][a-zá-ž]{2,})$"
    part = lambda g: F.regexp_extract("text", name, g)
    fits = (F.col("type") == "PER") & F.regexp_like("text", F.lit(name))
    kept = F.lower(part(3)).isin(*sorted(lists.NAME_PARTS))
    same = F.struct(F.col("type"), F.col("label"), F.col("text"), F.lit(False).alias("split"), F.when(fits & kept, F.concat(F.lit("kept whole: "), F.col("text"))).alias("warning"))
    said = F.concat(F.lit("split: "), F.col("text"))
    two = F.array(
        F.struct(F.lit("PER").alias("type"), F.lit("osoba").alias("label"), F.trim(part(1)).alias("text"), F.lit(True).alias("split"), said.alias("warning")),
        F.struct(F.lit("LOC").alias("type"), F.lit("lokace/místo").alias("label"), part(3).alias("text"), F.lit(True).alias("split"), F.lit(None).cast("string").alias("warning")),
    )
    rest = [c for c in df.columns if c not in ("type", "label", "text", "split", "warning")]
    return df.select(*rest, F.explode(F.when(fits & ~kept, two).otherwise(F.array(same))).alias("e")).select(*rest, "e.*")
