"""Secret scans with an incremental blob ledger; DataFrame functions only.

A blob is a whole text under the SHA-256 of its bytes. The ledger holds one row for each (blob, rule version) pair ever
scanned, with the spans found, in folders by the first digits of the blob. A run joins the keys of its own blobs with the
ledger, scans only the pairs that are missing, each distinct text once, appends them, and joins the findings back to
every path that holds the blob. A new rule version thus scans old blobs with the new rules only, texts without any of its
literals stay where they are, and an unchanged table scans nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.spans import many, replaced
from .common import dropped, new_path, stored, table
from .spans import counted, joined

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Rule versions in order; a version's rules never change. (kind, pattern, literals of which one must be there, or none)
RULES: dict[str, list[tuple[str, str, tuple[str, ...]]]] = {
    "base-1": [("assign", ASSIGN, ()), ("access", "AKIA[A-Z0-9]{16,}", ("AKIA",)), ("hex", "[0-9a-f]{24,}", ())],
    "vendor-1": [
        ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", ("-----BEGIN",)),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", (".eyJ",)),
        ("github", "gh[opsur]_[A-Za-z0-9]{36,}", ("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
        ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
        ("google", "AIza[A-Za-z0-9_-]{35}", ("AIza",)),
        ("stripe", "[rs]k_live_[A-Za-z0-9]{24,}", ("k_live_",)),
    ],
}
RANK = {kind: n for n, kind in enumerate(k for rules in RULES.values() for k, _, _ in rules)}
BASE = ("assign", "access", "hex")
FOUND = "array<struct<start:int,end:int,rank:int,kind:string>>"
LEDGER = f"blob string, version string, found {FOUND}, prefix string"


def _may(text: Column, needs: tuple[str, ...]) -> Column:
    """Cheap test that a rule can match at all."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in needs]) if needs else F.lit(True)


def _scan(text: Column, rules: list[tuple[str, str, tuple[str, ...]]]) -> Column:
    kinds, ranks = F.array(*[F.lit(k) for k, _, _ in rules]), F.array(*[F.lit(RANK[k]) for k, _, _ in rules])
    found = many(text, [p for _, p, _ in rules], [_may(text, needs) for _, _, needs in rules])
    fits = F.filter(found, lambda s: (F.get(kinds, s["n"]) != "assign") | (F.length(F.regexp_extract(s["val"], ASSIGN, 2)) >= 6))
    return F.transform(fits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(ranks, s["n"]).alias("rank"), F.get(kinds, s["n"]).alias("kind"))).cast(FOUND)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def blobs(docs: DataFrame) -> DataFrame:
    """docs with `blob`, the SHA-256 of the text (of the empty text for null)."""
    return docs.withColumn("blob", F.sha2(_text(), 256))


def _held(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None where there is no ledger yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def scan(docs: DataFrame, ledger: str, rules: dict | None = None) -> DataFrame:
    """Bring the ledger (a Parquet path, made if missing) up to date for docs; return (blob, found) for those of its
    blobs with findings, over all rule versions given.

    Only the ledger's rows of this run's blobs are grouped. Texts that some missing rule may match are gathered by blob,
    per task before the shuffle, so a text with many copies moves once a task; other texts do not move. Runs that overlap
    may append a pair twice, which counts once. A null text is the empty text. Columns other than text are ignored. Empty
    in, empty out."""
    rules = rules or RULES
    spark = docs.sparkSession
    keyed = blobs(docs.select("text"))
    # all joins here are by merging: files can be far smaller than what they hold, and most sides go by blob anyway
    own = stored(keyed.select("blob").distinct(), "blobs")
    held = _held(spark, ledger)
    seen = own.withColumn("seen", F.array().cast("array<string>"))
    if held is not None:
        known = held.filter(F.col("version").isin(*rules)).join(own.hint("merge"), "blob", "left_semi").groupBy("blob").agg(F.collect_set("version").alias("seen"))
        seen = own.join(known.hint("merge"), "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    unseen = stored(seen.filter(F.size("seen") < len(rules)), "unseen")
    # one flag for each rule version: whether some blob lacks it
    lacks = unseen.agg(*[F.coalesce(F.max(~F.array_contains("seen", v)), F.lit(False)).alias(v) for v in rules]).first()
    wanted = [v for v in rules if lacks[v]]
    if wanted:
        may = reduce(lambda a, b: a | b, [_may(_text(), needs) for v in wanted for _, _, needs in rules[v]])
        texts = keyed.filter(may).groupBy("blob").agg(F.first(_text()).alias("text"))
        pair = lambda v: F.when(~F.array_contains("seen", v), F.struct(F.lit(v).alias("version"), F.coalesce(_scan(F.col("text"), rules[v]), F.array().cast(FOUND)).alias("found")))
        # outer, so that the optimizer does not compute the costly array a second time to test that it is not empty
        pairs = unseen.join(texts.hint("merge"), "blob", "left").select("blob", F.explode_outer(F.array_compact(F.array(*map(pair, wanted)))).alias("pair")).filter("pair is not null")
        pairs.select("blob", "pair.version", "pair.found", F.left("blob", F.lit(1)).alias("prefix")).repartition("prefix").write.partitionBy("prefix").mode("append").parquet(ledger)
    dropped(unseen)
    rows = _held(spark, ledger)
    if rows is None:  # no document, so no file was written
        rows = spark.createDataFrame([], LEDGER)
    rows = rows.filter(F.col("version").isin(*rules) & (F.size("found") > 0)).join(own.hint("merge"), "blob", "left_semi")
    out = stored(rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("found"))).alias("found")), "findings")
    dropped(own)
    return out


def _broadcast_if_small(found: DataFrame) -> DataFrame:
    """Findings for a join. Spark judges them by their files, in which spans that recur from text to text take next to
    nothing; in the driver's memory each takes 64 bytes. Where that is more than may be broadcast, the join is by merging."""
    most = found.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = found.agg(F.sum(F.lit(256).cast("long") + F.size("found") * F.lit(64).cast("long"))).first()[0] or 0
    return found.hint("merge") if size > most else found


def find_secrets(docs: DataFrame, ledger: str | None = None, rules: dict | None = None) -> DataFrame:
    """docs' columns plus `found` (array of start, end, rank, kind; empty if none) for every row, repeated rows included.

    Every row is a path: a table of (path, version, text) gives the findings of each historical version of each path. The
    ledger lies in the shared folder unless a path is given. An input column named found or blob is replaced. Null texts
    are empty; very long ones are scanned whole."""
    keep = [c for c in docs.columns if c not in ("blob", "found")]
    found = scan(docs, ledger or new_path(docs.sparkSession, "ledger"), rules)
    rows = blobs(docs).drop("found").join(_broadcast_if_small(found), "blob", "left")
    return rows.select(*keep, F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def findings(history: DataFrame, ledger: str, path: str = "path", version: str = "version") -> DataFrame:
    """(path, version, text) rows of every historical version to one row for each secret: path, version, kind, start, end,
    first_seen (the least version of the path whose text has the same kind at the same place).

    Versions with the same text share one blob and one scan. A null text has no secret."""
    each = find_secrets(history.select(F.col(path), F.col(version), F.col("text")), ledger).select(path, version, F.explode("found").alias("s"))
    rows = each.select(path, version, "s.kind", "s.start", "s.end")
    return rows.withColumn("first_seen", F.min(version).over(W.partitionBy(path, "kind", "start", "end")))


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans become one mark."""
    return replaced(text, found, mark)


def op6_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Secrets of all documents in two runs over one ledger: first the base rules, then all rules, which scans each blob
    with the rules that it has not seen yet. Null texts are empty, repeated rows stay, no row is left out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = new_path(spark, "ledger")
    scan(docs, ledger, {"base-1": RULES["base-1"]})
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return find_secrets(docs, ledger).select(
        "doc_id", *[counted(F.col("found"), k).alias(f"n_{k}") for k in BASE], F.sha2(joined(base, "start"), 256).alias("base_sha256"), joined(F.col("found"), "start").alias("spans")
    )


def _oracle() -> str:
    parts = []
    for rules in RULES.values():
        for kind, pattern, _ in rules:
            p = "'" + pattern.replace("'", "''") + "'"
            extra = f", regexp_extract_all(t, {p}, 2) AS g" if kind == "assign" else ""
            parts.append(
                f"SELECT doc_id, '{kind}' AS kind, {RANK[kind]} AS rank, CAST(list_sum(list_transform(s[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start, len(f[i]) AS n"
                f" FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, {p}) AS s, regexp_extract_all(t, {p}) AS f{extra} FROM d))" + (" WHERE len(g[i]) >= 6" if extra else "")
            )
    line = "kind || ':' || start || ':' || (start + n)"
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), a AS (" + " UNION ALL ".join(parts) + "), "
        f"g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,"
        f" string_agg({line}, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg({line}, ',' ORDER BY start, rank) AS spans FROM a GROUP BY doc_id) "
        "SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,"
        " sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN g USING (doc_id)"
    )


OP6_SQL = _oracle()
