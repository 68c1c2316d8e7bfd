"""Queries over the test tables, by name, each with SQL for the oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import language, text as texts
from .operators import audit as audits
from .operators import detect, languages, mask, parsers, relations
from .plans import catalog, fixtures, lists
from .plans.audit_rules import at_least
from .plans.fixtures import frame, values
from .sources.io import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register the function under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# ---------------------------------------------------------------- validation and normalization

RE2 = {"control": r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "invisible": r"[\x{200b}-\x{200d}\x{2060}\x{feff}]", "private": r"[\x{e100}-\x{e400}]", "zero": r"[\x{200b}-\x{200d}\x{2060}\x{feff}\x{180e}\x{00ad}]", "bidi": r"[\x{202a}-\x{202e}\x{2066}-\x{2069}\x{200e}\x{200f}]"}
STRIPPED = f"regexp_replace(regexp_replace(regexp_replace(t, {q(RE2['control'])}, '', 'g'), {q(RE2['invisible'])}, '', 'g'), {q(RE2['private'])}, '', 'g')"
VALIDATE = f"""
SELECT k, CASE WHEN t IS NULL THEN 'missing' WHEN t = '' THEN 'empty' WHEN regexp_full_match(t, '[\\s\\x1c-\\x1f]*') THEN 'blank'
  WHEN strlen(t) > 500000 THEN 'too_large' END AS status, CAST(strlen(t) AS INTEGER) AS n_bytes, strlen(t) > 100000 AS large,
  CAST(len(regexp_extract_all(t, {q(RE2['control'])})) AS INTEGER) AS n_control, CAST(len(regexp_extract_all(t, {q(RE2['invisible'])})) AS INTEGER) AS n_invisible,
  CAST(len(regexp_extract_all(t, {q(RE2['private'])})) AS INTEGER) AS n_private, sha256({STRIPPED}) AS clean_sha256 FROM (@@)"""


def _validated(df: DataFrame, key: str) -> DataFrame:
    c = texts.validated(F.col("text"))
    return df.select(F.col(key), *[c[k].alias(k) for k in ("status", "n_bytes", "large", "n_control", "n_invisible", "n_private")], F.sha2(c["clean"], 256).alias("clean_sha256"))


@query(VALIDATE.replace("@@", "SELECT doc_id AS k, text AS t FROM documents").replace("SELECT k,", "SELECT k AS doc_id,"))
def validate_documents(spark, sf_dir):
    return _validated(table(spark, sf_dir, "documents"), "doc_id")


@query(VALIDATE.replace("@@", "SELECT conv_id * 1000 + turn AS k, text AS t FROM conversations").replace("SELECT k,", "SELECT k AS turn_id,"))
def clean_text(spark, sf_dir):
    return _validated(table(spark, sf_dir, "conversations").withColumn("turn_id", F.col("conv_id") * 1000 + F.col("turn")), "turn_id")


@query(
    f"""WITH a AS (SELECT doc_id, text AS t, regexp_replace(text, {q(RE2['zero'])}, '', 'g') AS z FROM documents),
    b AS (SELECT *, regexp_replace(z, {q(RE2['bidi'])}, '', 'g') AS d FROM a), c AS (SELECT *, nfc_normalize(d) AS n FROM b)
    SELECT doc_id, CAST(length(t) - length(z) AS INTEGER) AS zw_stripped, CAST(length(z) - length(d) AS INTEGER) AS bidi_stripped,
    CAST(abs(length(d) - length(n)) AS INTEGER) AS nfc_changed, sha256(n) AS text_sha256 FROM c"""
)
def normalize_documents(spark, sf_dir):
    c = texts.normalized(F.col("text"))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", c["zw_stripped"].alias("zw_stripped"), c["bidi_stripped"].alias("bidi_stripped"), c["nfc_changed"].alias("nfc_changed"), F.sha2(c["text"], 256).alias("text_sha256"))


DIGITS = [(1, "١٢٣ and ４５"), (2, "Room ०९"), (3, "plain 42")]


@query("SELECT id, translate(t, '١٢٣４５०९', '1234509') AS text, CAST(length(t) - length(translate(t, '١٢٣４５०९', '')) AS INTEGER) AS digits_normalized FROM " + values(DIGITS, "id, t"))
def normalize_digits(spark, sf_dir):
    c = texts.normalized(F.col("t"))
    return frame(spark, DIGITS, "id int, t string").select("id", c["text"].alias("text"), c["digits_normalized"].alias("digits_normalized"))


@query("SELECT doc_id, sha256(strip_accents(text)) AS stripped_sha256, strip_accents(text) <> text AS changed FROM documents")
def strip_diacritics(spark, sf_dir):
    stripped = texts.strip_diacritics(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(stripped, 256).alias("stripped_sha256"), (stripped != F.col("text")).alias("changed"))


# ---------------------------------------------------------------- detection


def found_sql(kinds: list[str], source: str = "SELECT doc_id, text AS t FROM documents", key: str = "doc_id") -> str:
    each = [f"SELECT {key}, '{k}' AS kind, i - 1 AS n, m[i] AS value FROM (SELECT {key}, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT {key}, regexp_extract_all(t, {q(detect.ASCII[k])}) AS m FROM d))" for k in kinds]
    return f"d AS ({source}), e AS (" + " UNION ALL ".join(each) + ")"


def _single(kind: str, name: str) -> None:
    def run(spark, sf_dir):
        return detect.detect_ascii(table(spark, sf_dir, "documents"), [kind])

    run.__name__ = name
    query(f"WITH {found_sql([kind])} SELECT doc_id, kind, CAST(n AS INTEGER) AS n, value FROM e")(run)


for _kind, _name in (("EMAIL", "detect_email"), ("IPV4", "detect_ipv4"), ("CARD", "detect_card"), ("PHONE", "detect_phone_intl"), ("MAC", "detect_mac"), ("UUID", "detect_uuid4")):
    _single(_kind, _name)
MAIN = ["EMAIL", "IPV4", "CARD", "PHONE"]


@query(f"WITH {found_sql(MAIN)} SELECT kind, count(*) AS n, count(DISTINCT value) AS n_values, count(DISTINCT doc_id) AS n_docs FROM e GROUP BY kind")
def entity_counts_by_type(spark, sf_dir):
    e = detect.detect_ascii(table(spark, sf_dir, "documents"), MAIN)
    return e.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"), F.countDistinct("doc_id").alias("n_docs"))


@query(f"WITH {found_sql(MAIN, 'SELECT doc_id, lang, text AS t FROM documents', 'doc_id, lang')} SELECT lang, kind, count(*) AS n FROM e GROUP BY lang, kind")
def entity_counts_by_lang(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", "lang").alias("k"), "text")
    return detect.detect_ascii(docs, MAIN, "k").groupBy(F.col("k.lang").alias("lang"), "kind").agg(F.count("*").alias("n"))


@query(f"WITH {found_sql(MAIN, 'SELECT doc_id, lang, text AS t FROM documents', 'doc_id, lang')} SELECT lang, kind, CAST(grouping(lang, kind) AS BIGINT) AS level, count(*) AS n FROM e GROUP BY CUBE (lang, kind)")
def entity_cube(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", "lang").alias("k"), "text")
    return detect.detect_ascii(docs, MAIN, "k").select(F.col("k.lang").alias("lang"), "kind").cube("lang", "kind").agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


@query(f"WITH {found_sql(['URL', 'EMAIL'], 'SELECT page_id, html AS t FROM pages', 'page_id')} SELECT page_id, kind, count(*) AS n, min(value) AS least FROM e GROUP BY page_id, kind")
def pages_detect(spark, sf_dir):
    e = detect.detect_ascii(table(spark, sf_dir, "pages"), ["URL", "EMAIL"], "page_id", "html")
    return e.groupBy("page_id", "kind").agg(F.count("*").alias("n"), F.min("value").alias("least"))


def typed_sql(t: str, kinds: list[str]) -> str:
    for k in kinds:
        t = f"regexp_replace({t}, {q(detect.ASCII[k])}, '[{k}]', 'g')"
    return t


@query(f"SELECT doc_id, sha256({typed_sql('text', MAIN)}) AS masked_sha256 FROM documents")
def mask_typed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(detect.mask_typed(F.col("text"), MAIN), 256).alias("masked_sha256"))


@query(f"SELECT conv_id, turn, role, {typed_sql('text', MAIN)} AS masked FROM conversations")
def conversations_masked(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", detect.mask_typed(F.col("text"), MAIN).alias("masked"))


@query(
    f"""WITH {found_sql(MAIN)}, g AS (SELECT doc_id, kind, lower(trim(value)) AS k, min(n) AS first, arg_min(value, n) AS value, count(*) AS n_seen FROM e GROUP BY ALL)
    SELECT doc_id, kind, value, kind || row_number() OVER (PARTITION BY doc_id, kind ORDER BY first) AS placeholder, n_seen FROM g"""
)
def placeholder_map(spark, sf_dir):
    return detect.placeholder_map(detect.detect_ascii(table(spark, sf_dir, "documents"), MAIN))


@query()
def rule_hits(spark, sf_dir):
    """Every rule of the catalogue on its own over all documents."""
    return detect.detect(spread(table(spark, sf_dir, "documents"))).groupBy("prefix", "label").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


# ---------------------------------------------------------------- masking


@query()
def mask_numbered(spark, sf_dir):
    """The flagship: validated, normalized, masked by the whole catalogue, audited."""
    c = texts.validated(F.col("text"))
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", c["clean"].alias("text"))
    done = audits.audit(mask.mask(docs))
    return done.select("doc_id", "anonymized", F.size("replacements").alias("n_replacements"), F.size("leaks").alias("n_leaks"))


@query()
def mask_sources(spark, sf_dir):
    done = mask.counted(mask.mask(spread(table(spark, sf_dir, "documents"))))
    return done.select("doc_id", "count", *[F.element_at("sources", s).alias(s.replace("-", "_")) for s in mask.SOURCES], F.element_at("sources", "idempotence-skip").alias("skipped"))


@query("SELECT doc_id, masked AS anonymized FROM " + values(fixtures.MASKING, "doc_id, text, masked"))
def mask_fixtures(spark, sf_dir):
    rows = frame(spark, [r[:2] for r in fixtures.MASKING], "doc_id int, text string")
    return mask.mask(rows).select("doc_id", "anonymized")


ENTITY_TEXT = "Ing. Eva Malá, Beta s. r. o., Žádné CZ/SK, 我叫王伟, dnes eva@b.cz a Eva Maláková"
ENTITY_ROWS = [("P", "osoba", "Eva Malá"), ("if", "firma/společnost", "Beta s . r . o ."), ("ps", "příjmení", "Ing."), ("gu", "město/obec", "Žádné"), ("gc", "stát/země", "CZ/SK"), ("PER", "osoba", "王伟"), ("T", "datum/čas", "dnes")]


def _with_entities(spark) -> DataFrame:
    return frame(spark, [(1, ENTITY_TEXT, ENTITY_ROWS)], "doc_id int, text string, entities array<struct<type:string,label:string,text:string>>")


@query("SELECT * FROM " + values([(1, "Ing. OSOBA1, Beta s. r. o., Žádné CZ/SK, 我叫OSOBA2, dnes EMAIL1 a Eva Maláková")], "doc_id, anonymized"))
def mask_entities(spark, sf_dir):
    return mask.mask(_with_entities(spark), entities="entities").select("doc_id", "anonymized")


@query("SELECT * FROM " + values([(1, "eva@b.cz", "EMAIL1", "wrapper-regex"), (1, "Beta s . r . o .", "FIRMA1", "wrapper-strict"), (1, "Eva Malá", "OSOBA1", "wrapper-nametag-fallback"), (1, "王伟", "OSOBA2", "wrapper-nametag-fallback")], "doc_id, original, placeholder, source"))
def mask_strict(spark, sf_dir):
    return mask.mapping(mask.mask(_with_entities(spark), options=mask.Options(strict=True), entities="entities")).select("doc_id", "original", "placeholder", "source")


@query("SELECT * FROM " + values([(1, "pan OSOBA1 podal návrh, státu město MESTO1 a EMAIL1.")], "doc_id, anonymized"))
def mask_annotated(spark, sf_dir):
    def masker(t: str) -> str:
        return t.replace("Eva Malá", "Jana_[Eva Malá]").replace("státu", "UniAlfa_[státu]").replace("Brno", "Praha_[Brno]")

    rows = frame(spark, [(1, "pan Eva Malá podal návrh, státu město Brno a e@b.cz.")], "doc_id int, text string")
    return mask.mask(rows, masker=masker).select("doc_id", "anonymized")


@query("SELECT * FROM " + values([("Vláda UniAlfa a Jana UniAlfa", "Vláda Státu a Jana UniAlfa", 1, 1)], "text, anonymized, n_restored, n_left"))
def stoplist_rollback(spark, sf_dir):
    rows = frame(spark, [("Vláda UniAlfa a Jana UniAlfa", [("UniAlfa", "Státu "), ("Jana", "Eva")])], "text string, r array<struct<placeholder:string,original:string>>")
    c = parsers.restore_stopped(F.col("text"), F.col("r"))
    return rows.select("text", c["anonymized"].alias("anonymized"), c["n_restored"].alias("n_restored"), F.size(c["replacements"]).alias("n_left"))


@query("SELECT * FROM " + values([(1, "Jan\tB-P\nNovák\tI-P\njde\tO\n\nBrno\tB-gu\n\n")], "doc_id, conll"))
def conll_writer(spark, sf_dir):
    tokens = frame(spark, [(1, 0, 0, "Jan"), (1, 0, 1, "Novák"), (1, 0, 2, "jde"), (1, 1, 0, "Brno")], "doc_id int, sentence int, n int, form string")
    spans = frame(spark, [(1, 0, 0, 2, "P"), (1, 1, 0, 1, "gu")], "doc_id int, sentence int, start int, length int, type string")
    return parsers.to_conll(tokens, spans)


# ---------------------------------------------------------------- audit

#: The rules that the oracle's SQL has: its engine reads no lookaround. The queries themselves have all rules.
AUDITED = [r for r in at_least("high") if "(?!" not in r.pattern and "(?<" not in r.pattern]


def leaks_sql() -> str:
    hole = "chr(58368)"
    parts = []
    for n, r in enumerate(AUDITED):
        p = q(r.pattern.replace(r"[\w.+-]+@[\w-]+\.[\w.-]+\b", r"[\p{L}\p{N}_.+-]*[\p{L}\p{N}_][.+-]*@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]*[\p{L}\p{N}_]").removeprefix(r"\b") if r"\w" in r.pattern else r.pattern)
        parts.append(
            f"SELECT doc_id, {n} AS rule, '{r.label}' AS pattern, '{r.severity}' AS severity, m[i] AS match, CAST(list_sum(list_transform(s[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS INTEGER) AS position"
            f" FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, {p}) AS s, regexp_extract_all(t, {p}) AS m FROM d)) WHERE NOT contains(m[i], {hole})"
        )
    return f"d AS (SELECT doc_id, regexp_replace(text, {q(catalog.placeholder_pattern())}, {hole}, 'g') AS t FROM documents WHERE text IS NOT NULL), l AS (" + " UNION ALL ".join(parts) + ")"


def _leaks(spark, sf_dir) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return audits.exploded(audits.audit(docs.select("doc_id", "text"), "high", "text", None))


@query(f"WITH {leaks_sql()} SELECT doc_id, pattern, severity, match, position FROM l")
def audit_leaks(spark, sf_dir):
    return _leaks(spark, sf_dir)


@query(f"WITH {leaks_sql()} SELECT severity, pattern, count(*) AS n, count(DISTINCT doc_id) AS n_docs, min(match) AS least FROM l GROUP BY severity, pattern")
def audit_summary(spark, sf_dir):
    return _leaks(spark, sf_dir).groupBy("severity", "pattern").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"), F.min("match").alias("least"))


@query()
def audit_lines(spark, sf_dir):
    docs = audits.audit(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"), "medium", "text", None)
    return docs.filter(F.size("leaks") > 0).select("doc_id", audits.summary(F.col("leaks")).alias("summary"))


# ---------------------------------------------------------------- checks and lists

WEIGHTED = " + ".join(f"{8 - i} * CAST(d[{i + 1}] AS INTEGER)" for i in range(7))


@query(f"SELECT d AS ico, (CAST(d[8] AS INTEGER) = (((11 - ({WEIGHTED}) % 11) % 11) % 10)) AS valid FROM (SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS d FROM orders)")
def ico_checksum(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("ico")).withColumn("valid", texts.valid_ico(F.col("ico")))


WORDS_SQL = "SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word FROM documents"


def _words(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))


@query(f"WITH w AS ({WORDS_SQL}) SELECT doc_id, count(*) AS n FROM w WHERE rtrim(lower(word), ',.:;') NOT IN ({', '.join(map(q, sorted(lists.STOP_WORDS)))}) GROUP BY doc_id")
def stopword_anti_join(spark, sf_dir):
    return relations.not_listed(_words(spark, sf_dir), "word", lists.STOP_WORDS).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"WITH w AS ({WORDS_SQL}) SELECT rtrim(lower(word), ',.:;') AS token, count(*) AS n FROM w WHERE rtrim(lower(word), ',.:;') IN ({', '.join(map(q, sorted(lists.KEPT_TOKENS)))}) GROUP BY 1")
def preserve_semi_join(spark, sf_dir):
    kept = relations.listed(_words(spark, sf_dir), "word", lists.KEPT_TOKENS)
    return kept.groupBy(F.rtrim(F.lower("word"), F.lit(",.:;")).alias("token")).agg(F.count("*").alias("n"))


@query("SELECT text, kept FROM " + values(fixtures.NAMES, "text, kept"))
def public_names(spark, sf_dir):
    return frame(spark, fixtures.NAMES, "text string, kept boolean").select("text", texts.is_kept_name(F.col("text")).alias("kept"))


@query("SELECT placeholder, original, kind FROM " + values(fixtures.KINDS, "placeholder, original, before, label, kind"))
def inferred_types(spark, sf_dir):
    rows = frame(spark, fixtures.KINDS, "placeholder string, original string, before string, label string, kind string")
    return rows.select("placeholder", "original", texts.infer_type(*[F.col(c) for c in ("placeholder", "original", "before", "label")]).alias("kind"))


@query("SELECT model, language, recognition, morphology FROM " + values(fixtures.MODELS, "model, language, recognition, morphology"))
def model_routing(spark, sf_dir):
    rows = frame(spark, fixtures.MODELS, "model string, language string, r string, m string")
    pick = lambda f: f(F.col("model"), F.col("language"))
    return rows.select("model", "language", pick(texts.recognition_model).alias("recognition"), pick(texts.morphology_model).alias("morphology"))


# ---------------------------------------------------------------- language


@query("SELECT text, language FROM " + values(fixtures.LANGUAGES, "text, language"))
def language_fixtures(spark, sf_dir):
    return frame(spark, fixtures.LANGUAGES, "text string, l string").select("text", language.detect_language(F.col("text")).alias("language"))


@query()
def lang_detect(spark, sf_dir):
    return languages.detect_languages(spread(table(spark, sf_dir, "documents")))


@query()
def lang_agreement(spark, sf_dir):
    """The tables' own language against the one found, counted, by column expressions only."""
    found = spread(table(spark, sf_dir, "documents")).select("lang", language.detect_language(F.col("text")).alias("language"))
    return found.groupBy("lang", "language").agg(F.count("*").alias("n"))


@query()
def lang_scores(spark, sf_dir):
    scores = language.language_scores(F.col("text"))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", *[c.alias(n) for n, c in scores.items()])


LETTERS = {**language.LETTERS, "czech": language.CZECH_LETTERS, "slovak": language.SLOVAK_LETTERS}


@query("SELECT doc_id, " + ", ".join(f"CAST(len(regexp_extract_all(text, {q(p)})) AS INTEGER) AS {n}" for n, p in LETTERS.items()) + " FROM documents")
def lang_letters(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents")).select("doc_id", *[language.count(F.col("text"), p, False).alias(n) for n, p in LETTERS.items()])


# ---------------------------------------------------------------- parsers


@query(
    "SELECT * FROM "
    + values(
        [(1, 1, "P", "osoba", "Jan", "Jan", "pf"), (1, 2, "ps", "příjmení", "Novák", "Novák", ""), (1, 3, "gu", "město/obec", "Brně", "Brně", ""), (1, 4, "if", "firma/společnost", "Firma Alfa (pobočka)", "Firma|Alfa|(|pobočka|)", ""), (1, 5, "PER", "osoba", "田中 xx", "田|中|xx", ""), (1, 6, "LOC", "lokace/místo", "yy", "yy", "")],
        "doc_id, entity, type, label, text, tokens, nested",
    )
)
def conll_entities(spark, sf_dir):
    found = parsers.conll_entities(frame(spark, [(1, fixtures.CONLL)], "doc_id int, conll string"))
    return found.select("doc_id", F.col("entity").cast("int").alias("entity"), "type", "label", "text", F.concat_ws("|", "tokens").alias("tokens"), F.concat_ws("|", "nested").alias("nested"))


@query("SELECT * FROM " + values([(1, 1, 1, "Psi", "pes", "NN", "Plur", 2, "nsubj", 3), (1, 1, 2, "běží", "běžet", None, None, 0, "root", 8), (1, 2, 1, ".", ".", "Z", None, -1, None, -1)], "doc_id, sentence, id, form, lemma, xpos, number, head, deprel, until"))
def conllu_tokens(spark, sf_dir):
    t = parsers.conllu_tokens(frame(spark, [(1, fixtures.CONLLU)], "doc_id int, conllu string"))
    return t.select("doc_id", F.col("sentence").cast("int").alias("sentence"), "id", "form", "lemma", "xpos", F.try_element_at("feats", F.lit("Number")).alias("number"), F.coalesce("head", F.lit(-1)).alias("head"), "deprel", F.coalesce(F.try_element_at("token_range", F.lit(2)), F.lit(-1)).alias("until"))


@query("SELECT * FROM " + values([("Podepsal Jan dne [pf_#10].", "Jan", "Jiří", "Podepsal "), ("Podepsal Jan dne [pf_#10].", "[pf_#10]", "Juan", "Podepsal Jan_[Jiří] dne ")], "anonymized, placeholder, original, before"))
def annotated_text(spark, sf_dir):
    c = parsers.annotated(F.col("raw"))
    rows = frame(spark, [("Podepsal Jan_[Jiří] dne [pf_#10]_[Juan].",)], "raw string")
    return rows.select(c["anonymized"].alias("anonymized"), F.explode(c["replacements"]).alias("r")).select("anonymized", "r.placeholder", "r.original", "r.before")


@query("SELECT * REPLACE (CAST(seconds AS DOUBLE) AS seconds) FROM " + values([("ARI", "9.5", "Long words", 3, 41, "1.2", 0.52), ("Verb distance", "2.1", "Verbs", 3, 41, "1.2", 0.52)], "metric, value, tooltip, sentences, tokens, version, seconds"))
def report_stats(spark, sf_dir):
    c = parsers.stats(F.col("html"))
    rows = frame(spark, [(fixtures.STATS,)], "html string").select(F.explode(c["metrics"]).alias("metric", "m"), c["sentences"].alias("sentences"), c["tokens"].alias("tokens"), c["version"].alias("version"), c["processing_time_s"].alias("seconds"))
    return rows.select("metric", "m.value", "m.tooltip", "sentences", "tokens", "version", "seconds")


@query("SELECT * FROM " + values([(1, "b2", "Délka", 1, None, 1), (1, "a1", "Pasivum", 2, "#ff1000", 2)], 'doc_id, id, cz_name, "count", color, rank'))
def activated_rules(spark, sf_dir):
    rows = frame(spark, [(1, fixtures.RULE_HTML, fixtures.RULES), (2, "", "{broken")], "doc_id int, features string, rule_info string")
    return parsers.activated_rules(rows).select("doc_id", "id", "cz_name", F.col("count").cast("int").alias("count"), "color", "rank")


@query("SELECT * FROM " + values([(1, 7, 3, 4, 5), (2, 0, 0, 0, 0)], "id, common, surprising, very_surprising, levels"))
def lexical_surprise(spark, sf_dir):
    c = parsers.lexical_surprise(F.col("t"))
    return frame(spark, [(1, fixtures.SURPRISE), (2, "")], "id int, t string").select("id", *[c[k].alias(k) for k in ("common", "surprising", "very_surprising")], F.size(c["distribution"]).alias("levels"))


@query("SELECT * FROM " + values([("Dodavatel FABBR1xyz a jiná s.r.o.", "FABBR1", "xyz", "s.r.o")], "raw, placeholder, word, leftover"))
def fragmentation(spark, sf_dir):
    c = parsers.fragmentation(F.col("raw"), F.col("source"))
    rows = frame(spark, [("Dodavatel FABBR1xyz a jiná s.r.o.", "Dodavatel Alfa s.r.o.")], "raw string, source string")
    return rows.select("raw", F.explode(c["glued"]).alias("g"), F.array_join(c["leftover"], "|").alias("leftover")).select("raw", "g.placeholder", "g.word", "leftover")


@query("SELECT * FROM " + values([(1, "PER", "João"), (1, "LOC", "Lisboa"), (2, "PER", "Maria da Silva"), (3, "ORG", "Casa de Lisboa")], "id, type, text"))
def romance_names(spark, sf_dir):
    rows = frame(spark, [(1, "PER", "osoba", "João de Lisboa"), (2, "PER", "osoba", "Maria da Silva"), (3, "ORG", "organizace", "Casa de Lisboa")], "id int, type string, label string, text string")
    return parsers.split_romance(rows).select("id", "type", "text")


# ---------------------------------------------------------------- relations


@query(
    """WITH s AS (SELECT l_orderkey AS doc_id, l_linenumber AS start, CAST(l_quantity AS INTEGER) AS length FROM lineitem)
    SELECT DISTINCT * FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.doc_id = a.doc_id AND b.start <= a.start AND b.start + b.length >= a.start + a.length AND b.length > a.length)"""
)
def maximal_spans(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("start"), F.col("l_quantity").cast("int").alias("length"))
    return relations.maximal_spans(rows).distinct()


@query("SELECT * FROM " + values([(1, "Jan  Novák", "osoba"), (1, "Brno", "město/obec"), (2, "Alfa", "firma/společnost")], "doc_id, original, label"))
def classified_originals(spark, sf_dir):
    originals = frame(spark, [(1, "Jan  Novák"), (1, "Brno"), (1, "nic"), (2, "Alfa")], "doc_id int, original string")
    entities = frame(spark, [(1, 1, "novák", "osoba"), (1, 2, "Město Brno", "město/obec"), (1, 3, "jan novák ml.", "jiné"), (2, 1, "ALFA", "firma/společnost")], "doc_id int, n int, text string, label string")
    return relations.classify(originals, entities)


CODES = [*sorted(lists.LANGUAGES), "sk", "xx"]


@query(
    f"""WITH l(c) AS (SELECT unnest([{', '.join(map(q, CODES))}])), r AS (SELECT a.c AS src, b.c AS tgt, m AS dm FROM l a, l b, (SELECT unnest([true, false]) AS m)),
    n AS (SELECT *, CASE src WHEN 'sk' THEN 'cs' ELSE src END AS s, CASE tgt WHEN 'sk' THEN 'cs' ELSE tgt END AS t FROM r),
    d(p) AS (SELECT unnest([{', '.join(map(q, lists.DIRECTIONS))}])),
    w AS (SELECT *, CASE WHEN dm THEN 'doc-' ELSE '' END || s || '-' || t AS pair FROM n),
    x AS (SELECT *, CASE WHEN s NOT IN ({', '.join(map(q, sorted(lists.LANGUAGES)))}) OR t NOT IN ({', '.join(map(q, sorted(lists.LANGUAGES)))}) THEN 'unknown_language'
      WHEN pair IN (SELECT p FROM d) THEN 'direct' WHEN s <> 'en' AND t <> 'en' AND s || '-en' IN (SELECT p FROM d) AND 'en-' || t IN (SELECT p FROM d) THEN 'pivot' ELSE 'unsupported' END AS status FROM w)
    SELECT src, tgt, t AS target, CASE status WHEN 'direct' THEN pair WHEN 'pivot' THEN s || '->en->' || t END AS pair, status = 'pivot' AS pivot, dm AND status = 'direct' AS document_mode, status FROM x"""
)
def translate_route(spark, sf_dir):
    rows = [(a, b, m) for a in CODES for b in CODES for m in (True, False)]
    return relations.route(frame(spark, rows, "src string, tgt string, document_mode boolean"))
