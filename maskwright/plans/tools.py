"""The query API: one function for each request, from documents to results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language, text as texts
from ..operators import audit as audits
from ..operators import mask as masks
from ..sources.providers import FAILED, Provider, extract_entities, guarded, provided
from . import lists


def anonymize(
    df: DataFrame,
    options: masks.Options = masks.Options(),
    audit: bool = True,
    strict_audit: bool = False,
    threshold: str = "high",
    recognition: Provider | None = None,
    masking: Provider | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """key, status, anonymized, replacements, occurrences, warnings, skipped, count, sources, leaks, leak_summary.

    Refused texts keep their status and have null results. With a recognition provider, its entities are masked too; each
    distinct text is sent once and joined back by its digest, so null and repeated keys are as good as any. With a masking
    provider, what it takes is masked under the document's numbers. Where a provider fails, the rest still counts and a
    warning says so."""
    checked = df.select(F.col(key), *[c.alias(n) for n, c in texts.validated(F.col("text")).items()])
    rows = checked.withColumnRenamed("clean", "text").withColumn("failed", F.lit(None).cast("string"))
    column = masker = None
    if recognition:
        rows = rows.drop("failed").withColumn("_text", F.sha2("text", 256))
        found = extract_entities(rows.filter("status is null").select("_text", "text").dropDuplicates(["_text"]), recognition, "_text")
        lists_ = found.groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("entity", "type", "label", "text"))).alias("e"))
        ours = F.transform(F.filter("e", lambda e: e["type"] != FAILED), lambda e: F.struct(e["type"].alias("type"), e["label"].alias("label"), e["text"].alias("text")))
        message = F.element_at(F.transform(F.filter("e", lambda e: e["type"] == FAILED), lambda e: e["text"]), 1)
        rows = rows.join(lists_.select("_text", ours.alias("entities"), F.when(F.exists("e", lambda e: e["type"] == FAILED), message).alias("failed")), "_text", "left")
        column = "entities"
    if masking:
        masking = guarded(df.sparkSession, "masking", masking)
        masker = lambda t: masking([t])[0]
    rows = rows.withColumn("_row", F.struct(F.col(key).alias("key"), "status", "failed"))
    done = masks.counted(masks.mask(rows, "_row", "text", options, column, masker))
    said = F.when(F.col("_row.failed").isNotNull(), F.array(F.concat(F.lit("recognition failed: "), F.col("_row.failed"))))
    warnings = F.when(F.col("warnings").isNotNull(), F.concat("warnings", F.coalesce(said, F.array().cast("array<string>"))))
    done = done.select(F.col("_row.key").alias(key), F.col("_row.status").alias("status"), "anonymized", "replacements", "occurrences", warnings.alias("warnings"), "skipped", "count", "sources")
    if audit or strict_audit:
        done = audits.audit(done, threshold, replacements="replacements" if options.keep_mapping else None)
        done = audits.strict(done) if strict_audit else done
        done = done.withColumn("leak_summary", audits.summary(F.col("leaks")))
    return done


def detect_language(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return df.select(key, language.detect_language(F.col("text")).alias("language"))


def correct(df: DataFrame, mode: str = "strip", spelling: Provider | None = None, key: str = "doc_id") -> DataFrame:
    """key, corrected, model, changed; `strip` needs no provider."""
    model = lists.SPELL_MODELS.get(mode, mode)
    if mode == "strip":
        done = df.select(key, "text", texts.strip_diacritics(F.col("text")).alias("corrected"))
    else:
        if spelling is None:
            raise ValueError(f"mode {mode} needs a spelling provider")
        packed = df.select(F.struct(F.col(key).alias("key"), "text").alias("_row"), "text")
        done = provided(packed, spelling, "string", "_row", model=model, service="spelling").select(F.col("_row.key").alias(key), F.col("_row.text").alias("text"), F.col("result").alias("corrected"))
    return done.select(key, "corrected", F.lit(model).alias("model"), (F.col("corrected") != F.col("text")).alias("changed"))


def translate(df: DataFrame, translation: Provider, key: str = "doc_id") -> DataFrame:
    """(key, text, src, tgt, document_mode) to routes with translated; a text over English takes two calls."""
    from ..operators.relations import route

    # one row for each pair of languages asked for and mode; joined plainly, so that none need be broadcast
    mode = F.coalesce(F.col("document_mode"), F.lit(False))
    pairs = df.select("src", "tgt").distinct()
    routes = [route(pairs.withColumn("document_mode", F.lit(m))).select("src", "tgt", "pair", "pivot", "status", F.lit(m).alias("_mode")) for m in (True, False)]
    wanted = df.withColumn("_mode", mode).join(routes[0].unionByName(routes[1]), ["src", "tgt", "_mode"]).filter("status in ('direct', 'pivot')")
    packed = wanted.select(F.struct(F.col(key).alias("key"), "src", "tgt", "pair", "pivot").alias("_row"), F.to_json(F.struct("pair", "text")).alias("text"))
    got = provided(packed, translation, "string", "_row", service="translation")
    return got.select(F.col("_row.key").alias(key), "_row.src", "_row.tgt", "_row.pair", "_row.pivot", F.col("result").alias("translated"), "error")
