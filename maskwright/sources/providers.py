"""Providers of what no column expression can compute: recognition, morphology, readability, spelling, translation.

A provider turns a batch of texts into a batch of results on an executor. None is bundled: the default of every kind
raises, and tests inject stubs. Remote providers share the retry rule and the egress guard."""

from __future__ import annotations

import hashlib
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("recognition", "morphology", "readability", "spelling", "translation", "masking")
#: Kinds whose providers may send texts off the machine: all. A provider that does not says so by an attribute `local`.
REMOTE = frozenset(KINDS)
LOCAL_MODE, OVERRIDE = "spark.maskwright.local", "spark.maskwright.local.override"
FAILED = "provider-error"
ATTEMPTS, FIRST_WAIT = 4, 1.0
#: Answers after which a call is tried again.
RETRIED = frozenset({429, 502, 503, 504})


class NotConfigured(RuntimeError):
    """No provider of this kind was given."""


class EgressRefused(RuntimeError):
    """Local mode does not let this kind of provider run."""


class Transient(Exception):
    """A failure that may pass: a timeout, a lost connection or one of the RETRIED answers."""


class Provider(Protocol):
    def __call__(self, texts: list[str], **options: Any) -> list[Any]: ...


def missing(kind: str) -> Provider:
    def refuse(texts: list[str], **options: Any) -> list[Any]:
        raise NotConfigured(f"no provider of {kind} is configured")

    return refuse


@dataclass
class Providers:
    """One provider of each kind."""

    by_kind: dict[str, Provider] = field(default_factory=dict)
    local: bool = False
    override: bool = False

    @classmethod
    def of(cls, spark: SparkSession, **by_kind: Provider) -> Providers:
        true = lambda k: (spark.conf.get(k, "") or "").strip().lower() in ("1", "true", "yes", "on")
        return cls(by_kind, true(LOCAL_MODE), true(OVERRIDE))

    def get(self, kind: str) -> Provider:
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind}")
        provider = self.by_kind.get(kind, missing(kind))
        if self.local and kind in REMOTE and not self.override and not getattr(provider, "local", False):
            raise EgressRefused(f"{kind} would send texts off this machine; local mode refuses that")
        return provider


def guarded(spark: SparkSession, kind: str, provider: Provider) -> Provider:
    """The provider, if the session's mode lets it run; every request asks here before any text is read."""
    return Providers.of(spark, **{kind: provider}).get(kind)


def own(provider: Provider) -> Provider:
    """The provider, marked as one that keeps texts on this machine."""
    provider.local = True
    return provider


def retried(call: Callable[[], Any], attempts: int = ATTEMPTS, wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep) -> Any:
    """The call's result; transient failures are tried again after waits that double. Other failures pass at once."""
    for n in range(attempts):
        try:
            return call()
        except Transient:
            if n + 1 == attempts:
                raise
            sleep(wait * 2**n)
    raise AssertionError


def http_json(url: str, fields: dict[str, str], result: str = "result", text_field: str = "data", timeout: float = 120.0) -> Provider:
    """A provider that posts each text as a form and takes a field of the JSON answer; result None takes the whole body.

    Redirects are not followed. Timeouts, lost connections and the RETRIED answers are tried again."""
    import json
    import urllib.error
    import urllib.parse
    import urllib.request

    class Straight(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, *args, **kwargs):
            return None

    def post(text: str) -> str:
        data = urllib.parse.urlencode(fields | {text_field: text}).encode()
        try:
            with urllib.request.build_opener(Straight).open(urllib.request.Request(url, data), timeout=timeout) as r:
                return r.read().decode()
        except urllib.error.HTTPError as e:
            if e.code in RETRIED:
                raise Transient(str(e)) from e
            raise
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            raise Transient(str(e)) from e

    def provide(texts: list[str], **options: Any) -> list[Any]:
        bodies = [retried(lambda t=t: post(t)) for t in texts]
        return bodies if result is None else [json.loads(b).get(result) for b in bodies]

    return provide


def checked_file(paths: list[str], sha256: str | None = None) -> str:
    """The first path that exists, given through the environment or listed; its digest must fit if one is given."""
    for path in filter(None, [os.environ.get("MASKWRIGHT_MODEL"), *paths]):
        if os.path.isfile(path):
            if sha256:
                with open(path, "rb") as f:
                    found = hashlib.file_digest(f, "sha256").hexdigest()
                if found != sha256:
                    raise ValueError(f"{path} has another digest than expected")
            return path
    raise FileNotFoundError("no model file was found")


def provided(df: DataFrame, provider: Provider, kind: str, key: str = "doc_id", text: str = "text", batch: int = 64, service: str | None = None, **options: Any) -> DataFrame:
    """key, result (of SQL type `kind`) and error of every row; a failing batch gives its message, not a failed query.

    The key may be a struct of all that should go along, so nothing need be joined back. A null text is not sent and has a
    null result. With `service`, the egress guard is asked for that kind of provider."""
    if service:
        provider = guarded(df.sparkSession, service, provider)
    own = df.schema[key].dataType.simpleString()
    arrow = pa.schema(_arrow(df.sparkSession, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                texts = part.column(1).to_pylist()
                sent = [i for i, t in enumerate(texts) if t is not None]
                results, errors = [None] * len(texts), [None] * len(texts)
                try:
                    for i, r in zip(sent, provider([texts[i] for i in sent], **options)):
                        results[i] = r
                except (Transient, OSError, TimeoutError) as e:
                    for i in sent:
                        errors[i] = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(results, arrow.field(0).type), pa.array(errors, pa.string())], names=[key, "result", "error"])

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"`{key}` {own}, result {kind}, error string")


def _arrow(spark: SparkSession, kind: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    t = spark.createDataFrame([], f"r {kind}").schema[0].dataType
    return [pa.field("r", to_arrow_type(t))]


def extract_entities(df: DataFrame, provider: Provider, key: str = "doc_id", text: str = "text", fix_romance: bool = True) -> DataFrame:
    """Entities of a provider that returns two-column token lists: key, entity, type, label, text, tokens, nested.

    Where the provider failed, there is one row of type FAILED whose text is the message. Keys should differ."""
    from ..operators.parsers import conll_entities, split_romance

    got = provided(df, provider, "string", key, text, service="recognition")
    lines = F.when(F.col("error").isNotNull(), F.concat(F.regexp_replace("error", r"\s+", " "), F.lit(f"\tB-{FAILED}\n"))).otherwise(F.col("result"))
    found = conll_entities(got.withColumn("conll", lines), key)
    return split_romance(found) if fix_romance else found


def analyze_morphology(df: DataFrame, provider: Provider, key: str = "doc_id", text: str = "text", include_parse: bool = False, include_ranges: bool = False) -> DataFrame:
    """Tokens of a provider that returns ten-column sentences; heads and ranges only if asked for."""
    from ..operators.parsers import conllu_tokens

    tokens = conllu_tokens(provided(df, provider, "string", key, text, service="morphology").withColumnRenamed("result", "conllu"), key)
    return tokens.drop(*([] if include_parse else ["head", "deprel"]), *([] if include_ranges else ["token_range"]))


def morphology_counts(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    return tokens.groupBy(key).agg(F.count("*").alias("token_count"), F.countDistinct("sentence").alias("sentence_count"))


def check_readability(df: DataFrame, provider: Provider, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Readability of a provider that returns a JSON object with the fields stats, app1_features, app1_rule_info,
    app2_colours, app3_colours and result: measures, lexical surprise and speech acts as columns. The rules are rows of
    operators.parsers.activated_rules over the columns features and rule_info."""
    from ..operators.parsers import lexical_surprise, speech_acts, stats

    names = ("stats", "app1_features", "app1_rule_info", "app2_colours", "app3_colours", "result")
    got = provided(df, provider, "string", key, text, service="readability").withColumn("r", F.from_json("result", "struct<" + ",".join(f"{n}:string" for n in names) + ">"))
    measures, words = stats(F.col("r.stats")), lexical_surprise(F.col("r.app2_colours"))
    return got.select(
        key, "error", *[c.alias(n) for n, c in measures.items()], *[c.alias(n) for n, c in words.items()],
        speech_acts(F.col("r.app3_colours")).alias("speech_acts"), F.col("r.app1_features").alias("features"), F.col("r.app1_rule_info").alias("rule_info"), F.col("r.result").alias("highlighted_html"),
    )
