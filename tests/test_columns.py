"""Column functions, detectors, audit, providers and streams."""

from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from maskwright.functions import language, text as texts
from maskwright.operators import audit, detect, languages, mask, parsers, relations
from maskwright.plans import catalog, fixtures, tools
from maskwright.sources import io, providers
from maskwright.streaming import mask as stream


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, t {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("t"))).collect()]


def test_validation(spark):
    values = ["ok", "", "  \n", None, "a" * 500_001, "a" * 100_001, "N\x00ov​ák", "　"]
    assert column(spark, values, texts.status) == [None, "empty", "blank", "missing", "too_large", None, None, "blank"]
    c = texts.validated(F.col("t"))
    row = spark.createDataFrame([(values[6],)], "t string").select(*[v.alias(k) for k, v in c.items()]).first()
    assert (row.clean, row.n_control, row.n_invisible, row.n_private, row.large) == ("Novák", 1, 1, 1, False)


def test_normalization(spark):
    values = ["a​b­c", "‮abc‬", "é", "١٢٣ ४५", None, "", "plain"]
    c = texts.normalized(F.col("t"))
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", *[v.alias(k) for k, v in c.items()]).orderBy("i").collect()
    assert [r.text for r in rows] == ["abc", "abc", "é", "123 45", None, "", "plain"]
    assert [r.zw_stripped for r in rows] == [2, 0, 0, 0, None, 0, 0] and rows[1].bidi_stripped == 2 and rows[2].nfc_changed == 1 and rows[3].digits_normalized == 5
    off = texts.normalized(F.col("t"), digits=False, nfc_on=False)
    assert column(spark, ["é ١"], lambda _: off["text"]) == ["é ١"]
    summary = texts.normalization_summary(F.lit(2), F.lit(0), F.lit(1), F.lit(3))
    assert spark.range(1).select(summary).first()[0] == "Input normalization: 2 zero-width chars stripped; NFC normalization applied (1 chars); 3 non-Latin digits → ASCII"


def test_diacritics(spark):
    for t in ("Příliš žluťoučký kůň", "Škoda ñ ü ő ß", "é"):
        want = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
        assert column(spark, [t], texts.strip_diacritics) == [want]


def test_small_functions(spark):
    assert column(spark, ["王伟", "a b", "田 中", None], texts.is_cjk) == [True, False, False, False]
    assert column(spark, ["Ing.", "doc.  Ing.,", "Ing. Novák", "", None], texts.is_title) == [True, True, False, False, False]
    assert column(spark, ["45274649", "45274648", "x", None], texts.valid_ico) == [True, False, False, False]
    assert spark.range(1).select(texts.rgb_hex(F.lit(255), F.lit(16), F.lit(None).cast("int"))).first()[0] == "#ff1000"
    assert column(spark, [["a", ".", "(", "b", ")"], ["田", "中"], []], parsers.smart_join, "array<string>") == ["a. (b)", "田中", ""]


def as_python(t):
    """The cascade once more, over plain regular expressions."""
    for name, chars in language.SCRIPTS:
        if re.search(chars, t):
            return name
    n = lambda p, words=True: len(re.findall(p.replace("\n", ""), t, re.I if words else 0))
    letters, words, czech = n(language.SLOVAK_LETTERS, False), n(language.SLOVAK_WORDS), n(language.CZECH_LETTERS, False)
    if (letters >= 3 or letters >= 1 and words >= 3 or letters == 0 and words >= 4) and czech <= 2 * max(letters, words):
        return "slovak"
    for name, chars, least in (("vietnamese", language.VIETNAMESE, 2), ("estonian", language.ESTONIAN, 1), ("romanian", language.ROMANIAN, 2)):
        if n(chars, False) >= least:
            return name
    if n(language.SCANDINAVIAN, False):
        north = {k: n(p) for k, _, p in language.MARKERS if k in language.SCANDINAVIANS}
        return max(north, key=north.get)
    if n(language.TURKISH, False):
        return "turkish"
    scores = {}
    for name, least, p in language.MARKERS:
        boost = 3 * n(language.LETTERS[name], False) if name in language.LETTERS else 0
        if n(p) >= least or boost >= 6:
            scores[name] = n(p) + boost
    if czech or n(language.CZECH_TAGS):
        scores["czech"] = max(3 * czech, 5 * n(language.CZECH_TAGS))
    return max(scores, key=scores.get) if scores else "czech" if re.search(language.TWO_LATIN, t) else "unknown"


def test_language(spark):
    values = [t for t, _ in fixtures.LANGUAGES] + ["Tôi yêu tiếng Việt đẹp", "Bu şehir çok güzel ışık", "Să mergem și să vedem țara", "Egy kutya és a magyar nyelv, őszinte űr", "Het is niet waar, zij heeft een zaak tegen", "x", "Ing. Novák s.r.o."]
    assert column(spark, values, language.detect_language) == [as_python(t) for t in values]
    assert column(spark, [t for t, _ in fixtures.LANGUAGES], language.detect_language) == [x for _, x in fixtures.LANGUAGES]
    assert column(spark, [None], language.detect_language) == [None]
    values += ["Mestský súd v Bratislave II rozhodol, človekom bol, máj 1999, rodné číslo nie je", "krajský soud sp.\nzn. 1 a spol. s r.o. korun českých", "a\x00b nie", "", None]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")
    found = {r.doc_id: r.language for r in languages.detect_languages(rows).collect()}
    assert [found[i] for i in range(len(values))] == [None if t is None else as_python(t) for t in values]


def test_detectors_read_patterns_like_the_masker(spark):
    texts_ = [t for _, t, _ in fixtures.MASKING if t] + ["čOP 123456789, ičo: 45274649", "Škoda a@b.cz", "tel. +420 777 123 456", "नमस्ते 10.0.0.1", "OP č. 12345678"]
    rows = detect.detect(spark.createDataFrame(list(enumerate(texts_)), "doc_id int, text string")).collect()
    found = {(r.doc_id, r.rule, r.start, r.value) for r in rows}
    want = set()
    for i, t in enumerate(texts_):
        for n, rule in enumerate(catalog.ALL):
            flags = (re.IGNORECASE if rule.ignore_case else 0) | (re.MULTILINE if rule is catalog.SECTION_ITEM else 0)
            for m in re.finditer(rule.pattern, t, flags):
                g = 2 if rule.mode == "value" else 0
                if rule.mode != "ico" or catalog.valid_ico(m[0]):
                    want.add((i, n, m.start(g), m[g].strip()))
    assert found == want


def test_audit(spark):
    rows = spark.createDataFrame([(1, "EMAIL1 a a@b.cz, 123-45-6789, 12345678901", ["x"]), (2, "a@b.cz", ["a@b.cz"]), (3, None, None), (4, "čistý text", None)], "doc_id int, anonymized string, o array<string>")
    rows = rows.withColumn("replacements", F.transform("o", lambda x: F.struct(x.alias("original"))))
    out = {r.doc_id: r.leaks for r in audit.audit(rows, "medium").collect()}
    assert [(x.pattern, x.severity, x.position) for x in out[1]] == [("US SSN format", "critical", 12), ("e-mail address", "high", 4), ("11-12 digit block (potential national ID)", "medium", 25)]
    assert out[2] == [] and out[3] is None and out[4] == []
    line = audit.audit(rows.filter("doc_id = 1"), "critical").select(audit.summary(F.col("leaks"))).first()[0]
    assert line == "Audit detected residual PII patterns in anonymized output: CRITICAL: 1× — US SSN format='123-45-6789'"
    with pytest.raises(Exception, match="residual PII"):
        audit.strict(audit.audit(rows)).collect()
    assert len(audit.strict(audit.audit(rows.filter("doc_id = 4"))).collect()) == 1


def test_mask_keeps_the_mapping_out(spark):
    df = spark.createDataFrame([(1, "a@b.cz"), (None, None)], "doc_id long, text string")
    rows = mask.mask(df, options=mask.Options(keep_mapping=False)).collect()
    assert sorted(repr(r.anonymized) for r in rows) == ["'EMAIL1'", "None"] and all(r.replacements is None and r.occurrences is None for r in rows)
    assert [tuple(r) for r in mask.mapping(mask.mask(df)).collect()] == [(1, "a@b.cz", "EMAIL1", "e-mail", "wrapper-regex")]


def test_anonymize(spark):
    df = spark.createDataFrame([(1, "Eva Malá, a@b.cz ١٢٣"), (2, ""), (3, None)], "doc_id long, text string")

    def recognise(batch, **_):
        return ["Eva\tB-P\nMalá\tI-P\n" if "Eva" in t else "" for t in batch]

    out = {r.doc_id: r for r in tools.anonymize(df, recognition=recognise).collect()}
    assert out[1].anonymized == "OSOBA1, EMAIL1 123" and out[1]["count"] == 2 and out[1].sources["wrapper-regex"] == 1 and out[1].leak_summary == ""
    assert out[2].anonymized is None and out[3].anonymized is None
    assert [out[k].status for k in (1, 2, 3)] == [None, "empty", "missing"]


def test_anonymize_by_any_key(spark):
    """Null and repeated keys get their own entities; each distinct text is sent once."""
    rows = [(None, "Eva Malá"), (None, "Jan Nový"), (1, "Eva Malá"), (1, "Jan Nový a Eva Malá"), (1, "Eva Malá")]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def recognise(batch, **_):
        assert len(set(batch)) == len(batch)
        return ["".join(f"{a}\tB-P\n{b}\tI-P\n.\tO\n" for a, b in (("Eva", "Malá"), ("Jan", "Nový")) if a in t) for t in batch]

    out = sorted(repr((r.doc_id, r.anonymized)) for r in tools.anonymize(df, recognition=recognise).collect())
    assert out == sorted(map(repr, [(None, "OSOBA1"), (None, "OSOBA1"), (1, "OSOBA1"), (1, "OSOBA2 a OSOBA1"), (1, "OSOBA1")]))


def test_anonymize_says_what_failed(spark):
    df = spark.createDataFrame([(1, "Eva, a@b.cz"), (2, None)], "doc_id long, text string")

    def down(batch, **_):
        raise TimeoutError("too late")

    rows = {r.doc_id: r for r in tools.anonymize(df, recognition=down, masking=down).collect()}
    assert rows[1].anonymized == "Eva, EMAIL1" and rows[2].anonymized is None
    assert [w for w in rows[1].warnings if "recognition failed: TimeoutError: too late" in w] and [w for w in rows[1].warnings if "masking provider failed" in w]


def test_anonymize_with_a_masking_provider(spark):
    df = spark.createDataFrame([(1, "Eva Malá ve státu Brno a@b.cz")], "doc_id long, text string")

    def masker(batch, **_):
        return [t.replace("Eva Malá", "Jana_[Eva Malá]").replace("státu", "Uni_[státu]").replace("Brno", "Praha_[Brno]") for t in batch]

    def recognise(batch, **_):
        return ["Brno\tB-gu\n" for _ in batch]

    plain = tools.anonymize(df, mask.Options(fallback=False), masking=masker).first()
    assert plain.anonymized == "ENTITA1 ve státu ENTITA2 EMAIL1" and plain.sources["wrapper-placeholder"] == 2
    kinds = tools.anonymize(df, mask.Options(fallback=False, classify=True), recognition=recognise, masking=masker).first()
    assert kinds.anonymized == "ENTITA1 ve státu MESTO1 EMAIL1"
    every = tools.anonymize(df, mask.Options(fallback=False, rewrite=False, stop_words=None), masking=masker).first()
    assert every.anonymized == "ENTITA1 ve ENTITA2 ENTITA3 EMAIL1"


def test_local_mode_lets_nothing_out(spark):
    df = spark.createDataFrame([(1, "Eva")], "doc_id long, text string")
    echo = lambda batch, **_: list(batch)
    spark.conf.set(providers.LOCAL_MODE, "true")
    try:
        for request in (
            lambda: tools.anonymize(df, recognition=echo), lambda: tools.anonymize(df, masking=echo), lambda: tools.correct(df, "spellcheck", echo),
            lambda: providers.extract_entities(df, echo), lambda: providers.analyze_morphology(df, echo), lambda: providers.check_readability(df, echo),
            lambda: tools.translate(df.selectExpr("*", "'cs' src", "'en' tgt", "false document_mode"), echo),
        ):
            with pytest.raises(providers.EgressRefused):
                request()
        assert tools.anonymize(df, masking=providers.own(lambda batch, **_: list(batch))).first().anonymized == "Eva"
    finally:
        spark.conf.unset(providers.LOCAL_MODE)


def test_marks_beyond_one_character():
    """More distinct values than single private characters."""
    marks = mask.Marks(mask.SECOND_MARK)
    made = [marks.make(f"v{k}") for k in range(3 * mask.SINGLE)]
    assert len(set(made)) == len(made) and marks.open(" ".join(made[::7]) + "".join(made[:90_000:11])) == " ".join(f"v{k}" for k in range(0, 3 * mask.SINGLE, 7)) + "".join(f"v{k}" for k in range(0, 90_000, 11))
    assert ord(max(max(made))) <= mask.LAST_MARK and mask.FIRST_MARK + mask.SINGLE + mask.LEADS <= mask.SECOND_MARK


def test_stop_lists(spark):
    df = spark.createDataFrame([("Soudu,",), ("Novák",), ("USA.",), (None,)], "w string")
    assert sorted(map(repr, (r.w for r in relations.not_listed(df, "w", relations.lists.STOP_WORDS).collect()))) == ["'Novák'", "'USA.'", "None"]
    assert [r.w for r in relations.listed(df, "w", relations.lists.KEPT_TOKENS).collect()] == ["USA."]
    assert column(spark, ["CZ/SK", "CZ/Novák", "CZ", "/"], relations.is_slash_list) == [True, False, False, False]


def test_providers(spark):
    with pytest.raises(providers.NotConfigured):
        providers.Providers().get("spelling")(["x"])
    with pytest.raises(providers.EgressRefused):
        providers.Providers(local=True).get("translation")
    local = providers.own(lambda batch, **_: batch)
    assert providers.Providers({"recognition": local}, local=True).get("recognition") is local
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise providers.Transient
        return "done"

    assert providers.retried(flaky, sleep=waits.append) == "done" and waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        providers.retried(lambda: int("x"))

    def upper(batch, **_):
        if any("boom" in t for t in batch):
            raise TimeoutError("late")
        return [t.upper() for t in batch]

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "boom")], "doc_id long, text string").repartition(1)
    rows = {r.doc_id: (r.result, r.error) for r in providers.provided(df, upper, "string", batch=1).collect()}
    assert rows == {1: ("A", None), 2: (None, None), 3: (None, "TimeoutError: late")}


def test_model_file(tmp_path):
    import hashlib

    (tmp_path / "m").write_bytes(b"model")
    assert providers.checked_file([str(tmp_path / "m")], hashlib.sha256(b"model").hexdigest()).endswith("m")
    with pytest.raises(ValueError):
        providers.checked_file([str(tmp_path / "m")], "0" * 64)
    with pytest.raises(FileNotFoundError):
        providers.checked_file([str(tmp_path / "none")])


def test_correct_and_translate(spark):
    df = spark.createDataFrame([(1, "kůň"), (2, "kun")], "doc_id long, text string")
    assert [(r.corrected, r.changed) for r in tools.correct(df).orderBy("doc_id").collect()] == [("kun", True), ("kun", False)]
    asked = spark.createDataFrame([(1, "x", "de", "cs", False), (2, "y", "hi", "cs", False), (3, "z", "cs", "en", True)], "doc_id long, text string, src string, tgt string, document_mode boolean")
    rows = {r.doc_id: r.pair for r in tools.translate(asked, lambda batch, **_: batch).collect()}
    assert rows == {1: "de->en->cs", 3: "doc-cs-en"}
    again = spark.createDataFrame([(None, "x", "cs", "en", True), (None, "y", "cs", "en", False), (7, "y", "cs", "en", None), (7, "y", "cs", "en", None)], asked.schema)
    found = sorted(repr((r.doc_id, r.pair, r.translated)) for r in tools.translate(again, lambda batch, **_: batch).collect())
    assert len(found) == 4 and sum("doc-cs-en" in f for f in found) == 1
    assert sorted(repr(r.doc_id) for r in tools.correct(again, "spellcheck", lambda batch, **_: [t + "!" for t in batch]).filter("changed").collect()) == ["7", "7", "None", "None"]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i, f"pište u{i}@b.cz") for i in range(20)], "doc_id long, text string")
    df.repartition(4).write.parquet(f"{tmp_path}/in")
    done = stream.masked_stream(stream.read_stream(spark, f"{tmp_path}/in", max_files=2))
    stream.write_stream(done, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    batch = audit.audit(mask.mask(df))
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/out").select("doc_id", "anonymized").collect())) == sorted(map(repr, batch.select("doc_id", "anonymized").collect()))


def test_masking_provider():
    def masker(t):
        return t.replace("Novák", "Jan_[Novák]").replace("státu", "UniAlfa_[státu]")

    out = mask.mask_document("pan Novák, státu, a@b.cz", masker=masker)
    assert out["anonymized"] == "pan OSOBA1, státu, EMAIL1" and len(out["warnings"]) == 1
    assert {r["source"] for r in out["replacements"]} == {"wrapper-regex", "wrapper-placeholder"}

    def down(t):
        raise TimeoutError

    out = mask.mask_document("a@b.cz", masker=down)
    assert out["anonymized"] == "EMAIL1" and "failed" in out["warnings"][0]


def test_form_posts(tmp_path):
    import http.server
    import threading
    import urllib.parse

    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            data = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            seen.append(data)
            self.send_response(503 if len(seen) == 1 else 404 if data["data"] == ["bad"] else 200)
            self.end_headers()
            self.wfile.write(b'{"result": "' + data["data"][0].upper().encode() + b'"}')

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        call = providers.http_json(f"http://127.0.0.1:{server.server_port}/", {"model": "m"})
        assert call(["x"]) == ["X"] and len(seen) == 2 and seen[0]["model"] == ["m"]
        with pytest.raises(OSError):
            call(["bad"])
        assert len(seen) == 3
    finally:
        server.shutdown()


def test_readability_and_morphology(spark):
    import json

    df = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    answer = json.dumps({"stats": fixtures.STATS, "app1_features": fixtures.RULE_HTML, "app1_rule_info": fixtures.RULES, "app2_colours": fixtures.SURPRISE, "app3_colours": '{"colours": {"01": "#aaa"}}', "result": "<b>"})
    rows = providers.check_readability(df, lambda batch, **_: [answer for _ in batch])
    one = {r.doc_id: r for r in rows.collect()}
    assert one[1].metrics["ARI"].value == "9.5" and one[1].common == 7 and one[1].speech_acts == {"01": "#aaa"} and one[2].metrics is None
    assert [(r.id, r["count"]) for r in parsers.activated_rules(rows).orderBy("rank").collect()] == [("b2", 1), ("a1", 2)]
    tokens = providers.analyze_morphology(df, lambda batch, **_: [fixtures.CONLLU for _ in batch])
    assert "head" not in tokens.columns and [tuple(r) for r in providers.morphology_counts(tokens).collect()] == [(1, 3, 2)]


def test_sources(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("a@b.cz\nx")
    rows = io.read_text_files(spark, f"{tmp_path}/t").collect()
    assert rows[0].text == "a@b.cz\nx" and rows[0].doc_id.endswith("a.txt")
    spark.createDataFrame([(1, "x", "en")], "id long, body string, lang string").write.parquet(f"{tmp_path}/p")
    read = io.read_documents(spark, f"{tmp_path}/p", "id", "body")
    assert read.columns == ["doc_id", "text", "lang"] and io.spread(read).count() == 1
    io.write_masked(mask.mask(read), f"{tmp_path}/m", f"{tmp_path}/map")
    assert "replacements" not in spark.read.parquet(f"{tmp_path}/m").columns and spark.read.parquet(f"{tmp_path}/map").count() == 0


def test_normalized_against_the_standard_library(spark):
    """Plain texts, soft hyphens, characters that combine, digits of other scripts (first plane only) and null."""
    given = [None, "", "plain 42", "so\u00adft", "e\u0301 \u0664\u200b2 \u202ea\u0301\u202c", "\u00e9 \u0663", "\U0001d7d8 x"]

    def want(t):
        t = unicodedata.normalize("NFC", re.sub("[\u200b-\u200f\u2060\ufeff\u180e\u00ad\u202a-\u202e\u2066-\u2069]", "", t))
        return "".join(str(unicodedata.decimal(c, c)) if ord(c) < 0x10000 else c for c in t)

    assert column(spark, given, lambda t: texts.normalized(t)["text"]) == [None if t is None else want(t) for t in given]
