"""Rewrites of masked text, entities of providers, and the registry of numbers."""

from __future__ import annotations

from maskwright.operators.mask import Options, mask_document
from maskwright.operators.postprocess import Sheet, is_kept_name, rewrite
from maskwright.operators import postprocess as p


def row(placeholder, original, kind="x", source="maskit"):
    return {"original": original, "placeholder": placeholder, "type": kind, "source": source}


def after(step, text, rows, source):
    s = Sheet(text, rows, source)
    step(s)
    return s


def test_towns_are_joined():
    rows = [row("MESTO1", "Lhota"), row("MESTO2", "Červeným"), row("MESTO3", "Kostelcem")]
    assert after(p.join_towns, "z MESTO1 za MESTO2 MESTO3.", rows, "z Lhota za Červeným Kostelcem.").text == "z MESTO1."
    assert after(p.join_towns, "z MESTO1 za MESTO2.", rows, "z Lhota, za Červeným").text == "z MESTO1 za MESTO2."


def test_glued_connector():
    assert after(p.drop_glued_connectors, "ze MESTO1za .", [], "").text == "ze MESTO1 ."


def test_persons_in_institutions_come_back():
    rows = [row("OSOBA1", "Jana"), row("OSOBA2", "Žižky"), row("INSTITUCE1", "Vojenské gymnázium")]
    assert after(p.restore_institution_persons, "INSTITUCE1 OSOBA1 OSOBA2", rows, "Vojenské gymnázium Jana Žižky").text == "INSTITUCE1 Jana Žižky"
    assert after(p.restore_institution_persons, "na ulici OSOBA1 OSOBA2", rows, "na ulici Jana Žižky").text == "na ulici Jana Žižky"
    assert after(p.restore_institution_persons, "pan OSOBA1 OSOBA2", rows, "pan Jana Žižky").text == "pan OSOBA1 OSOBA2"


def test_public_names_come_back():
    rows = [row("INSTITUCE1", "GA ČR"), row("FIRMA1", "Česká spořitelna, a.s."), row("STAT1", "ČR"), row("OSOBA1", "Novák")]
    assert after(p.restore_public_names, "INSTITUCE1, FIRMA1, TA STAT1, OSOBA1", rows, "").text == "GA ČR, Česká spořitelna, a.s., TA ČR, OSOBA1"


def test_institutions_grow():
    rows = [row("INSTITUCE1", "Univerzita"), row("OSOBA1", "Karlova")]
    assert after(p.extend_institutions, "INSTITUCE1 Karlova je", rows, "Univerzita Karlova je").text == "INSTITUCE1 je"
    assert after(p.extend_institutions, "INSTITUCE1 OSOBA1", rows, "Univerzita Karlova").text == "INSTITUCE1"


def test_new_names():
    s = after(p.mask_middle_names, "OSOBA1 Garrigue OSOBA2 a OSOBA1 von OSOBA2", [row("OSOBA1", "Tomáš"), row("OSOBA2", "Masaryk")], "")
    assert s.text == "OSOBA1 OSOBA3 OSOBA2 a OSOBA1 von OSOBA2" and s.rows[-1]["source"] == "wrapper-postprocess-middle"
    assert after(p.mask_facilities, "ve věznici Pankrác a nemocnice Motol Praha", [row("MESTO4", "x")], "").text == "ve věznici MESTO5 a nemocnice MESTO6"
    s = after(p.mask_firm_heads, "dluží BETA Trading FIRMA1", [row("FIRMA1", "s.r.o.")], "dluží BETA Trading s.r.o.")
    assert s.text == "dluží FIRMA2" and s.rows[-1]["original"] == "BETA Trading s.r.o."
    assert after(p.mask_foreign_firms, "ALPHA TECH SARL a ALPHA TECH SARL, HSBC Ltd", [], "").text == "FIRMA1 a FIRMA1, HSBC Ltd"


def test_steps_in_order():
    text, rows = rewrite("INSTITUCE1 Karlova, ALPHA GmbH", [row("INSTITUCE1", "Univerzita")], "Univerzita Karlova, ALPHA GmbH")
    assert text == "INSTITUCE1, FIRMA1" and len(rows) == 2


def test_kept_names():
    assert is_kept_name("Grant GA ČR") and is_kept_name("Generali pojišťovna") and is_kept_name("GA ČR; TA ČR") and not is_kept_name("") and not is_kept_name("Alfa s.r.o.")
    assert is_kept_name("Alfa, a.s.", frozenset({"Alfa"}))


ENTITIES = [
    {"type": "P", "label": "osoba", "text": "Eva Malá"},
    {"type": "if", "label": "firma/společnost", "text": "Beta s . r . o ."},
    {"type": "ps", "label": "příjmení", "text": "Ing."},
    {"type": "gu", "label": "město/obec", "text": "Žádné"},
    {"type": "gc", "label": "stát/země", "text": "CZ/SK"},
    {"type": "PER", "label": "osoba", "text": "王伟"},
    {"type": "T", "label": "datum/čas", "text": "dnes"},
]


def test_entities_of_a_provider():
    text = "Ing. Eva Malá, Beta s. r. o., Žádné CZ/SK, 我叫王伟, dnes eva@b.cz a Eva Maláková"
    out = mask_document(text, Options(strict=True), ENTITIES)
    assert out["anonymized"] == "Ing. OSOBA1, FIRMA1, Žádné CZ/SK, 我叫OSOBA2, dnes EMAIL1 a Eva Maláková"
    assert {r["source"] for r in out["replacements"]} == {"wrapper-regex", "wrapper-strict", "wrapper-nametag-fallback"}


def test_one_registry_for_all_steps():
    out = mask_document("Okresní soud v Opavě a Úřad Alfa", Options(strict=True), [{"type": "io", "label": "úřad/instituce", "text": "Úřad Alfa"}])
    assert out["anonymized"] == "INSTITUCE1 a INSTITUCE2"


def test_options():
    assert mask_document("PESEL: 44051401359", Options(keep_keyword=True))["anonymized"] == "PESEL: PESEL1"
    assert mask_document("a@b.cz", Options(rules=False))["anonymized"] == "a@b.cz"
    assert mask_document("ALPHA GmbH", Options(rewrite=False))["anonymized"] == "ALPHA GmbH"
    assert mask_document(None)["anonymized"] is None and mask_document(" ")["anonymized"] == " "
    assert mask_document("IP1 a@b.cz")["anonymized"] == "IP1 EMAIL1"
    assert mask_document("EMAIL1 EMAIL2 EMAIL3 a@b.cz")["skipped"]
