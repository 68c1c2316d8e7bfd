"""Column functions on text: validation, normalization, diacritics, small lookups. All but NFC run in the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import lists

MAX_BYTES, WARN_BYTES = 500_000, 100_000
#: Private-use characters that the masker may use itself.
PRIVATE = "[\ue100-\ue400]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
INVISIBLE = "[\u200b-\u200d\u2060\ufeff]"
ZERO_WIDTH = "[\u200b-\u200d\u2060\ufeff\u180e\u00ad]"
BIDI = "[\u202a-\u202e\u2066-\u2069\u200e\u200f]"


@lru_cache(maxsize=1)
def digit_table() -> tuple[str, str]:
    """Every decimal digit of the first Unicode plane beyond ASCII, and the ASCII digit it stands for."""
    found = [(chr(c), str(unicodedata.digit(chr(c)))) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(a for a, _ in found), "".join(b for _, b in found)


@lru_cache(maxsize=1)
def latin_marks() -> tuple[str, str]:
    """Letters of the Latin blocks whose decomposition is a letter and marks, and that letter."""
    found = []
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(c))
        if len(base) > 1 and all(unicodedata.combining(m) for m in base[1:]):
            found.append((chr(c), base[0]))
    return "".join(a for a, _ in found), "".join(b for _, b in found)


# ---------------------------------------------------------------- validation


def status(text: Column) -> Column:
    """null for a fit text, else why it is refused: missing, empty, blank or too large."""
    return (
        F.when(text.isNull(), "missing")
        .when(F.octet_length(text) == 0, "empty")
        .when(F.regexp_like(text, F.lit(r"(?U)^[\s\x1c-\x1f]*$")), "blank")
        .when(F.octet_length(text) > MAX_BYTES, "too_large")
    )


def validated(text: Column) -> dict[str, Column]:
    """Columns status, large, clean, and counts of the control, invisible and private characters taken out of clean.

    A refused text has no clean text. The counts follow the order of removal, so none counts a character twice."""
    bad = status(text)
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, CONTROL, ""), INVISIBLE, ""), PRIVATE, "")
    fit = lambda c: F.when(bad.isNull(), c)
    return {
        "status": bad,
        "n_bytes": F.octet_length(text),
        "large": fit(F.octet_length(text) > WARN_BYTES),
        "n_control": fit(F.regexp_count(text, F.lit(CONTROL))),
        "n_invisible": fit(F.regexp_count(text, F.lit(INVISIBLE))),
        "n_private": fit(F.regexp_count(text, F.lit(PRIVATE))),
        "clean": fit(clean),
    }


# ---------------------------------------------------------------- normalization


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column, far: Column | None = None) -> Column:
    """Canonical composition; only texts with characters that can combine leave the JVM, for the others a null does."""
    far = _far(text) if far is None else far
    return F.when(far, _nfc(F.when(far, text))).otherwise(text)


def _far(text: Column) -> Column:
    """Whether a text has characters that can combine, or digits beyond ASCII, which all lie further up."""
    return F.regexp_like(text, F.lit("[^\\x00-\u02ff]"))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, *digit_table())


def normalized(text: Column, nfc_on: bool = True, zero_width: bool = True, bidi: bool = True, digits: bool = True) -> dict[str, Column]:
    """Columns text and the counts zw_stripped, bidi_stripped, nfc_changed (difference in length), digits_normalized.

    The steps run in this order; each can be turned off, and then counts nothing."""
    zero = F.when(text.isNotNull(), F.lit(0))
    length = lambda a, b: F.length(a) - F.length(b)
    a = F.regexp_replace(text, ZERO_WIDTH, "") if zero_width else text
    b = F.regexp_replace(a, BIDI, "") if bidi else a
    far = _far(text)  # taken from the text itself, so that plain texts pay for no later step
    c = nfc(b, far) if nfc_on else b
    d = F.when(far, ascii_digits(c)).otherwise(b) if digits else c
    marked = F.translate(c, digit_table()[0], "")
    return {
        "text": d,
        "zw_stripped": length(text, a) if zero_width else zero,
        "bidi_stripped": length(a, b) if bidi else zero,
        "nfc_changed": F.abs(length(b, c)) if nfc_on else zero,
        "digits_normalized": length(c, marked) if digits else zero,
    }


def normalization_summary(zw: Column, bidi: Column, changed: Column, digits: Column) -> Column:
    """One line on what normalization did, null if nothing."""
    said = [
        (zw, "", " zero-width chars stripped"),
        (bidi, "", " bidi override chars stripped"),
        (changed, "NFC normalization applied (", " chars)"),
        (digits, "", " non-Latin digits → ASCII"),
    ]
    parts = F.concat_ws("; ", *[F.when(n > 0, F.concat(F.lit(a), n.cast("string"), F.lit(z))) for n, a, z in said])
    return F.when(parts != "", F.concat(F.lit("Input normalization: "), parts))


def strip_diacritics(text: Column) -> Column:
    """Latin letters without their marks; the text is composed first."""
    return F.translate(nfc(text), *latin_marks())


def collapsed(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


# ---------------------------------------------------------------- small functions

CJK_CHARS = "[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\\x{20000}-\\x{2a6df}]"


def is_cjk(text: Column) -> Column:
    """At least one Han or kana character and no space."""
    return F.coalesce(~F.contains(text, F.lit(" ")) & F.regexp_like(text, F.lit(CJK_CHARS)), F.lit(False))


def is_title(text: Column) -> Column:
    """Nothing but academic or professional titles."""
    tokens = F.split(F.lower(F.rtrim(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(",;:"))), " ")
    return F.coalesce((F.trim(text) != "") & F.forall(tokens, lambda t: t.isin(*sorted(lists.TITLES))), F.lit(False))


def valid_ico(digits: Column) -> Column:
    """Whether a string of eight digits carries its mod-11 check digit."""
    weighted = sum((F.substring(digits, i + 1, 1).cast("int") * (8 - i) for i in range(1, 7)), F.substring(digits, 1, 1).cast("int") * 8)
    good = F.substring(digits, 8, 1).cast("int") == F.pmod(F.lit(11) - F.pmod(weighted, F.lit(11)), F.lit(11)) % 10
    return F.when(F.regexp_like(digits, F.lit("^[0-9]{8}$")), good).otherwise(False)


def rgb_hex(red: Column, green: Column, blue: Column) -> Column:
    return F.format_string("#%02x%02x%02x", *[F.coalesce(c, F.lit(0)).cast("int") for c in (red, green, blue)])


def lookup(key: Column, table: dict[str, str], default: Column | None = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.element_at(pairs, key), key if default is None else default)


def type_label(tag: Column) -> Column:
    return lookup(tag, lists.TYPE_LABELS)


def recognition_model(model: Column, language: Column) -> Column:
    """Name of the recognition model: by language for auto, by alias, else as given."""
    auto = F.when(language.isin("czech", "slovak"), lists.MODEL_CZECH).otherwise(lists.MODEL_MULTI)
    return F.when(model == "auto", auto).otherwise(lookup(model, lists.MODEL_ALIASES))


def morphology_model(model: Column, language: Column) -> Column:
    return F.when(model == "auto", F.when(language == "unknown", "czech").otherwise(language)).otherwise(model)


def is_kept_name(text: Column, names: frozenset[str] | None = None) -> Column:
    """Whether a text is a public name, also after a grant word, before a legal form, a business word or an index word,
    in a list of such names, or an ISSN."""
    known = sorted(names if names is not None else lists.default_names())
    s = F.trim(text)
    bare = F.regexp_replace(s, r"^(?:Grant|Projekt|Project|Program|Programme)\s+", "")
    form = r",?\s*(?:a\.?\s*s\.?|s\.?\s*r\.?\s*o\.?|spol\.?\s*s\s*r\.?\s*o\.?|k\.?\s*s\.?|v\.?\s*o\.?\s*s\.?|družstvo|SE)\s*\.?$"
    short = r",?\s*(?:a\.?\s*s\.?|s\.?\s*r\.?\s*o\.?)\s*\.?$"
    firm = F.trim(F.regexp_replace(s, form, ""))
    business = F.trim(F.regexp_replace(F.when(firm != "", firm).otherwise(s), r"(?iu)\s+(?:pojišťovna|banka|spořitelna|kasa|kampelička|úvěrov[\p{L}\d_]+\s+družstvo)$", ""))
    index = F.trim(F.regexp_replace(s, r"\s+(?:Author(?:\s+ID)?|Editor|Reviewer|ID|Profile|Number|Index|Database|Citation)$", ""))
    bare_firm = F.trim(F.regexp_replace(bare, short, ""))
    parts = F.filter(F.split(s, r"[,;]\s*"), lambda p: F.trim(p) != "")
    listed = (F.size(parts) >= 2) & F.forall(parts, lambda p: F.trim(p).isin(*known, *sorted(lists.GRANT_SUFFIXES)))
    hit = s.isin(*known)
    for c in (bare, firm, business, index, bare_firm):
        hit = hit | c.isin(*known)
    return F.coalesce((s != "") & (hit | listed | F.regexp_like(s, F.lit(r"^ISSN\s+[0-9]{4}-[0-9]{3}[0-9X]$"))), F.lit(False))


# ---------------------------------------------------------------- kind of a replacement

# Kinds told by the shape of a placeholder, then by the words before it.
BY_SHAPE = [
    (r"^FABBR[0-9]+$", "firma/společnost"), (r"^IABBR[0-9]+$", "úřad/instituce"), (r"^AABBR[0-9]+$", "úřad/instituce"),
    (r"^UABBR[0-9]+$", "URL/web"), (r"^EABBR[0-9]+$", "e-mail"), (r"^Uni[A-ZÁ-Ž][A-Za-zÁ-ž]*$", "úřad/instituce"),
    (r"^CZ[0-9]+$", "DIČ"), (r"^[A-Z]{3}\s[0-9]{4}$", "SPZ"),
]
BY_CONTEXT = [
    (r"PSČ\s*$", "PSČ"), (r"IČO?:?\s*$", "IČO"), (r"DIČ:?\s*$", "DIČ"), (r"č\.\s*j\.\s*$", "číslo jednací"),
    (r"sp\.\s*zn\.\s*:?\s*$", "spisová značka"), (r"\b(telefon|tel\.?|mobil)\s*:?\s*$", "telefon"),
    (r"\bnarozen[áy]?\s*$", "datum narození"), (r"\brodné\s+číslo:?\s*$", "rodné číslo"), (r"\bSPZ:?\s*$", "SPZ"),
    (r"\b(e-?mail|email)\s*:?\s*$", "e-mail"), (r"\b(web|stránka|URL|http[s]?:?)\s*:?\s*$", "URL/web"),
    (r"\bulic[ei]\s*$|\bul\.\s*$", "ulice/náměstí"), (r"\bměst[oě]\s*$", "město/obec"), (r"\b(pan|paní|p\.)\s*$", "osoba"),
    (r"\b(soud|soudce)\s+v\s+$", "město/obec"), (r"\bbytem\s*$", "ulice/náměstí"),
]


def infer_type(placeholder: Column, original: Column, before: Column, label: Column) -> Column:
    """Kind of a replacement: by the placeholder's shape, the words before it, a recognised label, or the original itself."""
    s = F.trim(original)
    digits, n = F.regexp_like(s, F.lit(r"(?U)^\d+$")), F.length(s)
    tests = [(F.regexp_like(placeholder, F.lit(p)), kind) for p, kind in BY_SHAPE] + [(F.regexp_like(before, F.lit("(?iU)" + p)), kind) for p, kind in BY_CONTEXT]
    out = None
    for test, kind in tests:
        out = F.when(test, kind) if out is None else out.when(test, kind)
    rest = (
        F.when(digits & (n == 8), "IČO (předpoklad)")
        .when(digits & (n == 5), "PSČ (předpoklad)")
        .when(digits & (n == 10), "rodné číslo (předpoklad)")
        .when(digits, "číslo")
        .when(F.regexp_like(s, F.lit(r"^[0-9]+\.[0-9]+(\.[0-9]+)?$")), "datum")
        .when(F.regexp_like(s, F.lit("^[A-Za-zÁ-ž]+$")) & (n <= 4), "zkratka/krátký token")
        .otherwise("neznámé")
    )
    return out.when(label.isNotNull() & (label != ""), label).otherwise(rest)


