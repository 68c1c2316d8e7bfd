"""Languages of many documents: the cascade of functions.language over word tables instead of repeated scans.

A marker without a space lies within one word, so its count in a text is the sum of its counts in the text's words. Each
worker remembers the counts of every word it has seen as one row of small numbers; a text is then one sum over rows. The
few markers that span a space are scanned in the text itself, and only if a word is there that can begin one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language as L

KEPT = 200_000
_flat = lambda p: p.replace("\n", "")
WORDS = [(n, _flat(p), True) for n, _, p in L.MARKERS] + [("slovak_words", _flat(L.SLOVAK_WORDS), True), ("czech_tags", _flat(L.CZECH_TAGS), True)]
CHARS = [(f"{n}_letters", p, False) for n, p in L.LETTERS.items()] + [
    ("czech_letters", L.CZECH_LETTERS, False), ("slovak_letters", L.SLOVAK_LETTERS, False), ("vietnamese", L.VIETNAMESE, False), ("estonian_letters", L.ESTONIAN, False),
    ("romanian_letters", L.ROMANIAN, False), ("north", L.SCANDINAVIAN, False), ("turkish", L.TURKISH, False), ("latin", L.TWO_LATIN, False),
]
#: Ends of words that can begin a marker with a space in it.
HEADS = {
    "slovak": r"\b(?:nie|rodné)(?=\x00|$)",
    "slovak_words": r"(?:\bvyjadr\w+|\bBratislav\w+|\bMestský|ovan[áéý]|sledovan[áéýou]|\w{4,}om|\b(?:máj|jún|júl|august|január|február|marec|apríl|október|december|november))(?=\x00|$)",
    "czech_tags": r"(?:\bdatová|\bsp\.|\bspol\.|\bspol\.\s*s|\bkorun|\bkrajský|\bokresní|\bměstský|\bnejvyšší|\bústavní|\bvrchní)(?=\x00|$)",
}
NAMES = [n for n, *_ in WORDS + CHARS]
AT = {n: i for i, n in enumerate(NAMES)}
SCRIPTS = [(n, re.compile(p)) for n, p in L.SCRIPTS]
ANY_SCRIPT = re.compile("|".join(p for _, p in L.SCRIPTS))


@lru_cache(maxsize=1)
def _compiled():
    return [re.compile(p, re.IGNORECASE if i else 0) for _, p, i in WORDS + CHARS], {n: re.compile(p, re.IGNORECASE) for n, p in HEADS.items()}


class _Table(dict):
    """Word to its row of counts."""

    def __init__(self):
        self.rows = np.zeros((4096, len(NAMES) + len(HEADS)), dtype=np.int32)

    def learn(self, words: list[str]) -> None:
        """Count the markers of new words, all words in one scan for each marker; the joint is no part of any word."""
        n, m = len(self), len(words)
        while n + m > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        self.update(zip(words, range(n, n + m)))
        text = "\0".join(words)
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        patterns, heads = _compiled()
        for k, p in enumerate([*patterns, *heads.values()]):
            at = [x.start() for x in p.finditer(text)]
            if at:
                self.rows[n : n + m, k] = np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=m)


_table = _Table()


def prepare(texts: list[str]) -> None:
    """Learn the words of a batch of texts."""
    global _table
    new = set().union(*(t.split() for t in texts)).difference(_table)
    if len(_table) + len(new) > KEPT and len(_table):
        _table = _Table()
        new = set().union(*(t.split() for t in texts))
    _table.learn([w for w in new if w])


def counts(text: str) -> np.ndarray:
    """Counts of all markers of a text, in the order of NAMES."""
    words = text.split()
    if not all(map(_table.__contains__, words)):
        prepare([text])
    if not words:
        return np.zeros(len(NAMES), dtype=np.int64)
    at = np.fromiter(map(_table.__getitem__, words), dtype=np.int64, count=len(words))
    total = _table.rows[at].sum(axis=0, dtype=np.int64)
    out, patterns = total[: len(NAMES)], _compiled()[0]
    for k, name in enumerate(HEADS):
        if total[len(NAMES) + k]:
            out[AT[name]] = len(patterns[AT[name]].findall(text))
    return out


def language_of(text: str | None) -> str | None:
    """Language of one text, as functions.language.detect_language."""
    if text is None:
        return None
    if ANY_SCRIPT.search(text):
        return next(n for n, p in SCRIPTS if p.search(text))
    c = counts(text)
    n = lambda name: int(c[AT[name]])
    letters, strong, czech = n("slovak_letters"), n("slovak_words"), n("czech_letters")
    if (letters >= 3 or letters and strong >= 3 or not letters and strong >= 4) and czech <= 2 * max(letters, strong):
        return "slovak"
    if n("vietnamese") >= 2:
        return "vietnamese"
    if n("estonian_letters"):
        return "estonian"
    if n("romanian_letters") >= 2:
        return "romanian"
    if n("north"):
        return max(L.SCANDINAVIANS, key=n)
    if n("turkish"):
        return "turkish"
    scores = {}
    for name, least, _ in L.MARKERS:
        boost = 3 * n(f"{name}_letters") if name in L.LETTERS else 0
        if n(name) >= least or boost >= 6:
            scores[name] = n(name) + boost
    if czech or n("czech_tags"):
        scores["czech"] = max(3 * czech, 5 * n("czech_tags"))
    return max(scores, key=scores.get) if scores else "czech" if n("latin") else "unknown"


def detect_languages(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and language of every row; null for null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                prepare([t for t in texts if t])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([language_of(t) for t in texts], pa.string())], names=[key, "language"])

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, language string")
