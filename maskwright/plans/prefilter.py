"""What a text must hold for a pattern to match at all, read off the pattern: cheap tests before costly scans."""

from __future__ import annotations

import re
from functools import lru_cache

try:
    from re import _constants as C
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as C
    import sre_parse as parser


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    """Of two needed sets the one whose shortest word is longer."""
    worth = lambda s: -1 if s is None else min(map(len, s))
    return a if worth(a) >= worth(b) else b


def _digits_only(items) -> bool:
    return all(op is C.CATEGORY and v is C.CATEGORY_DIGIT or op is C.RANGE and v[0] >= 48 and v[1] <= 57 or op is C.LITERAL and 48 <= v <= 57 for op, v in items)


def _sequence(tree, fold=str.lower) -> tuple[frozenset[str] | None, bool]:
    """(words of which one must occur, whether a digit must); `fold` makes words comparable."""
    needed, digit, run = None, False, ""
    for op, v in tree:
        if op is C.LITERAL:
            run += chr(v)
            digit |= 48 <= v <= 57
            continue
        if run:
            needed, run = _better(needed, frozenset([fold(run)])), ""
        if op is C.SUBPATTERN:
            inner = _sequence(v[3], fold)
        elif op is C.BRANCH:
            arms = [_sequence(a, fold) for a in v[1]]
            words = [a[0] for a in arms]
            inner = (frozenset().union(*words) if all(w is not None for w in words) else None, all(a[1] for a in arms))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and v[0] > 0:
            inner = _sequence(v[2], fold)
        elif op is C.IN:
            inner = (None, _digits_only(v))
        else:
            inner = (None, False)
        needed, digit = _better(needed, inner[0]), digit or inner[1]
    if run:
        needed = _better(needed, frozenset([fold(run)]))
    return needed, digit


@lru_cache(maxsize=1024)
def needs(pattern: str, ignore_case: bool = False) -> tuple[tuple[str, ...], bool]:
    """(words in lower case of which one must occur, or none; whether a digit must occur)."""
    words, digit = _sequence(parser.parse(pattern, re.IGNORECASE if ignore_case else 0))
    return tuple(sorted(words or ())), digit


def _wordy(op, v) -> bool:
    """Whether a one-character item matches nothing but word characters."""
    if op is C.LITERAL:
        return chr(v).isalnum() or v == 95
    if op is not C.IN:
        return False
    inside = lambda k, x: all(chr(c).isalnum() for c in range(x[0], x[1] + 1)) if k is C.RANGE else x in (C.CATEGORY_DIGIT, C.CATEGORY_WORD) if k is C.CATEGORY else _wordy(k, x)
    return all(inside(k, x) for k, x in v)


def _run(tree) -> int:
    """Least length of the longest stretch of word characters that every match has."""
    best = now = 0
    for op, v in tree:
        if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue
        if _wordy(op, v):
            now += 1
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and len(v[2]) == 1 and _wordy(*v[2][0]):
            now += v[0]
        else:
            best, now = max(best, now), 0
            if op is C.SUBPATTERN:
                best = max(best, _run(v[3]))
            elif op is C.BRANCH:
                best = max(best, min(map(_run, v[1])))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and v[0] > 0:
                best = max(best, _run(v[2]))
    return max(best, now)


Want = tuple[tuple[str, ...], bool, int, bool]


@lru_cache(maxsize=1024)
def wanted(pattern: str, ignore_case: bool = False) -> Want:
    """needs(), how many word characters must follow one another somewhere (0 if fewer than LONG), and whether case counts:
    then the words are as the pattern has them."""
    tree = parser.parse(pattern, re.IGNORECASE if ignore_case else 0)
    run, exact = _run(tree), not ignore_case and not re.search(r"\(\?[a-z]*i", pattern)
    words, digit = _sequence(tree, str if exact else str.lower)
    return tuple(sorted(words or ())) if len(words or ()) <= MANY else (), digit, run if run >= LONG else 0, exact


#: More words than this cost as much as the pattern itself.
MANY = 85
#: Stretches of word characters that are rare enough in prose to be worth a test.
LONG = 16
_STRETCH = re.compile(rf"\b\w{{{LONG},}}")


def folded(text: str) -> str:
    """Text in lower case as far as case-blind matching goes."""
    return text.lower().replace("ſ", "s").replace("ı", "i")


class Screen:
    """Tests of one text against wants. Masking only takes text away, so one screen serves a whole document."""

    def __init__(self, text: str):
        self.text, self.low = text, folded(text)
        self.digit = re.search(r"\d", text) is not None
        self.run = max(map(len, _STRETCH.findall(text)), default=0)

    def admits(self, want: Want) -> bool:
        words, digit, run, exact = want
        if run > self.run or digit and not self.digit:
            return False
        text = self.text if exact else self.low
        for w in words:
            if w in text:
                return True
        return not words
