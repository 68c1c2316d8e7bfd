"""Rewrites of masked text. The text is read once into tokens (words, placeholders, blanks, signs), each step is a change
of that list, and what a step must know of the source is whether some tokens follow one another there.

Names of towns that were cut in two are joined, connectors stuck to a placeholder go, persons in names of institutions
and public names come back, institutions swallow the rest of their name, and names that recognition tends to miss (middle
names, facilities, firms beside a legal form) get placeholders of their own."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from ..plans import catalog, lists, prefilter

# Legal forms at home, legal forms abroad, and stems of words for facilities.
HOME_FORMS = ("s.r.o.", "sr.o.", "a.s.", "spol. s r.o.", "k.s.", "v.o.s.", "družstvo", "SE")
FOREIGN_FORMS = (
    "SARL", "S.A.R.L.", "SAS", "S.A.S.", "EURL", "GmbH", "AG", "KG", "KGaA", "OHG", "UG", "Ltd", "LLC", "Inc", "Corp", "Co.", "LLP", "PLC",
    "S.r.l.", "S.p.A.", "Srl", "SpA", "S.L.", "S.A.U.", "SL", "SLU", "Sp. z o.o.",
)
OTHER_FORMS = ("SA", "S.A.", "SE", "Co", "LP")
FACILITY = re.compile(
    r"věznic(?:e|i|í)|nemocnic(?:e|i|í)|klinik(?:a|e|y|ou)|úřad(?:u|em)?|ministerstv(?:o|í|u|e|m)|ústav(?:u|em)?|institut(?:u|em)?"
    r"|školk(?:a|e|y)?|gymnázi(?:a|i|u)",
    re.IGNORECASE,
)
# Words before and after a public name, and windows in characters and words.
GRANT_HEADS = frozenset(("Grant", "Projekt", "Project", "Program", "Programme"))
BUSINESS = frozenset(("pojišťovna", "banka", "spořitelna", "kasa", "kampelička"))
INDEX = ("Author ID", "Author", "Editor", "Reviewer", "ID", "Profile", "Number", "Index", "Database", "Citation")
GRANT_AGENCIES = frozenset(("GA", "TA", "AZV", "AV"))
GRANT_TAILS = lists.GRANT_SUFFIXES | {"AV ČR"}
BEFORE_CHARS, SOURCE_WORDS, RUN, WORDS_AFTER = 30, 5, 5, 3

_known = lru_cache(maxsize=1)(lists.default_names)


@lru_cache(maxsize=1)
def _scanner() -> re.Pattern:
    return re.compile(rf"(?P<mark>\b(?:{'|'.join(catalog.prefixes())})\d+)|(?P<word>\w+)|(?P<blank>\s+)|(?P<sign>.)", re.DOTALL)


@dataclass(slots=True)
class Token:
    kind: str
    text: str

    @property
    def prefix(self) -> str:
        return self.text.rstrip("0123456789") if self.kind == "mark" else ""

    @property
    def named(self) -> bool:
        """A word as names are written: one capital, then small letters."""
        return self.kind == "word" and len(self.text) > 1 and self.text[0].isupper() and self.text[1:].islower() and self.text.isalpha()


def tokens(text: str) -> list[Token]:
    return [Token(m.lastgroup, m[0]) for m in _scanner().finditer(text)]


def _solid(text: str) -> list[str]:
    """Its words and signs in lower case."""
    return [t.text.lower() for t in tokens(text) if t.kind != "blank"]


class Sheet:
    """A masked text under rewriting: its tokens, its replacements and the source."""

    def __init__(self, text: str, rows: list[dict], source: str, names: frozenset[str] | None = None):
        self.tokens, self.rows, self.source = tokens(text), list(rows), source
        self.names = _known() if names is None else names
        self._flow: list[str] | None = None

    @property
    def text(self) -> str:
        return "".join(t.text for t in self.tokens)

    @property
    def flow(self) -> list[str]:
        """Words and signs of the source in lower case."""
        if self._flow is None:
            self._flow = _solid(self.source)
        return self._flow

    def originals(self) -> dict[str, str]:
        """Original of each placeholder; the first row that names it counts."""
        out: dict[str, str] = {}
        for r in self.rows:
            if r.get("placeholder") and r.get("original"):
                out.setdefault(r["placeholder"], r["original"])
        return out

    def spots(self, *parts: str) -> Iterator[int]:
        """Where in the flow these parts stand one after another."""
        want = [x for p in parts for x in _solid(p)]
        if not want:
            return
        flow, at = self.flow, -1
        while want[0] in flow[at + 1 :]:
            at = flow.index(want[0], at + 1)
            if flow[at : at + len(want)] == want:
                yield at

    def has(self, *parts: str) -> bool:
        return next(self.spots(*parts), None) is not None

    def near(self, at: int, step: int = 1) -> int:
        """Place of the next (or previous) token beyond one blank, or -1."""
        far = at + 2 * step
        ok = 0 <= far < len(self.tokens) and self.tokens[at + step].kind == "blank"
        return far if ok else -1

    def cut(self, begin: int, end: int, *instead: Token) -> None:
        self.tokens[begin:end] = instead

    def fresh(self, prefix: str, kind: str, source: str):
        """A giver of new placeholders after the greatest there is, the same for the same name."""
        numbers = [int(n) for r in self.rows if (n := r.get("placeholder", "").removeprefix(prefix)).isdigit()]
        top = max(numbers, default=0)
        seen: dict[str, Token] = {}

        def give(name: str) -> Token:
            key = name.lower()
            if key not in seen:
                seen[key] = Token("mark", f"{prefix}{top + len(seen) + 1}")
                self.rows.append({"original": name, "placeholder": seen[key].text, "type": kind, "source": source})
            return seen[key]

        return give


# ---------------------------------------------------------------- public names


def _form(text: str) -> str:
    """A legal form without dots and blanks."""
    return re.sub(r"[.\s]", "", text).lower()


_HOME = {_form(f) for f in HOME_FORMS}


def _peeled(name: str) -> Iterator[str]:
    """What is left of a name without a grant word before it, a legal form, a business word or an index word after it."""
    words = name.split()
    if len(words) > 1 and words[0] in GRANT_HEADS:
        yield " ".join(words[1:])
    for k in range(1, len(words)):
        if _form(" ".join(words[k:])) in _HOME:
            yield " ".join(words[:k]).rstrip(",").strip()
            break
    if len(words) > 1 and words[-1].lower() in BUSINESS:
        yield " ".join(words[:-1])
    if len(words) > 2 and words[-1].lower() == "družstvo" and words[-2].lower().startswith("úvěrov"):
        yield " ".join(words[:-2])
    for tail in INDEX:
        if name.endswith(" " + tail):
            yield name[: -len(tail) - 1].strip()
            break


def is_kept_name(text: str, names: frozenset[str] | None = None) -> bool:
    """Whether a text is a public name, as it is or once its additions are peeled off, a list of such, or an ISSN."""
    names = _known() if names is None else names
    s = text.strip()
    todo, seen = [s] if s else [], set()
    while todo:
        now = todo.pop()
        if now in names:
            return True
        if now not in seen:
            seen.add(now)
            todo += [p for p in _peeled(now) if p]
    parts = [p.strip() for p in re.split("[,;]", s) if p.strip()]
    listed = len(parts) > 1 and all(p in names or p in lists.GRANT_SUFFIXES for p in parts)
    return listed or re.fullmatch(r"ISSN\s+\d{4}-\d{3}[\dX]", s) is not None


# ---------------------------------------------------------------- steps


def join_towns(s: Sheet) -> None:
    """Town, connector, town (and town) that the source has as one name become the first placeholder."""
    of, towns, at = s.originals(), ("MESTO", "ENTITA"), 0
    while at < len(s.tokens):
        link = s.near(at) if s.tokens[at].prefix in towns else -1
        second = s.near(link) if link > 0 and s.tokens[link].text in lists.CONNECTORS else -1
        if second > 0 and s.tokens[second].prefix in towns:
            third = s.near(second)
            ends = [third] if third > 0 and s.tokens[third].prefix in towns else []
            for end in [*ends, second]:
                marks = [s.tokens[at], *(s.tokens[k] for k in (second, third) if second <= k <= end)]
                parts = [of.get(m.text, "") for m in marks]
                if all(parts) and s.has(parts[0], s.tokens[link].text, *parts[1:]):
                    s.cut(at + 1, end + 1)
                    break
        at += 1


def drop_glued_connectors(s: Sheet) -> None:
    """A connector stuck to the end of a placeholder goes."""
    kinds = ("MESTO", "ENTITA", "OSOBA", "REGION", "STAT", "INSTITUCE")
    for at in range(len(s.tokens) - 2, 0, -1):
        stuck = s.tokens[at].kind == "word" and s.tokens[at].text.lower() in lists.CONNECTORS
        if stuck and s.tokens[at - 1].prefix in kinds and (s.tokens[at + 1].kind == "blank" or s.tokens[at + 1].text in ".,;)"):
            s.cut(at, at + 1)


def _institution_before(s: Sheet, at: int, names: list[str], of: dict[str, str]) -> bool:
    """Whether a run of persons belongs to the name of an institution: one stands before it in the same sentence, or the
    source has a word for one shortly before these names."""
    near, k = "", at
    while k and len(near) < BEFORE_CHARS:
        k -= 1
        near = s.tokens[k].text + near
        if re.search(r"[.!?\n]", s.tokens[k].text):
            return False
        if s.tokens[k].prefix == "INSTITUCE" and len(near) <= BEFORE_CHARS:
            return any(w in of.get(s.tokens[k].text, "").lower() for w in lists.INSTITUTION_WORDS) or _in_source(s, names)
    return _in_source(s, names)


def _in_source(s: Sheet, names: list[str]) -> bool:
    if not all(names):
        return False
    for spot in s.spots(names[0]):
        end, whole = spot + len(_solid(names[0])), True
        for name in names[1:]:
            # the next name follows, at most one word apart
            step = next((k for k in s.spots(name) if end <= k <= end + 1), None)
            whole, end = step is not None, (step or 0) + len(_solid(name))
            if not whole:
                break
        words = [w for w in s.flow[:spot] if w[0].isalnum()][-SOURCE_WORDS:]
        if whole and lists.INSTITUTION_WORDS.intersection(words):
            return True
    return False


def restore_institution_persons(s: Sheet) -> None:
    """Two to five persons in a row that are part of an institution's name become their originals again."""
    of, at = s.originals(), 0
    while at < len(s.tokens):
        run = [at] if s.tokens[at].prefix == "OSOBA" else []
        while run and len(run) < RUN:
            after = s.near(run[-1])
            if after > 0 and s.tokens[after].text == "z":
                after = s.near(after)
            if after < 0 or s.tokens[after].prefix != "OSOBA":
                break
            run.append(after)
        if len(run) > 1 and _institution_before(s, at, [of.get(s.tokens[k].text, "") for k in run], of):
            for k in run:
                s.tokens[k] = Token("word", of.get(s.tokens[k].text, s.tokens[k].text))
        at = run[-1] + 1 if run else at + 1


def restore_public_names(s: Sheet) -> None:
    """Public names and words that only introduce an identifier come back, and so does what follows a grant agency."""
    of = {p: o.strip() for p, o in s.originals().items()}
    public = {p for p, o in of.items() if is_kept_name(o, s.names) or o in lists.LEAD_WORDS}
    tails = {"STAT", "INSTITUCE", "ENTITA", "OSOBA", "FIRMA", "MESTO"}
    for at, t in enumerate(s.tokens):
        if t.text in public:
            s.tokens[at] = Token("word", of[t.text])
            continue
        after = s.near(at)
        if after < 0 or s.tokens[after].prefix not in tails or of.get(s.tokens[after].text) not in GRANT_TAILS:
            continue
        agency = of.get(t.text, "") if t.prefix == "FIRMA" else t.text
        if t.prefix == "FIRMA" and agency.split(" ")[-1] in ("GA", "TA") or t.kind == "word" and agency in GRANT_AGENCIES:
            s.tokens[at], s.tokens[after] = Token("word", agency), Token("word", of[s.tokens[after].text])


def extend_institutions(s: Sheet) -> None:
    """Names after an institution that the source has as part of its name go into its placeholder."""
    of, at = s.originals(), 0
    while at < len(s.tokens):
        own = of.get(s.tokens[at].text, "") if s.tokens[at].prefix == "INSTITUCE" else ""
        words, end = [], at
        while own and len(words) < WORDS_AFTER and (after := s.near(end)) > 0 and s.tokens[after].named:
            words.append(after)
            end = after
        for k in range(len(words), 0, -1):
            if s.has(own, *(s.tokens[w].text for w in words[:k])):
                s.cut(at + 1, words[k - 1] + 1)
                break
        person = s.near(at) if own else -1
        name = of.get(s.tokens[person].text, "") if person > 0 and s.tokens[person].prefix == "OSOBA" else ""
        if name and s.has(own, name):
            s.cut(at + 1, person + 1)
        at += 1


def mask_middle_names(s: Sheet) -> None:
    """A name between two persons is masked, unless it is a particle."""
    give = s.fresh("OSOBA", "osoba (middle name)", "wrapper-postprocess-middle")
    for at, t in enumerate(s.tokens):
        before, after = s.near(at, -1), s.near(at)
        if t.named and before >= 0 and after > 0 and s.tokens[before].prefix == s.tokens[after].prefix == "OSOBA" and t.text.lower() not in lists.PARTICLES:
            s.tokens[at] = give(t.text)


def mask_facilities(s: Sheet) -> None:
    """One or two names after a word for a facility are masked as a place."""
    give, at = s.fresh("MESTO", "místo (facility)", "wrapper-postprocess-facility"), 0
    while at < len(s.tokens):
        first = s.near(at) if s.tokens[at].kind == "word" and FACILITY.fullmatch(s.tokens[at].text) else -1
        if first > 0 and s.tokens[first].named and s.tokens[first].text.lower() not in lists.NOT_FACILITIES:
            second = s.near(first)
            end = second if second > 0 and s.tokens[second].named else first
            s.cut(first, end + 1, give(" ".join(t.text for t in s.tokens[first : end + 1] if t.kind == "word")))
            at = first
        at += 1


def _joined_back(s: Sheet, at: int, fits, most: int) -> list[int]:
    """Begins of the runs of fitting words, joined by a blank or a hyphen, that end before `at`, longest first."""
    begins, k = [], at
    while len(begins) < most and k > 0 and fits(s.tokens[k - 1]):
        k -= 1
        begins.append(k)
        if k and (s.tokens[k - 1].kind == "blank" or s.tokens[k - 1].text == "-"):
            k -= 1
        else:
            break
    return begins[::-1]


def _capital(t: Token) -> bool:
    return t.kind == "word" and t.text[0].isupper() and (len(t.text) == 1 or t.text.isalpha())


def _loud(t: Token) -> bool:
    return t.kind == "word" and t.text[0].isupper() and t.text == t.text.upper()


def mask_firm_heads(s: Sheet) -> None:
    """A placeholder for a bare legal form takes the name before it, if the source has that name."""
    bare = {_form(f) for f in (*HOME_FORMS, *FOREIGN_FORMS, *OTHER_FORMS)}
    forms = {p: o.strip() for p, o in s.originals().items() if p.startswith("FIRMA") and _form(o) in bare}
    give, at = s.fresh("FIRMA", "firma (compound)", "wrapper-postprocess-firma"), 0
    while at < len(s.tokens):
        if s.tokens[at].text in forms and s.near(at, -1) >= 0:
            for begin in _joined_back(s, at - 1, _capital, 6):
                name = "".join(t.text for t in s.tokens[begin : at - 1])
                if name in s.source:
                    s.cut(begin, at + 1, give(f"{name} {forms[s.tokens[at].text]}"))
                    at = begin
                    break
        at += 1


@lru_cache(maxsize=1)
def _foreign() -> dict[str, list[list[str]]]:
    """Legal forms abroad as tokens, by the first, longest first."""
    out: dict[str, list[list[str]]] = {}
    for form in sorted(FOREIGN_FORMS, key=len, reverse=True):
        own = [t.text for t in tokens(form) if t.kind != "blank"]
        out.setdefault(own[0], []).append(own)
    return out


def mask_foreign_firms(s: Sheet) -> None:
    """Names in capitals before a legal form abroad are masked with it, public names excepted."""
    give, at = s.fresh("FIRMA", "firma (international)", "wrapper-postprocess-firma-intl"), 0
    while at < len(s.tokens):
        for form in _foreign().get(s.tokens[at].text, ()) if s.near(at, -1) >= 0 else ():
            end, k = at, 0
            while end < len(s.tokens) and k < len(form) and (s.tokens[end].text == form[k] or s.tokens[end].kind == "blank" and k):
                k += s.tokens[end].text == form[k]
                end += 1
            begins = _joined_back(s, at - 1, _loud, 4) if k == len(form) else []
            name = "".join(t.text for t in s.tokens[begins[0] : at - 1]) if begins else ""
            if name and not is_kept_name(name, s.names):
                s.cut(begins[0], end, give(name + " " + "".join(t.text for t in s.tokens[at:end])))
                at = begins[0]
                break
        at += 1


STEPS = (
    join_towns, drop_glued_connectors, restore_institution_persons, restore_public_names, extend_institutions, mask_middle_names, mask_facilities,
    mask_firm_heads, mask_foreign_firms,
)
HOLDS = re.compile(r"[A-Z]\d")


@lru_cache(maxsize=1)
def _guards() -> dict:
    """What must be in a text for a step to do anything; all others need a placeholder."""
    whole = lambda t: re.escape(t) + (r"\b" if re.fullmatch(r"\w+", t) else "")
    forms = [r"\s*".join(map(whole, form)) for own in _foreign().values() for form in own]
    places = prefilter.needs(FACILITY.pattern, True)[0]
    return {
        mask_facilities: lambda t: any(w in low for low in (prefilter.folded(t),) for w in places),
        mask_foreign_firms: re.compile(rf"\s(?:{'|'.join(forms)})").search,
        None: re.compile(rf"\b(?:{'|'.join(catalog.prefixes())})\d").search,
    }


def rewrite(text: str, rows: list[dict], source: str, names: frozenset[str] | None = None) -> tuple[str, list[dict]]:
    """All steps in order. Tokens are made when the first step has something to do."""
    sheet, guards = None, _guards()
    marked = HOLDS.search(text) and guards[None](text)
    for step in STEPS:
        if guards[step](sheet.text if sheet else text) if step in guards else marked:
            sheet = sheet or Sheet(text, rows, source, names)
            step(sheet)
    return (sheet.text, sheet.rows) if sheet else (text, list(rows))
