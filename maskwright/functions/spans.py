"""Places of a pattern's matches in a text column, in code points, from SQL functions only; no step is quadratic in the
matches. Inner steps are SQL text, as that is planned many times faster than columns put together one by one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,val:string>>"
CONTEXT = "array<struct<start:int,end:int,val:string,left:string,right:string>>"
#: Stands between matches and the rest; in a text that holds it, with the text's digest behind it.
SEP = "\uffff"


def let(value: Column, name: str, body: str) -> Column:
    """SQL `body` with `name` for a value that is computed once, however often it is named."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(0))


def let_sql(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def running_sql(values: str, combine: str) -> str:
    """SQL of an int array: for each element, what `combine` of {a} and {b} (associative, with zero) makes of zero and all
    elements before it.

    An array that grows by one costs its length each time, so the scan runs in blocks of about the root of the length:
    within each block, and over the blocks' totals."""
    state = "cast(named_struct('now', 0, 'out', array()) as struct<now:int,out:array<int>>)"

    def scan(x: str) -> str:
        return f"aggregate({x}, {state}, (acc, el) -> named_struct('now', {combine.format(a='acc.now', b='el')}, 'out', concat(acc.out, array(acc.now))))"

    blocks = f"transform(sequence(0, cast((size(vals) - 1) div width as int)), blk -> {scan('slice(vals, blk * width + 1, width)')})"
    totals = scan("transform(done, one -> one.now)")
    whole = let_sql(blocks, "done", f"flatten(zip_with(done, {totals}.out, (one, carry) -> transform(one.out, el -> {combine.format(a='carry', b='el')})))")
    sized = let_sql("cast(ceil(sqrt(size(vals))) as int)", "width", whole)
    return let_sql(values, "vals", f"if(size(vals) > 0, {sized}, cast(array() as array<int>))")


PAIRS = "transform(sequence(0, cast((size(cut) - 3) div 2 as int)), i -> named_struct('p', cut[2 * i], 'f', cut[2 * i + 1], 'q', cut[2 * i + 2]))"
LENGTHS = running_sql("transform(pieces, z -> length(z.p) + length(z.f))", "{a} + {b}")


def _placed(cut: str, near: int) -> str:
    """SQL of the spans in an array whose odd elements are the matches and whose even ones lie between them.

    Running lengths give the offsets."""
    sides = f", 'left', right(z.p, {near}), 'right', left(z.q, {near})" if near else ""
    place = f"named_struct('start', at + length(z.p), 'end', at + length(z.p) + length(z.f), 'val', z.f{sides})"
    return let_sql(cut, "cut", let_sql(PAIRS, "pieces", f"zip_with(pieces, {LENGTHS}, (z, at) -> {place})"))


def _cut(text: Column, pattern: str) -> Column:
    """Pieces and matches in turn, from one pass of the pattern over the text."""
    sep = F.when(F.contains(text, F.lit(SEP)), F.concat(F.lit(SEP), F.sha2(text, 256), F.lit(SEP))).otherwise(F.lit(SEP))
    return F.split(F.regexp_replace(text, F.lit(pattern), F.concat(sep, F.lit("$0"), sep)), sep, -1)


def spans(text: Column, pattern: str, near: int = 0) -> Column:
    """array<struct<start,end,val>> of the leftmost non-overlapping matches; end is exclusive.

    The pattern must not match the empty string. Null gives null. With `near`, left and right are added: up to so many
    characters beside the match, but not beyond the next match."""
    found = let(_cut(text, pattern), "found", f"if(size(found) > 1, {_placed('found', near)}, cast(array() as {CONTEXT if near else FOUND}))")
    return F.when(text.isNotNull(), found).cast(CONTEXT if near else FOUND)


def many(text: Column, patterns: list[str], may: list[Column], near: int = 0) -> Column:
    """array<struct<n,start,end,val>> of the matches of each pattern (by number, then place); pattern n is tried where
    may[n] holds. As spans() of each, but planned as one. Null gives null."""
    none = F.array().cast("array<string>")
    cuts = F.array(*[F.struct(F.lit(n).alias("n"), F.when(m, _cut(text, p)).otherwise(none).alias("cut")) for n, (p, m) in enumerate(zip(patterns, may))])
    sides = ", 'left', s.left, 'right', s.right" if near else ""
    each = f"transform({_placed('rule.cut', near)}, s -> named_struct('n', rule.n, 'start', s.start, 'end', s.end, 'val', s.val{sides}))"
    found = let(cuts, "cuts", f"flatten(transform(filter(cuts, rule -> size(rule.cut) > 1), rule -> {each}))")
    return F.when(text.isNotNull(), found)


def none_found(near: int = 0) -> Column:
    return F.array().cast(CONTEXT if near else FOUND)


def apart(found: Column, other: Column) -> Column:
    """Spans (structs with start and end) that share no character with any span of `other`.

    Both lists become one, in which a span of `found` stands at its end and one of `other` at its start; what is before it
    and reaches beyond its start overlaps it. So nothing is compared pair by pair."""
    events = (
        "array_sort(concat(transform(x.other, o -> named_struct('k', o.start, 'f', 1, 'e', o.end, 'i', -1)), "
        "transform(x.found, (s, i) -> named_struct('k', s.end, 'f', 0, 'e', 0, 'i', i))))"
    )
    reach = running_sql("transform(events, v -> v.e)", "greatest({a}, {b})")
    free = f"transform(filter(zip_with(events, {reach}, (v, r) -> named_struct('v', v, 'r', r)), z -> z.v.f = 0 and z.r <= x.found[z.v.i].start), z -> x.found[z.v.i])"
    return F.when(F.size(other) > 0, let(F.struct(found.alias("found"), other.alias("other")), "x", let_sql(events, "events", free))).otherwise(found)


def replaced(text: Column, found: Column, mark: str) -> Column:
    """The text with each span of `found` (structs that begin with start and end) replaced by mark; spans that overlap
    become one mark.

    substring() walks to its offset, so the text is first cut into a stretch for each block of about the root of the
    number of spans; single pieces are cut from those."""
    # spans that begin a mark: no span before them reaches beyond their start
    reach = running_sql("transform(own, s -> s.end)", "greatest({a}, {b})")
    heads = f"filter(zip_with(own, {reach}, (s, r) -> named_struct('a', r, 'z', s.start)), h -> h.z >= h.a)"
    piece = "concat(substring(stretch, h.a - part[0].a + 1, h.z - h.a), x.mark)"
    block = let_sql("substring(x.text, part[0].a + 1, element_at(part, -1).z - part[0].a)", "stretch", f"concat_ws('', transform(part, h -> {piece}))")
    blocks = f"transform(sequence(0, cast((size(heads) - 1) div width as int)), i -> {let_sql('slice(heads, i * width + 1, width)', 'part', block)})"
    body = let_sql(heads, "heads", let_sql("cast(ceil(sqrt(size(heads))) as int)", "width", f"concat_ws('', {blocks})"))
    rest = "substring(x.text, array_max(transform(own, s -> s.end)) + 1, length(x.text))"
    whole = let_sql("array_sort(transform(x.found, s -> named_struct('start', s.start, 'end', s.end)))", "own", f"concat({body}, {rest})")
    given = F.struct(text.alias("text"), found.alias("found"), F.lit(mark).alias("mark"))
    return F.when(F.size(found) > 0, let(given, "x", whole)).otherwise(text)
