"""Exact repeated-passage removal by compaction of a sampled de Bruijn graph of word k-mers.

A window is WINDOW consecutive words of one document; a word goes if a window over it also starts in a document with a
smaller doc_id. Keeping a row for every window would shuffle several times the text, so:

1. Equal rows become one, by a 128-bit key, and are numbered; their packed texts are stored once.
2. Every window holds 39 k-mers of 12 words. The least hash among them is its minimizer; documents that share a window
   share it. Minimizers (about one word in twenty) are the graph's edges, and the words up to the next and previous
   minimizer are how an edge goes on. They are stored once. One aggregation per k-mer finds the least and greatest
   document that hold it and whether all its occurrences go on alike to the right and to the left.
3. A join brings this back to the occurrences of k-mers that two documents share. Runs of edges that go on alike are
   nonbranching paths: within one, every occurrence of the k-mer carries the same words, so windows inside need no row
   of their own: their least document is that of their minimizer, at whose place it is looked up.
4. Windows over a branch whose minimizer is shared go one by one, by a 128-bit digest of their own words, to a second
   aggregation and join, at the windows' source coordinates.
5. What paths claim is verified at the source coordinates: the words of each claimed range are compared, by a 128-bit
   digest, with those at the place in the source. A claim that fails sends its windows the way of step 4.
6. Marked ranges meet the texts once more, which cuts the words out.

The rolling hash only chooses k-mers and proposes paths. If two k-mers collide, their occurrences do not go on alike, and
their windows are told apart by their words.

Documents cross shuffles packed with zstandard. Hot k-mers and windows are aggregated before the shuffle, and the joins
on them are plain joins of tables without further grouping on the key, so Spark may split a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begins, dropped, row_key, small_batches, stored, table

WINDOW, K = 50, 12
SPAN = WINDOW - K + 1  # k-mers in a window
LAST = 2**63 - 1  # stands for a null doc_id, which is never smaller
M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


class _Words(dict):
    """Hash of each word seen, emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


_hashes = _Words()
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, b in enumerate((BASE, INVERSE)):
            p = np.full(max(n, 65536), b, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hashed:
    """Word hashes of one document, and hashes of any of its word ranges in constant time."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=self.n)
        up, self.down = _power(self.n + 1)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(h * up[: self.n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(0xD6E8FEB86659FD93))

    def every(self, k: int) -> np.ndarray:
        start = np.arange(self.n - k + 1)
        return self.ranges(start, start + k)


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every w neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= w:
        out = pick(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = pick(out[: len(out) - (w - have)], out[w - have :])
    return out


def minimizers(doc: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that hold the least k-mer hash of some window (ties all count), k-mer hashes, and each window's least."""
    kmers = doc.every(K)
    least = _sliding(kmers, SPAN, np.minimum)
    pad = np.zeros(SPAN - 1, dtype=np.uint64)
    best = _sliding(np.concatenate((pad, least, pad)), SPAN, np.maximum)
    return np.nonzero(best == kmers)[0], kmers, least


def edges(doc: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer positions, their k-mer hashes, and hashes of the words from each through the next and the previous one.

    Beyond the last and the first lie the document's ends, which count as words of their own."""
    at, kmers, _ = minimizers(doc)
    right = doc.ranges(at, np.append(at[1:] + K, doc.n))
    right[-1] ^= np.uint64(0xA5A5A5A55A5A5A5A)
    left = doc.ranges(np.insert(at[:-1], 0, 0), at + K)
    left[0] ^= np.uint64(0x3C3C3C3CC3C3C3C3)
    return at, kmers[at], right, left


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Lined:
    """Words of one document in one byte string, to digest any of its word ranges."""

    def __init__(self, words: list[bytes]):
        self.line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        self.starts, self.ends = np.concatenate(([0], ends[:-1])), ends - 1

    def digests(self, at: np.ndarray, end: np.ndarray) -> list[bytes]:
        line, digest = self.line, xxhash.xxh3_128_digest
        return [digest(line[a:z]) for a, z in zip(self.starts[at].tolist(), self.ends[end - 1].tolist())]


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, d, packed) to the edges of each document: h, n, d, at, right, left."""
    begins("substrings", _hashes.clear)
    for b in batches:
        n, d, parts = b.column(0).to_numpy(), b.column(1).to_numpy(), []
        for i, packed in enumerate(b.column(2)):
            words = _unpacked(packed.as_py()).split()
            if len(words) >= WINDOW:
                at, h, right, left = edges(Hashed(words))
                parts.append((np.full(len(at), i), at, h, right, left))
        if parts:
            row, at, h, right, left = (np.concatenate(x) for x in zip(*parts))
            made = (h.view(np.int64), n[row], d[row], at.astype(np.int32), right.view(np.int64), left.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["h", "n", "d", "at", "right", "left"])


def _explained(d: int, doc: Hashed, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: the number of the row that a path claims to hold it in a smaller document (-1: none), where it
    starts there, and whether it must be looked up, from what is known of the shared minimizers.

    known: at (sorted), low, from, place, right, left: positions, least document, the row and position of the k-mer there,
    whether all occurrences go on alike."""
    n_windows = doc.n - WINDOW + 1
    at, kmers, least = minimizers(doc)
    where = np.searchsorted(at, known["at"])
    shared = np.zeros(len(at), dtype=bool)
    shared[where] = True
    right, left, low = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=np.int64)
    right[where], left[where], low[where] = known["right"], known["left"], known["low"]
    # how far every occurrence of a minimizer has the same words: to the end of the run that goes on alike
    ends = np.append(at[1:], at[-1]) + K
    stop = np.where(~right, at + K, 0)
    if right[-1]:
        stop[-1] = doc.n
    idx = np.where(stop > 0, np.arange(len(at)), len(at) - 1)
    reach_r = stop[np.minimum.accumulate(idx[::-1])[::-1]]
    begin = np.where(~left, at, -1)
    if left[0]:
        begin[0] = 0
    idx = np.where(begin >= 0, np.arange(len(at)), 0)
    reach_l = begin[np.maximum.accumulate(idx)]
    # only a window's own minimizer speaks for it: every document that holds the window has chosen that k-mer too
    over = at[shared][:, None] - np.arange(SPAN)[None, :]
    inside = (over >= 0) & (over < n_windows)
    hit = inside & (least[np.where(inside, over, 0)] == kmers[at[shared]][:, None])
    alike = hit & (over >= reach_l[shared][:, None]) & (over + WINDOW <= reach_r[shared][:, None])
    asked, settled = (np.zeros(n_windows, dtype=bool) for _ in range(2))
    source, place = np.full(n_windows, -1, dtype=np.int64), np.zeros(n_windows, dtype=np.int64)
    asked[over[hit]] = True
    settled[over[alike]] = True
    lower = alike & (low[shared] < d)[:, None]
    # later k-mers overwrite earlier ones, so every window ends with the claim of one of its minimizers
    r, c = np.nonzero(lower)
    w = over[r, c]
    source[w], place[w] = known["from"][r], known["place"][r] - c
    return source, place, asked & ~settled


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, d, packed, known) to rows: ranges of windows [at, until) that a path claims, with their source (row, place), or
    open windows (source null), with the digest of their words."""
    begins("substrings", _hashes.clear)
    for b in batches:
        out: list[tuple] = []
        for n, d, packed, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
            words = _unpacked(packed.as_py()).split()
            flat = known.values
            k = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("at", "low", "from", "place", "right", "left")}
            order = np.argsort(k["at"], kind="stable")
            source, place, asked = _explained(d, Hashed(words), {name: v[order] for name, v in k.items()})
            # a range is a run of windows with one source row and one shift
            claimed, shift = source >= 0, place - np.arange(len(place))
            new = claimed & ~(np.concatenate(([False], claimed[:-1])) & (source == np.roll(source, 1)) & (shift == np.roll(shift, 1)))
            start = np.nonzero(new)[0]
            end = np.maximum.reduceat(np.where(claimed, np.arange(1, len(source) + 1), 0), start) if len(start) else start
            at = np.nonzero(asked)[0]
            if len(start) or len(at):
                lined = Lined(words)
                first, until = np.concatenate((start, at)), np.concatenate((end, at + 1))
                out.append((np.full(len(first), n), np.full(len(first), d), first, until, np.concatenate((source[start], np.full(len(at), -1))), np.concatenate((place[start], at)), lined.digests(first, until + WINDOW - 1)))
        if out:
            n, d, at, until, source, place = (np.concatenate(x) for x in list(zip(*out))[:6])
            yield pa.RecordBatch.from_arrays(
                [pa.array(n), pa.array(d), pa.array(at.astype(np.int32)), pa.array(until.astype(np.int32)), pa.array(source, mask=source < 0), pa.array(place.astype(np.int32)), pa.array([x for o in out for x in o[6]], pa.binary())],
                names=["n", "d", "at", "until", "source", "place", "digest"],
            )


def _claim_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, packed, wanted) to (source, place, length, there): digests of wanted ranges of a source's windows."""
    for b in batches:
        out = []
        for n, packed, wanted in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            lined, flat = Lined(_unpacked(packed.as_py()).split()), wanted.values
            place, length = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("place", "length"))
            inside = (place >= 0) & (place + length + WINDOW - 1 <= len(lined.ends))
            place, length = place[inside], length[inside]
            out.append((np.full(len(place), n), place, length, lined.digests(place, place + length + WINDOW - 1)))
        if out:
            n, place, length = (np.concatenate(x) for x in list(zip(*out))[:3])
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(place.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array([x for o in out for x in o[3]], pa.binary())], names=["source", "place", "length", "there"])


def _packed(text: str | None) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress((text or "").encode("utf-8", "surrogatepass"))


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def _pack(df: DataFrame, keep: list[str]) -> DataFrame:
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = pa.array([_packed(t.as_py()) for t in b.column(len(keep))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), data], names=[*keep, "packed"])

    return df.select(*keep, "_text").mapInArrow(run, ", ".join(f"`{k}` {fields[k]}" for k in keep) + ", packed binary")


def _claims_hold(claims: DataFrame, texts: DataFrame) -> DataFrame:
    """Claimed ranges (n, d, at, until, source, place, digest) with `holds`: whether the source has the same words there.

    A source is asked once for each distinct range, however many documents claim it, and in parts of its text, so what one
    task gets for a source is bounded by the source's own length."""
    length = F.col("until") - F.col("at")
    asked = claims.select("source", "place", length.alias("length")).distinct()
    parts = asked.groupBy("source", F.floor(F.col("place") / 1024).alias("part")).agg(F.collect_list(F.struct("place", "length")).alias("wanted"))
    there = texts.join(parts.withColumnRenamed("source", "n"), "n").select("n", "packed", "wanted").mapInArrow(_claim_rows, "source long, place int, length int, there binary")
    there = stored(there, "sources")
    joined = claims.withColumn("length", length).join(there, ["source", "place", "length"], "left")
    return joined.withColumn("holds", F.coalesce(F.col("there") == F.col("digest"), F.lit(False)))


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(n, ranges array<struct<at,until>>): ranges of windows, by their first word, that start in a smaller document.

    texts: n (number of a row, unlike all others), d (order; LAST for none), packed."""
    rows = stored(texts.select("n", "d", "packed").mapInArrow(_edge_rows, "h long, n long, d long, at int, right long, left long"), "edges")
    same = lambda c: F.min(c) == F.max(c)
    kmers = rows.groupBy("h").agg(F.min(F.struct("d", "n", "at")).alias("least"), F.max("d").alias("high"), same("right").alias("right"), same("left").alias("left")).filter("least.d < high")
    # stored, so that the join below has plain exchanges on both sides and a hot k-mer can be split
    kmers = stored(kmers.select("h", F.col("least.d").alias("low"), F.col("least.n").alias("from"), F.col("least.at").alias("place"), "right", "left"), "kmers")
    kind = "n long, d long, at int, until int, source long, place int, digest binary"
    while True:
        known = rows.select("h", "n", "at").join(kmers, "h").groupBy("n").agg(F.collect_list(F.struct("at", "low", "from", "place", "right", "left")).alias("known"))
        found = stored(texts.join(known, "n").select("n", "d", "packed", "known").mapInArrow(_window_rows, kind), "windows")
        claims = stored(_claims_hold(found.filter("source is not null"), texts), "claims")
        failed = claims.filter(~F.col("holds"))
        if failed.isEmpty():
            break
        # hashes have collided: the paths through these k-mers are given up, and their windows are told apart by their words
        spots = failed.select("n", F.col("at").alias("a"), F.col("until").alias("z"))
        doubt = rows.join(spots, "n").filter((F.col("at") >= F.col("a")) & (F.col("at") < F.col("z") + WINDOW)).select("h").distinct().withColumn("doubt", F.lit(True))
        sure = lambda c: (F.col(c) & F.col("doubt").isNull()).alias(c)
        kmers = stored(kmers.join(doubt, "h", "left").select("h", "low", "from", "place", sure("right"), sure("left")), "kmers")
    dropped(rows)
    open_ = found.filter("source is null").select("n", "d", "at", "until", "digest")
    first = stored(open_.groupBy("digest").agg(F.min("d").alias("low"), F.max("d").alias("high")).filter("low < high").select("digest", "low"), "first")
    looked = open_.join(first, "digest").filter("low < d").select("n", "at", "until")
    marked = claims.filter("holds").select("n", "at", "until").union(looked)
    return marked.groupBy("n").agg(F.collect_set(F.struct("at", "until")).alias("ranges"))


def _cut(words: list[bytes], ranges: pa.Scalar) -> list[bytes]:
    if ranges is None or not ranges.is_valid:
        return words
    at, until = (ranges.values.field(k).to_numpy(zero_copy_only=False) for k in ("at", "until"))
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(gone, at, 1)
    np.add.at(gone, until + WINDOW - 1, -1)
    return [w for w, g in zip(words, (np.cumsum(gone[:-1]) > 0).tolist()) if not g]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words left, joined by one space) of every row of docs.

    Null texts have no words. A row with a null doc_id may lose words but is nobody's smaller document. Rows with the
    same doc_id do not cut each other; equal rows are all returned, and worked on once. Other columns are ignored. Very long
    texts are worked on whole. Empty in, empty out."""
    doc = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    doc = doc.withColumn("rid", row_key("doc_id", "_text")).withColumn("d", F.coalesce("doc_id", F.lit(LAST)))
    # written, so that the numbers stay; equal rows meet per task before the shuffle
    texts = stored(_pack(doc, ["rid", "d"]).dropDuplicates(["rid"]).withColumn("n", F.monotonically_increasing_id()), "texts")
    ranges = repeated_ranges(texts.select("n", "d", "packed")).join(texts.select("n", "rid"), "n").select("rid", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for packed, marks in zip(b.column(1), b.column(2)):
                words = _unpacked(packed.as_py()).split()
                left = _cut(words, marks)
                n.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    joined = _pack(doc, ["doc_id", "rid"]).join(ranges, "rid", "left").select("doc_id", "packed", "ranges")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words left of all documents without the windows of 50 words that a document with a smaller doc_id holds too."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS p, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h FROM i),
m AS (SELECT h, min(doc_id) AS low FROM h GROUP BY h),
r AS (SELECT doc_id, list(p) AS ps FROM (SELECT h.doc_id, h.p FROM h JOIN m ON h.h = m.h AND m.low < h.doc_id) GROUP BY doc_id),
g AS (SELECT r.doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 50)))) AS gone FROM r),
k AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(gone), 0) AS n_gone,
        CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, j: NOT list_contains(gone, j)) END AS kept
      FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_gone AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
