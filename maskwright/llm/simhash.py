"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits are cut into a ring of nine segments. If two of them differ in at most four bits, the
pigeonring principle gives a start from which every run of l consecutive segments differs in at most 4 l / 9 bits:
none in the first two, one at most in the first four, two at most in the first six. So two of the segments three to
six are equal too, one of them among three and four, and five choices a start make 45 keys of four exact segments.
Equal keys yield candidates; they pass the chain test over the whole ring before the full Hamming check.

Keys are made from distinct fingerprints only, so exact copies cost nothing. A key shared by more than `part`
fingerprints is split: its members are dealt to parts, each pair of parts meets in a group of its own, and a group
returns only a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_files, per_text, small_batches, stored
from .components import components

BITS, SEGMENTS, RADIUS = 64, 9, 4
WIDTHS = [7] * 8 + [8]
SHIFTS = [sum(WIDTHS[:i]) for i in range(SEGMENTS)]
BUDGET = [RADIUS * n // SEGMENTS for n in range(1, SEGMENTS + 1)]
EXACT = sorted({tuple(sorted((i + j) % SEGMENTS for j in (0, 1, a, b))) for i in range(SEGMENTS) for a, b in ((2, 3), (2, 4), (2, 5), (3, 4), (3, 5))})


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash over word shingles: bit set if more than half of the shingles' XXH64 (seed 42) have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(h), 65536):
        ones += np.unpackbits(h[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and fp (long) of every row; a null text counts as empty, with fingerprint zero."""

    def work(texts: list) -> list:
        return [np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts)).view(np.int64)]

    return per_text(docs.withColumn("doc_id", F.col("doc_id").cast("long")), [*keep], {"fp": ("long", pa.int64())}, work)


def _keys(fp: str) -> Column:
    seg = [F.shiftrightunsigned(F.col(fp), s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(SHIFTS, WIDTHS)]
    made = []
    for tag, chosen in enumerate(EXACT):
        key = F.lit(tag).cast("long")
        for c in chosen:
            key = F.shiftleft(key, WIDTHS[c]).bitwiseOR(seg[c])
        made.append(key)
    return F.array(*made)


def chained(x: np.ndarray) -> np.ndarray:
    """Which of these differences have a start whose every run of segments keeps its share of the budget."""
    d = np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in zip(SHIFTS, WIDTHS)]).astype(np.int8)
    good = np.zeros(x.shape, dtype=bool)
    for i in range(SEGMENTS):
        run, ok = np.zeros(x.shape, dtype=np.int8), np.ones(x.shape, dtype=bool)
        for n in range(SEGMENTS):
            run = run + d[(i + n) % SEGMENTS]
            ok &= run <= BUDGET[n]
        good |= ok
    return good


def _linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a and b within the radius: chain test first, then the full Hamming check."""
    x = a[:, None] ^ b[None, :]
    near = np.bitwise_count(x & np.uint64((1 << 32) - 1)) <= RADIUS  # half of the word rules out nearly all
    i, j = np.nonzero(near)
    d = x[i, j]
    keep = chained(d)
    i, j, d = i[keep], j[keep], d[keep]
    keep = np.bitwise_count(d) <= RADIUS
    return i[keep], j[keep]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index that each of n nodes reaches over the links."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _within(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one group (fps, reps, left or None) to links (u, v)."""
    for f in frames:
        us, vs = [], []
        two = (f["fps"].str.len() == 2) & f["left"].isna()
        if two.any():
            p = np.stack(f.loc[two, "fps"].to_numpy()).view(np.uint64)
            r = np.stack(f.loc[two, "reps"].to_numpy())
            d = p[:, 0] ^ p[:, 1]
            ok = chained(d)
            ok[ok] = np.bitwise_count(d[ok]) <= RADIUS
            us.append(r[ok, 0])
            vs.append(r[ok, 1])
        for fps, reps, left in f.loc[~two, ["fps", "reps", "left"]].itertuples(index=False):
            fps, reps = np.asarray(fps).view(np.uint64), np.asarray(reps)
            order = np.argsort(reps)
            fps, reps = fps[order], reps[order]
            if left is None or (isinstance(left, float) and np.isnan(left)):
                i, j = _linked(fps, fps)
            else:
                left = np.asarray(left, dtype=bool)[order]
                a, b = np.nonzero(left)[0], np.nonzero(~left)[0]
                i, j = _linked(fps[a], fps[b])
                i, j = a[i], b[j]
            root = _forest(len(fps), i, j)
            own = root != np.arange(len(fps))
            us.append(reps[own])
            vs.append(reps[root[own]])
        if us:
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})


def links(distinct: DataFrame, part: int = 384) -> DataFrame:
    """(fp, rep) with distinct fingerprints to links (u, v) between reps that span every component.

    Few rows make 45 keys each, so they are dealt out first."""
    spread = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    keyed = spread.select("fp", "rep", F.explode(_keys("fp")).alias("key"))
    # only keys that two fingerprints share go on; counts are summed before they are shuffled
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # Spark's estimate takes an exploded row for one row, so it would broadcast 45 times what it expects
    kept = keyed.hint("merge").join(shared, "key").withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    dealt = kept.withColumn("own", own).withColumn("p", F.explode(pairs)).select("key", "fp", "rep", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "own")
    grouped = dealt.groupBy("key", "i", "j").agg(F.collect_list(F.struct("fp", "rep", "own")).alias("m"))
    rows = grouped.filter(F.size("m") > 1).select(
        F.col("m.fp").alias("fps"), F.col("m.rep").alias("reps"), F.when(F.col("i") != F.col("j"), F.transform("m", lambda x: x["own"] == F.col("i"))).alias("left")
    )
    return small_batches(rows).mapInPandas(_within, "u long, v long")


def classes(fps: DataFrame, part: int = 384) -> DataFrame:
    """Distinct fingerprints of a table with a column fp to (fp, class): the least fingerprint that links reach.

    Fingerprints are the nodes themselves, so rows without doc_id need no stand-in."""
    distinct = stored(few_files(fps.select("fp").distinct(), fps.count()), "distinct")
    labels = components(links(distinct.withColumn("rep", F.col("fp")), part))
    return distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, shingle: int = 4, part: int = 384) -> DataFrame:
    """One row per row of docs: doc_id, fp long, component_id.

    component_id is the least doc_id that links reach, the row's own included. Null texts are empty texts; rows with
    a null doc_id are linked like others but never name a component (null if no other row is in it). Repeated rows are
    kept. Other columns are ignored. An empty table gives an empty result; very long texts count whole."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    named = stored(few_files(classes(fps, part), fps.count()), "classes")
    # least doc_id by fingerprint first, so that copies meet before the shuffle
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp").groupBy("class").agg(F.min("least").alias("component_id"))
    ids = stored(named.join(least, "class").select("fp", "component_id"), "components")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    from .common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
