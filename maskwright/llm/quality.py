"""Quality and toxicity classifiers by co-training of a text view and a page-metadata view.

Both views start from the labelled rows. In each round every view scores all unlabelled documents on the executors, and
those it is sure about train the other view: what they weigh there keeps to the labels' proportions and to no more than
the labelled rows. The words of the text view are chosen anew each round, from labelled and pseudo-labelled documents. At
the end each view is calibrated on held-out labelled rows, a small model over both calibrated views is fitted there, and
all documents are scored. Texts are read once and never shuffled: what moves are their features, two bytes a word bucket.

At most MAX_LABELLED labelled documents, taken by the hash of their id, reach the driver, one row each, as features, not
texts (at most 2^WORD_BITS word buckets a document). Of the unlabelled ones only sums do: counts by word and by metadata,
and the derivatives that a Newton step needs, for both targets in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begins, dropped, row_key, small_batches, stored, table

MAX_LABELLED = 8000
ROUNDS, SURE, STEPS = 3, 0.97, 2  # co-training rounds; least confidence; Newton steps over all documents in a round
WORD_BITS, CHOSEN, META = 18, 256, 128
SUMS = 8  # tasks that add up the sums of all others before the driver does
FLAGS = 6  # marks of a word: symbols, no letter or digit, capitals, exclamation, digits, address
DENSE = 2 * FLAGS + 6
TARGETS = ("quality", "toxic")
VIEW = ("text", "lang", "source", "n_chars")
HIGH = 1 << (WORD_BITS - 16)

_SYMBOLS = re.compile(rb"[%&#$*~^=<>{}\[\]\\]{2,}|[%&#$*]$")
_LETTERS = re.compile(r"[^\W\d_]+")


class _Seen(dict):
    """Raw word to (hash bucket of its letters in lower case) and its marks, packed; emptied when it grows large."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        s = w.decode("utf-8", "replace")
        letters = "".join(_LETTERS.findall(s.lower()))
        bucket = (xxhash.xxh64_intdigest(letters.encode(), 3) >> (64 - WORD_BITS)) if letters else (1 << WORD_BITS) - 1
        digit = any(c.isdigit() for c in s)
        marks = [_SYMBOLS.search(w) is not None, not letters and not digit, len(letters) > 1 and s.isupper(), "!!" in s, digit, "@" in s or "://" in s]
        packed = self[w] = bucket | sum(int(m) << (WORD_BITS + k) for k, m in enumerate(marks)) | min(len(s), 255) << (WORD_BITS + FLAGS)
        return packed


_seen = _Seen()


def _begin() -> None:
    """By itself, since what a function within another names is sent by value: a copy of the words would be emptied."""
    begins("quality", _seen.clear)


def text_view(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets and DENSE numbers of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    dense = np.zeros(DENSE, dtype=np.float32)
    if not n:
        dense[-1] = 1.0
        return np.zeros(0, dtype=np.int32), dense
    x = np.fromiter(map(_seen.__getitem__, words), dtype=np.int64, count=n)
    buckets = np.unique(x & ((1 << WORD_BITS) - 1)).astype(np.int32)
    share = np.array([((x >> (WORD_BITS + k)) & 1).mean() for k in range(FLAGS)])
    lines = [s for s in raw.split(b"\n") if s.strip()]
    dense[:FLAGS] = share
    dense[FLAGS : 2 * FLAGS] = share > 0.02
    again = 1 - len(set(lines)) / len(lines)
    dense[2 * FLAGS :] = again, again > 0.2, (x >> (WORD_BITS + FLAGS)).mean() / 10, np.log1p(n) / 10, 1 - len(buckets) / n, 0.0
    return buckets, dense


def meta_view(lang, source, chars) -> list[int]:
    """Hashed page metadata; nulls are values of their own."""
    size = -1 if chars is None else int(np.log2(max(int(chars), 0) + 1))
    return [xxhash.xxh64_intdigest(f"{k}={v}".encode("utf-8", "surrogatepass"), 5) % META for k, v in (("lang", lang), ("source", source), ("size", size))]


class Logistic:
    """Logistic regression of weighted rows with a ridge, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 0.3):
        self.x, self.y = np.hstack((x, np.ones((len(x), 1)))), y
        self.weight = np.ones(len(x)) if weight is None else weight
        self.penalty = np.full(self.x.shape[1], ridge)
        self.penalty[-1] = 1e-3
        self.all = np.zeros(self.x.shape[1])
        for _ in range(30):
            if self.step() < 1e-6:
                break

    def step(self, more: tuple[np.ndarray, np.ndarray] | None = None) -> float:
        """One Newton step, its length bounded; `more` is the gradient and curvature of rows held elsewhere."""
        x, w = self.x, self.all
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (self.weight * (p - self.y)) + self.penalty * w
        h = (x * (self.weight * p * (1 - p))[:, None]).T @ x + np.diag(self.penalty)
        if more:
            g, h = g + more[0], h + more[1]
        step = np.linalg.solve(h, g)
        self.all = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        return float(np.abs(step).max())

    @property
    def w(self) -> np.ndarray:
        return self.all[:-1]

    @property
    def b(self) -> float:
        return float(self.all[-1])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _groups(rows: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
    """Number of each row's group of near copies: rows that share a band of minimum hashes and most of their buckets, or
    that agree in everything where there are few buckets.

    Copies carry one label many times over; left alone, their words would look like signs of the class."""
    bands, width = 6, 4
    odd = np.arange(1, 2 * bands * width, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    group = np.arange(len(rows))
    seen: dict[tuple, int] = {}
    for k, b in enumerate(rows):
        if len(b) >= 20:
            h = np.min(((b.astype(np.uint64) + np.uint64(1))[:, None] * odd[None, :]) >> np.uint64(20), axis=0)
            keys = [(j, *h[j * width : (j + 1) * width].tolist()) for j in range(bands)]
        else:
            keys = [(b.tobytes(), dense[k].tobytes())]
        for key in keys:
            first = seen.setdefault(key, k)
            if first != k and group[first] != group[k]:
                shared = len(np.intersect1d(rows[first], b, assume_unique=True))
                if len(b) < 20 or shared >= 0.6 * (len(rows[first]) + len(b) - shared):
                    group[k] = group[first]
    return group


def _telling(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, given: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Buckets whose presence differs most between the classes, by the z-score of the difference, and which enough rows
    of weight support. given: pseudo-labelled documents by class, and those with each bucket."""
    n1, n0 = max(float((weight * y).sum() + given[0][1]), 1.0), max(float((weight * (1 - y)).sum() + given[0][0]), 1.0)
    here = given[1].astype(float)
    for b, v, w in zip(rows, y, weight):
        here[int(v), b] += w
    rate = (here.sum(axis=0) + 1) / (n0 + n1 + 2)
    z = np.abs(here[1] / n1 - here[0] / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0))
    z[here.sum(axis=0) < 4] = 0
    best = np.argsort(-z, kind="stable")[:CHOSEN]
    return np.sort(best[z[best] > 5])


def _marked(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)))
    for k, b in enumerate(rows):
        out[k] = np.isin(chosen, b)
    return out


class _Gifts:
    """What a round gives to the views of one target: pseudo-labelled documents by class and those with each word, for
    the text view; documents by class and metadata, for the other."""

    def __init__(self):
        self.rows, self.words, self.meta = np.zeros(2), np.zeros((2, 1 << WORD_BITS)), {}


def _pack(words: np.ndarray) -> bytes:
    """Sorted buckets in two bytes each: how many there are for each value of the bits above 16, then the lower bits."""
    counts = np.bincount(words >> 16, minlength=HIGH).astype("<u4")
    return counts.tobytes() + (words & 0xFFFF).astype("<u2").tobytes()


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch, the row of each, and the dense and metadata numbers by row."""
    words, dense, meta = (b.column(b.schema.get_field_index(c)) for c in ("words", "dense", "meta"))
    n = b.num_rows
    ends = np.frombuffer(words.buffers()[1], dtype="<i4")[words.offset : words.offset + n + 1] if n else np.zeros(1, dtype="<i4")
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]] if n else np.zeros(0, dtype=np.uint8)
    head = (ends[:-1, None] - ends[0] + np.arange(4 * HIGH)[None, :]).reshape(-1)
    counts = data[head].view("<u4").reshape(n, HIGH).astype(np.int64)
    body = np.ones(len(data), dtype=bool)
    body[head] = False
    flat = data[body].view("<u2").astype(np.int32) | np.repeat(np.tile(np.arange(HIGH, dtype=np.int32), n), counts.reshape(-1)) << 16
    numbers = dense.flatten().to_numpy(zero_copy_only=False).reshape(-1, DENSE).astype(float)
    return flat, np.repeat(np.arange(n), counts.sum(axis=1)), numbers, meta.flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, key (of text and metadata), words, dense and meta of every row, in a scratch table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for b in batches:
            views = [text_view(t.as_py()) for t in b.column(2)]
            meta = [meta_view(*m) for m in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([_pack(w) for w, _ in views], pa.binary()), pa.array([d for _, d in views], pa.list_(pa.float32())), pa.array(meta, pa.list_(pa.int32()))],
                names=["doc_id", "key", "words", "dense", "meta"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = small_batches(_columns(docs)).select("doc_id", row_key(*VIEW).alias("key"), *VIEW)
    return stored(rows.mapInArrow(run, f"doc_id {kind}, key string, words binary, dense array<float>, meta array<int>"), "features")


def _pool(made: DataFrame) -> DataFrame:
    """Features of unlabelled documents; copies with the same metadata count once."""
    return stored(made.groupBy("key").agg(F.min(F.struct("dense", "meta", "words")).alias("row")).select("row.*"), "unlabelled")


def _sure(z: np.ndarray) -> np.ndarray:
    """Class that a view is sure of by its logits, else -1."""
    p = _sigmoid(z)
    return np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1))


def _gifts(pool: DataFrame, models: dict[str, CoTrained]) -> dict[str, _Gifts]:
    """What both views of each target say about all documents of the pool, in one pass."""
    held = pool.sparkSession.sparkContext.broadcast({t: m.flat_views() for t, m in models.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {t: _Gifts() for t in held.value}
        for b in batches:
            words, row, dense, meta = _unpacked(b)
            for t, m in held.value.items():
                g = found[t]
                by_text = _sure(np.bincount(row, m["words"][words], minlength=b.num_rows) + dense @ m["dense"] + m["text_b"])
                by_meta = _sure(m["meta"][meta].sum(axis=1) + m["meta_b"])
                for c in (0, 1):
                    g.rows[c] += (by_meta == c).sum()
                    g.words[c] += np.bincount(words[by_meta[row] == c], minlength=1 << WORD_BITS)
                    for x, n in zip(*np.unique(meta[by_text == c], axis=0, return_counts=True)):
                        g.meta[c, *x.tolist()] = g.meta.get((c, *x.tolist()), 0) + int(n)
        for t, g in found.items():
            out = [(t, c, *x, n) for (c, *x), n in g.meta.items()]
            for c in (0, 1):
                at = np.flatnonzero(g.words[c])
                out += [(t, c, w, -1, -1, n) for w, n in zip(at.tolist(), g.words[c][at].astype(int).tolist())]
                out.append((t, c, -1, -1, -1, int(g.rows[c])))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["t", "c", "a", "b", "d", "n"])

    out = {t: _Gifts() for t in models}
    counts = pool.mapInArrow(run, "t string, c int, a int, b int, d int, n long").groupBy("t", "c", "a", "b", "d").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    c, a, b, d, n = (got.column(k).to_numpy() for k in ("c", "a", "b", "d", "n"))
    names = np.array(got.column("t").to_pylist(), dtype=object)
    for t, g in out.items():
        own = names == t
        word, meta = own & (b < 0) & (a >= 0), own & (b >= 0)
        g.words[c[word], a[word]] = n[word]
        g.rows[c[own & (a < 0)]] = n[own & (a < 0)]
        g.meta = {(int(i), *map(int, x)): int(m) for i, *x, m in zip(c[meta], a[meta], b[meta], d[meta], n[meta])}
    return out


def _far(pool: DataFrame, models: dict[str, CoTrained], gifts: dict[str, _Gifts], judges: dict[str, dict]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each target, gradient and curvature of its text view over the documents that the metadata view (as it was when
    it gave) is sure of, in one pass. Sums meet in two levels, so the driver gets a few of them."""
    fixed = {}
    for t, m in models.items():
        slot = np.full(1 << WORD_BITS, -1, dtype=np.int32)
        slot[m.chosen] = np.arange(len(m.chosen))
        fixed[t] = (judges[t]["meta"], judges[t]["meta_b"], slot, m._scale(gifts[t].rows), m.text.all)
    held = pool.sparkSession.sparkContext.broadcast(fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((len(f[4]) + 1, len(f[4]))) for t, f in held.value.items()}
        for b in batches:
            words, row, dense, meta = _unpacked(b)
            for t, (meta_w, meta_b, slot, scale, w) in held.value.items():
                label = _sure(meta_w[meta].sum(axis=1) + meta_b)
                x = np.hstack((np.zeros((b.num_rows, len(w) - DENSE - 1)), dense, np.ones((b.num_rows, 1))))
                at = slot[words]
                x[row[at >= 0], at[at >= 0]] = 1
                x, label = x[label >= 0], label[label >= 0]
                p, weight = _sigmoid(x @ w), scale[label]
                sums[t][0] += x.T @ (weight * (p - label))
                sums[t][1:] += (x * (weight * p * (1 - p))[:, None]).T @ x
        yield pa.RecordBatch.from_arrays([pa.array([*sums]), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["t", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for t, part in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(part.as_py())
                sums[t] = sums[t] + x if t in sums else x
        yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.string()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["t", "part"])

    parts = pool.mapInArrow(run, "t string, part binary").repartition(SUMS).mapInArrow(add, "t string, part binary").toArrow()
    out = {t: np.zeros((len(f[4]) + 1, len(f[4]))) for t, f in fixed.items()}
    for t, part in zip(parts.column(0).to_pylist(), parts.column(1)):
        out[t] += np.frombuffer(part.as_py()).reshape(out[t].shape)
    held.unpersist()
    return {t: (x[0], x[1:]) for t, x in out.items()}


class CoTrained:
    """Both views of one target, and the model that joins them."""

    def __init__(self, labelled: dict, y: np.ndarray):
        self.rows, self.y, group = labelled, y.astype(float), labelled["group"]
        self.held = np.isin(group, np.unique(group)[4::5])  # whole groups, so that no copy is on both sides
        self.fit = ~self.held
        if any(len(np.unique(self.y[side])) < 2 for side in (self.held, self.fit)):
            # too few rows to hold some out: both sides need both classes
            self.held = self.fit = np.ones(len(self.y), dtype=bool)
        self.weight = 1.0 / np.bincount(group)[group]
        self.mass, self.prior = self.weight[self.fit].sum(), np.average(self.y[self.fit], weights=self.weight[self.fit])
        self.learn(_Gifts())

    def learn(self, gifts: _Gifts) -> None:
        """Fit both views to the labelled rows; the words of the text view and the whole metadata view also to what each is
        given by the other's judgement of all unlabelled documents."""
        fit = self.fit
        y, weight = self.y[fit], self.weight[fit]
        self.chosen = chosen = _telling([b for b, f in zip(self.rows["words"], fit) if f], y, weight, (gifts.rows, gifts.words))
        self.lt = np.hstack((_marked(self.rows["words"], chosen), self.rows["dense"]))
        self.text = Logistic(self.lt[fit], y, weight)
        x, label, n = np.zeros((len(gifts.meta), META)), np.zeros(len(gifts.meta)), np.zeros(len(gifts.meta))
        for k, ((c, *pattern), m) in enumerate(sorted(gifts.meta.items())):
            np.add.at(x[k], pattern, 1)
            label[k], n[k] = c, m
        scale = self._scale(np.bincount(label.astype(int), n, minlength=2))
        self.meta = Logistic(*(np.concatenate(pair) for pair in ((self.rows["meta"][fit], x), (y, label), (weight, n * scale[label.astype(int)]))))

    def _scale(self, n: np.ndarray) -> np.ndarray:
        """Weight of one pseudo-labelled document by class, where n are given."""
        return np.minimum(1.0, self.mass * np.array([1 - self.prior, self.prior]) / np.maximum(n, 1))

    def join_views(self) -> None:
        held, lt = self.held, self.lt
        y, w, meta = self.y, self.weight[held], self.rows["meta"]
        zt, zm = self.text.logit(lt[held]), self.meta.logit(meta[held])
        self.cal_text, self.cal_meta = Logistic(zt[:, None], y[held], w), Logistic(zm[:, None], y[held], w)
        self.join = Logistic(np.stack((self.cal_text.logit(zt[:, None]), self.cal_meta.logit(zm[:, None])), axis=1), y[held], w)
        self.held_accuracy = float(((self.score(lt[held], meta[held]) > 0.5) == (y[held] > 0.5)).mean())

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        zt, zm = self.cal_text.logit(self.text.logit(text)[:, None]), self.cal_meta.logit(self.meta.logit(meta)[:, None])
        return _sigmoid(self.join.logit(np.stack((zt, zm), axis=1)))

    def flat(self) -> dict:
        """The model as plain numbers: word weights by bucket, dense and metadata weights, and the joining line."""
        return self.flat_views() | {"line": (self.cal_text.w[0], self.cal_text.b, self.cal_meta.w[0], self.cal_meta.b, self.join.w[0], self.join.w[1], self.join.b)}

    def flat_views(self) -> dict:
        if not hasattr(self, "text"):
            return {}
        words = np.zeros(1 << WORD_BITS, dtype=np.float32)
        words[self.chosen] = self.text.w[: len(self.chosen)]
        return {
            "words": words,
            "dense": self.text.w[len(self.chosen) :],
            "text_b": self.text.b,
            "meta": self.meta.w,
            "meta_b": self.meta.b,
        }


def _scores(model: dict, words: np.ndarray, row: np.ndarray, dense: np.ndarray, meta: np.ndarray) -> np.ndarray:
    """Probabilities of all rows of a batch."""
    a, b, c, d, u, v, w = model["line"]
    zt = np.bincount(row, model["words"][words], minlength=len(dense)) + dense @ model["dense"] + model["text_b"]
    zm = model["meta"][meta].sum(axis=1) + model["meta_b"]
    return _sigmoid(u * (a * zt + b) + v * (c * zm + d) + w)


def _columns(docs: DataFrame) -> DataFrame:
    """The columns that the views need, null where the table lacks them."""
    have = lambda c, t: (F.col(c).cast(t) if c in docs.columns else F.lit(None).cast(t)).alias(c)
    return docs.select("doc_id", have("text", "string"), have("lang", "string"), have("source", "string"), have("n_chars", "long"))


def _arrays(t: pa.Table) -> dict:
    if not t.num_rows:
        return {"words": [], "dense": np.zeros((0, DENSE)), "meta": np.zeros((0, META)), "group": np.zeros(0, dtype=int)}
    flat, row, dense, at = _unpacked(t.to_batches()[0])
    words = [w.astype(np.int64) for w in np.split(flat, np.cumsum(np.bincount(row, minlength=t.num_rows))[:-1])]
    meta = np.zeros((t.num_rows, META))
    np.add.at(meta, (np.repeat(np.arange(t.num_rows), 3), at.reshape(-1)), 1)
    return {"words": words, "dense": dense, "meta": meta, "group": _groups(words, dense)}


def _only(arrays: dict, known: np.ndarray) -> dict:
    """The rows that have a label for one target."""
    group = np.unique(arrays["group"][known], return_inverse=True)[1] if known.any() else np.zeros(0, dtype=int)
    return {"words": [w for w, k in zip(arrays["words"], known) if k], "dense": arrays["dense"][known], "meta": arrays["meta"][known], "group": group}


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, made: DataFrame | None = None) -> dict[str, CoTrained | float]:
    """A model for each target; a constant where its labels have one class only, which no model can be fitted to (none:
    quality 1, toxic 0).

    Labels of one document that differ count by their mean, rounded; a null leaves out that target only. Of rows with the
    same doc_id one is fitted to, that with the least content hash. Rows without doc_id are unlabelled, and so are those
    whose labels are beyond the sample. `made` are the documents' features, if they are there already."""
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.round(F.avg(t)).cast("int").alias(t) for t in TARGETS]).filter("quality is not null or toxic is not null")
    made = features(docs) if made is None else made
    # at most max_labelled rows of three numbers, so both joins below are broadcasts and nothing wide is shuffled by them
    taken = stored(known.join(made.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")
    one = made.join(F.broadcast(taken), "doc_id").groupBy("doc_id", *TARGETS).agg(F.min(F.struct("key", "words", "dense", "meta")).alias("r"))
    labelled = one.select("doc_id", "r.*", *TARGETS).toArrow().sort_by([("key", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    arrays = _arrays(labelled)
    out: dict[str, CoTrained | float] = {}
    for t, default in zip(TARGETS, (1.0, 0.0)):
        there = labelled[t].is_valid().to_numpy() if labelled.num_rows else np.zeros(0, dtype=bool)
        y = np.array([v for v in labelled[t].to_pylist() if v is not None], dtype=float)
        out[t] = CoTrained(_only(arrays, there), y) if len(np.unique(y)) == 2 else y[0] if len(y) else default
    models = {t: m for t, m in out.items() if isinstance(m, CoTrained)}
    if models and rounds:
        pool = _pool(made.join(F.broadcast(taken.select("doc_id")), "doc_id", "left_anti"))
        for _ in range(rounds):
            gifts, judges = _gifts(pool, models), {t: m.flat_views() for t, m in models.items()}
            for t, m in models.items():
                m.learn(gifts[t])
            for _ in range(STEPS if any(g.rows.any() for g in gifts.values()) else 0):
                for t, more in _far(pool, models, gifts, judges).items():
                    models[t].text.step(more)
        dropped(pool)
    for m in models.values():
        m.join_views()
    return out


def scored(docs: DataFrame, models: dict) -> DataFrame:
    """docs' columns plus p_quality, p_toxic and keep (good and not toxic), for every row.

    A null text counts as empty. Input columns with these names are replaced."""
    flat = {t: m.flat() if isinstance(m, CoTrained) else m for t, m in models.items()}
    held = docs.sparkSession.sparkContext.broadcast(flat)
    keep = [c for c in docs.columns if c not in ("p_quality", "p_toxic", "keep")]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = small_batches(docs).select(*keep, F.struct(*[c for c in _columns(docs).columns[1:] if c in docs.columns]).alias("_view"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = held.value
        _begin()
        for b in batches:
            view = b.column(len(keep))
            names = [f.name for f in view.type]
            column = lambda c: view.field(c).to_pylist() if c in names else [None] * b.num_rows
            views = [text_view(t) for t in column("text")]
            meta = np.array([meta_view(*m) for m in zip(*map(column, VIEW[1:]))]).reshape(-1, 3)
            words = np.concatenate([w for w, _ in views]) if views else np.zeros(0, dtype=np.int32)
            row, dense = np.repeat(np.arange(len(views)), [len(w) for w, _ in views]), np.array([x for _, x in views], dtype=float).reshape(-1, DENSE)
            made = {t: _scores(m, words, row, dense, meta) if isinstance(m, dict) else np.full(b.num_rows, m) for t, m in models.items()}
            good = (made["quality"] >= 0.5) & (made["toxic"] < 0.5)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(made["quality"]), pa.array(made["toxic"]), pa.array(good)], names=[*keep, "p_quality", "p_toxic", "keep"])

    return rows.mapInArrow(run, ", ".join(f"`{c}` {fields[c]}" for c in keep) + ", p_quality double, p_toxic double, keep boolean")


def scored_features(made: DataFrame, models: dict) -> DataFrame:
    """doc_id, p_quality, p_toxic and keep of every row of features()."""
    flat = {t: m.flat() if isinstance(m, CoTrained) else m for t, m in models.items()}
    held = made.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, row, dense, meta = _unpacked(b)
            p = [_scores(m, words, row, dense, meta) if isinstance(m, dict) else np.full(b.num_rows, m) for m in (held.value[t] for t in TARGETS)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p[0]), pa.array(p[1]), pa.array((p[0] >= 0.5) & (p[1] < 0.5))], names=["doc_id", "p_quality", "p_toxic", "keep"])

    kind = made.schema["doc_id"].dataType.simpleString()
    return made.select("doc_id", "words", "dense", "meta").mapInArrow(run, f"doc_id {kind}, p_quality double, p_toxic double, keep boolean")


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by models fitted to the labels and to all unlabelled documents."""
    made = features(table(spark, sf_dir, "documents"))
    rows = scored_features(made, fit(made, table(spark, sf_dir, "labels"), made=made))
    return rows.select("doc_id", F.round("p_quality", 6).alias("p_quality"), F.round("p_toxic", 6).alias("p_toxic"), "keep")
