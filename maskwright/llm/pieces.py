"""SentencePiece encoding and decoding with n-best segmentation.

A text is a lattice of vocabulary pieces. Forward Viterbi gives the best score of every prefix; run backward from the
end, A* search takes these as its heuristic, which is exact, so complete paths leave the agenda best first.

No piece of the vocabulary spans the place where a space follows another character, so the lattice of a text is a chain
of small ones, its chunks. Distinct chunks are scored together, one position at a time over all chunks of a length, and
remembered. The second-best path of a chunk follows from forward and backward scores: it is the best path through an
edge that is not on the best path. The n best of a text differ from the best only in the n - 1 chunks that give up least,
so the search runs over those chunks' lattices, and their lists are merged: each of the n best is the best ids with those
of some chunks replaced.

Encoding keeps every character: spaces become piece marks, what the vocabulary lacks becomes byte pieces, and decoding
returns the exact text.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begins, small_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG, KEPT = 40, 400_000
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Scores are whole millionths, so that sums are exact and equal paths tie; NONE is below any sum.
UNIT, NONE = 1_000_000, -(1 << 60)


def read_model(path: str, scores: str = "auto") -> list[tuple[str, float, int]]:
    """(piece, score, byte or -1) of each id; unused, unknown and control pieces have an empty string.

    Scores are the model's own for unigram models. A merge model's scores are only ranks (auto: all whole numbers), so a
    piece of rank r gets -ln(r + 10), as a frequency by rank would."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    raw = [sp.get_score(i) for i in range(n)]
    ranked = scores == "rank" or scores == "auto" and all(x == int(x) for x in raw) and min(raw) < -1000
    out, rank = [], 0
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(("", 0.0, int(piece[3:5], 16)))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(("", 0.0, -1))
        else:
            out.append((piece.replace(MARK, " "), -math.log(rank + 10) if ranked else raw[i], -1))
            rank += 1
    return out


class Pieces:
    """A vocabulary: encoding, n-best lists and decoding of texts."""

    def __init__(self, model: list[tuple[str, float, int]]):
        self.ids = {p: i for i, (p, _, _) in enumerate(model) if p and MARK not in p}
        self.score = {p: round(model[i][1] * UNIT) for p, i in self.ids.items()}
        self.bytes = {b: i for i, (_, _, b) in enumerate(model) if b >= 0}
        self.raw = [p.encode() if b < 0 else bytes((b,)) for p, _, b in model]
        self.spelled = [b"%d " % i for i in range(len(model))]
        self._wide = np.array([*map(len, self.spelled)], dtype=np.int64)
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces, so texts would not come back whole")
        self.longest = max(map(len, self.ids))
        # characters that no longer piece has stand alone; a chunk is spaces with what follows them
        alone = re.escape("".join({*map(chr, range(32)), MARK} - {c for p in self.ids if len(p) > 1 for c in p}))
        whole = any(" " in p.lstrip(" ") for p in self.ids)
        self._cut = re.compile(f"[^{alone}]+|[{alone}]" if whole else f"[ ]*[^ {alone}]+|[ ]+|[{alone}]")
        self.byte_score = min(self.score.values()) - 2 * UNIT
        self._by_length = []
        for n in range(1, self.longest + 1):
            own = [p for p in self.ids if len(p) == n]
            h = self._hash(np.array([[ord(c) for c in p] for p in own], dtype=np.uint64).reshape(-1, n))
            order = np.argsort(h)
            h = h[order]
            if len(np.unique(h)) < len(h):
                raise ValueError("two pieces share a hash")
            self._by_length.append((h, np.array([self.ids[p] for p in own], dtype=np.int64)[order], np.array([self.score[p] for p in own], dtype=np.int64)[order]))
        # one bit for each hashed piece keeps most lookups out of the sorted tables
        self._sieve = np.zeros(1 << 21, dtype=bool)
        for h, _, _ in self._by_length:
            self._sieve[(h >> np.uint64(43)).astype(np.int64)] = True
        self.forget()

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(codes.shape[0], dtype=np.uint64)
        for k in range(codes.shape[1]):
            h = (h + codes[:, k] + np.uint64(1)) * BASE
        return h

    def forget(self) -> None:
        self._place: dict[str, int] = {}
        self._listed: dict[str, list] = {}
        self._encoded: list[bytes] = []
        self._best, self._loss, self._count, self._uses = (np.zeros(1024, dtype=np.int64) for _ in range(4))

    def _thin(self) -> None:
        """Forget the chunks that were used once, or not since the last time, and so many more that half of KEPT is free."""
        n = len(self._encoded)
        keep = np.flatnonzero(self._uses[:n] > 1)
        if len(keep) > KEPT // 2:
            keep = np.sort(keep[np.argpartition(-self._uses[keep], KEPT // 2)[: KEPT // 2]])
        chunks, encoded = [*self._place], self._encoded  # in the order of their places
        self._place = {chunks[i]: k for k, i in enumerate(keep.tolist())}
        self._encoded = [encoded[i] for i in keep.tolist()]
        self._best, self._loss, self._count = self._best[keep], self._loss[keep], self._count[keep]
        self._uses = np.ones(len(keep), dtype=np.int64)
        self._listed.clear()

    # ------------------------------------------------------------ chunks

    def chunks(self, text: str) -> list[str]:
        """Independent parts of the text with its leading dummy space; their concatenation is that text."""
        return self._cut.findall(" " + text)

    def _edges(self, chunk: str, end: int) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(start, score, ids) of the pieces that end here; a character without a piece becomes its bytes."""
        for start in range(max(0, end - self.longest), end):
            p = chunk[start:end]
            i = self.ids.get(p)
            if i is not None:
                yield start, self.score[p], (i,)
            elif end - start == 1:
                b = p.encode("utf-8", "surrogatepass")
                yield start, self.byte_score * len(b), tuple(self.bytes[x] for x in b)

    def n_best_chunk(self, chunk: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The n best segmentations of a chunk, best first: forward Viterbi, then A* from the end."""
        size = len(chunk)
        edges = [[], *([*self._edges(chunk, end)] for end in range(1, size + 1))]
        ahead = [0] + [NONE] * size
        for end in range(1, size + 1):
            ahead[end] = max(ahead[start] + s for start, s, _ in edges[end])
        tick = count()
        agenda = [(-ahead[size], size, next(tick), 0, None)]  # among equals, those nearest to the start first
        out = []
        while agenda and len(out) < n:
            cost, at, _, done, path = heapq.heappop(agenda)
            if not at:
                ids = []
                while path:
                    ids.extend(path[0])
                    path = path[1]
                out.append((-cost, tuple(ids)))
                continue
            for start, s, ids in edges[at]:
                heapq.heappush(agenda, (-(ahead[start] + s + done), start, next(tick), done + s, (ids, path)))
        return out

    # ------------------------------------------------------------ many chunks at once

    def _learn(self, chunks: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for c in chunks:
            by_size.setdefault(len(c) if len(c) <= LONG else 0, []).append(c)
        for size, own in by_size.items():
            if not size:
                for c in own:
                    two = self.n_best_chunk(c, 2)
                    self._add([c], [np.array(two[0][1], dtype="<i4").tobytes()], two[0][0], two[0][0] - two[1][0] if len(two) > 1 else -NONE, len(two[0][1]))
                continue
            for k in range(0, len(own), 4096):
                self._learn_equal(own[k : k + 4096], size)

    def _add(self, chunks: list[str], coded: list[bytes], best, loss, counts) -> None:
        n, m = len(self._encoded), len(chunks)
        if n + m > len(self._best):
            self._best, self._loss, self._count, self._uses = (np.concatenate((x, np.zeros(n + m, dtype=np.int64))) for x in (self._best, self._loss, self._count, self._uses))
        self._place.update(zip(chunks, range(n, n + m)))
        self._encoded += coded
        self._best[n : n + m], self._loss[n : n + m], self._count[n : n + m], self._uses[n : n + m] = best, loss, counts, 0

    def _learn_equal(self, chunks: list[str], size: int) -> None:
        m = len(chunks)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(m, size).astype(np.uint64)
        bytes_of = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        scores: dict[int, np.ndarray] = {}
        ids: dict[int, np.ndarray] = {}
        h = np.zeros((m, size), dtype=np.uint64)
        for n in range(1, min(size, self.longest) + 1):
            h = (h[:, : size - n + 1] + codes[:, n - 1 :] + np.uint64(1)) * BASE
            table_h, table_id, table_s = self._by_length[n - 1]
            r, c = np.nonzero(self._sieve[(h >> np.uint64(43)).astype(np.int64)])
            if len(r) and len(table_h):
                own = h[r, c]
                at = np.minimum(np.searchsorted(table_h, own), len(table_h) - 1)
                hit = table_h[at] == own
                r, c, at = r[hit], c[hit], at[hit]
            if n > 1 and not (len(r) and len(table_h)):
                continue  # no chunk has a piece of this length
            s, i = np.full(h.shape, NONE, dtype=np.int64), np.full(h.shape, -1, dtype=np.int64)
            if len(r) and len(table_h):
                s[r, c], i[r, c] = table_s[at], table_id[at]
            if n == 1:
                s = np.where(i < 0, self.byte_score * bytes_of, s)
            scores[n], ids[n] = s, i
        lengths_of = sorted(scores)
        ahead, came = np.full((m, size + 1), NONE, dtype=np.int64), np.zeros((m, size + 1), dtype=np.int64)
        ahead[:, 0] = 0
        for end in range(1, size + 1):
            for n in lengths_of:
                if n > end:
                    break
                x = ahead[:, end - n] + scores[n][:, end - n]
                better = x > ahead[:, end]
                ahead[better, end] = x[better]
                came[better, end] = n
        back = np.full((m, size + 1), NONE, dtype=np.int64)
        back[:, size] = 0
        for start in range(size - 1, -1, -1):
            for n in lengths_of:
                if n > size - start:
                    break
                np.maximum(back[:, start], back[:, start + n] + scores[n][:, start], out=back[:, start])
        at = np.full(m, size)
        taken = np.full((m, size), -2, dtype=np.int64)  # id of the best path's piece by where it starts
        rows = np.arange(m)
        through = {n: ahead[:, : size - n + 1] + scores[n] + back[:, n:] for n in lengths_of}
        while len(rows):
            n = came[rows, at[rows]]
            begin = at[rows] - n
            for k in np.unique(n).tolist():
                w = n == k
                taken[rows[w], begin[w]] = ids[k][rows[w], begin[w]]
                through[k][rows[w], begin[w]] = NONE
            at[rows] = begin
            rows = rows[begin > 0]
        best = ahead[:, size]
        second = np.max([t.max(axis=1) for t in through.values()], axis=0)
        loss = np.where(second < NONE // 2, -NONE, best - second)
        flat = taken[taken > -2]
        plain = ~(taken == -1).any(axis=1)
        lengths = (taken > -2).sum(axis=1)
        ends = np.cumsum(lengths) * 4
        data = flat.astype("<i4").tobytes()
        stops = ends.tolist()
        coded = [data[a:z] for a, z in zip([0, *stops[:-1]], stops)]
        for k in np.flatnonzero(~plain).tolist():
            spelled = []
            for p, i in enumerate(taken[k].tolist()):
                if i >= 0:
                    spelled.append(i)
                elif i == -1:
                    spelled.extend(self.bytes[v] for v in chunks[k][p].encode("utf-8", "surrogatepass"))
            coded[k] = np.array(spelled, dtype="<i4").tobytes()
            lengths[k] = len(spelled)
        self._add(chunks, coded, best, loss, lengths)

    # ------------------------------------------------------------ texts

    def encode(self, texts: list[str], n: int = 3) -> list[tuple[bytes, list[tuple[float, int]]]]:
        """Of each text: its best ids (int32, little-endian), and (score, pieces) of its n best segmentations."""
        return [(best[0][1], [(s, len(i) // 4) for s, i in best]) for best in self.n_best(texts, n)]

    def n_best(self, texts: list[str], n: int = 3) -> list[list[tuple[float, bytes]]]:
        """(score, ids) of the n best segmentations of each text, best first; ids are int32, little-endian."""
        parts = [self.chunks(t) for t in texts]
        missing = set().union(*parts).difference(self._place)
        if missing:
            if len(self._place) + len(missing) > KEPT:
                self._thin()
                missing = set().union(*parts).difference(self._place)
            self._learn([*missing])
        out = []
        for chunks in parts:
            place = np.fromiter(map(self._place.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            self._uses[place] += 1  # once a text
            ids = b"".join([self._encoded[i] for i in place.tolist()])
            out.append(self._merged(chunks, place, ids, n))
        return out

    def _merged(self, chunks: list[str], place: np.ndarray, ids: bytes, n: int) -> list[tuple[float, bytes]]:
        """The n best, each the best ids with those of some chunks replaced."""
        loss = self._loss[place]
        ranked = [(int(self._best[place].sum()), ())]
        if n > 1:
            give = np.argpartition(loss, n - 2)[: n - 1] if len(loss) > n - 1 else np.arange(len(loss))
            for k in sorted(give.tolist()):
                if loss[k] == -NONE:
                    continue
                steps = self._steps(chunks[k], n)
                # stable, so that among equals the best ids stay first
                ranked = sorted(((a + b, (*c, (k, d)) if j else c) for a, c in ranked for j, (b, d) in enumerate(steps)), key=lambda x: -x[0])[:n]
        if len(ranked) == 1:
            return [(ranked[0][0] / UNIT, ids)]
        ends = np.cumsum(self._count[place]) * 4
        out = []
        for s, changes in ranked:
            made, at = [], 0
            for k, own in changes:
                made += [ids[at : ends[k] - len(self._encoded[place[k]])], own]
                at = ends[k]
            out.append((s / UNIT, b"".join([*made, ids[at:]])))
        return out

    def _steps(self, chunk: str, n: int) -> list[tuple[int, bytes]]:
        """What the n best of a chunk lose against the best, and their ids; the first are the ids kept for the chunk."""
        key = f"{n}|{chunk}"
        if key not in self._listed:
            if len(self._listed) > KEPT // 8:
                self._listed.clear()
            own = [(s, np.array(ids, dtype="<i4").tobytes()) for s, ids in self.n_best_chunk(chunk, n)]
            first = self._encoded[self._place[chunk]]  # among equals another may lead, or fill the list
            rest = [(s - own[0][0], ids) for s, ids in own if ids != first]
            self._listed[key] = [(0, first), *rest[: n - 1]]
        return self._listed[key]

    def spell(self, lists: list[bytes]) -> list[bytes]:
        """Each list of ids in decimal, joined by spaces; the others take from the first what they share at both ends."""
        first, out = np.frombuffer(lists[0], dtype="<i4"), []
        whole = b"".join(map(self.spelled.__getitem__, first.tolist()))
        out.append(whole[:-1])
        ends = np.concatenate(([0], np.cumsum(self._wide[first]))) if len(lists) > 1 else None
        for ids in lists[1:]:
            own = np.frombuffer(ids, dtype="<i4")
            m = min(len(first), len(own))
            differ = np.flatnonzero(first[:m] != own[:m])
            a = int(differ[0]) if len(differ) else m
            differ = np.flatnonzero(first[len(first) - m + a :][::-1] != own[len(own) - m + a :][::-1])
            z = int(differ[0]) if len(differ) else m - a
            middle = map(self.spelled.__getitem__, own[a : len(own) - z].tolist())
            out.append(b"".join([whole[: ends[a]], *middle, whole[ends[len(first) - z] :]])[:-1])
        return out

    def decode(self, ids: bytes) -> str:
        """The exact text of encoded ids."""
        raw = self.raw
        return b"".join([raw[i] for i in np.frombuffer(ids, dtype="<i4").tolist()])[1:].decode("utf-8", "surrogatepass")


_coder: list = []  # the last vocabulary of this worker with what it has learnt, for the next task


def _coder_of(model: list) -> Pieces:
    begins("pieces", _coder.clear)
    if not _coder or _coder[0] is not model:
        _coder[:] = [model, Pieces(model)]
    return _coder[1]


def _by_batch(docs: DataFrame, model: str, n: int, scores: str, schema: str, make: Callable[[Pieces, list[list[tuple[float, bytes]]]], list[pa.Array]]) -> DataFrame:
    """doc_id and the columns that make() builds of the n best segmentations of 1,024 texts at a time."""
    held = docs.sparkSession.sparkContext.broadcast(read_model(model, scores))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder_of(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                columns = make(coder, coder.n_best([t or "" for t in b.column(1).to_pylist()], n))
                yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", *names])

    rows = small_batches(docs).select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def segmented(docs: DataFrame, model: str = MODEL, n: int = 3, scores: str = "auto") -> DataFrame:
    """doc_id, ids (array<int>), n_best (array of score, pieces and ids, best first) and decoded text of every row of docs.

    A null text is the empty text, whose one piece is the leading space. Repeated rows are all returned, equal, and very
    long texts are encoded whole. Other columns are ignored. Empty in, empty out. The model is read on the driver; its
    vocabulary, of fixed size, is broadcast."""
    flat = lambda parts: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(i) // 4 for i in parts)]), pa.int32()), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))

    def make(coder: Pieces, found: list) -> list[pa.Array]:
        every = [x for best in found for x in best]
        parts, firsts = [i for _, i in every], [best[0][1] for best in found]
        each = pa.StructArray.from_arrays([pa.array([s for s, _ in every], pa.float64()), pa.array([len(i) // 4 for i in parts], pa.int32()), flat(parts)], names=["score", "pieces", "ids"])
        return [flat(firsts), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), each), pa.array([coder.decode(i) for i in firsts], pa.string())]

    return _by_batch(docs, model, n, scores, "ids array<int>, n_best array<struct<score:double,pieces:int,ids:array<int>>>, decoded string", make)


def digested(docs: DataFrame, model: str = MODEL, n: int = 3, scores: str = "auto") -> DataFrame:
    """digests(segmented(docs)), row for row, with the digests taken where the ids are, so that these need not travel."""

    def make(coder: Pieces, found: list) -> list[pa.Array]:
        firsts = [best[0][1] for best in found]
        every = [[hashlib.sha256(x).hexdigest() for x in coder.spell([i for _, i in best])] for best in found]
        decoded = [hashlib.sha256(coder.decode(i).encode("utf-8", "surrogatepass")).hexdigest() for i in firsts]
        return [pa.array([len(i) // 4 for i in firsts], pa.int64()), pa.array([d[0] for d in every], pa.string()), pa.array([[s for s, _ in best] for best in found], pa.list_(pa.float64())), pa.array(decoded, pa.string()), pa.array(every, pa.list_(pa.string()))]

    rows = _by_batch(docs, model, n, scores, "n_pieces long, ids_sha256 string, n_best_scores array<double>, decoded_sha256 string, n_best_sha256 array<string>", make)
    return rows.withColumn("n_best_scores", F.transform("n_best_scores", lambda s: F.round(s, 4)))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the ids joined by spaces), scores of the n best, decoded_sha256, and the digests
    of the ids of the n best."""
    scores = F.transform("n_best", lambda b: F.round(b["score"], 4))
    digest = lambda ids: F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), digest(F.col("ids")).alias("ids_sha256"), scores.alias("n_best_scores"), F.sha2("decoded", 256).alias("decoded_sha256"), F.transform("n_best", lambda b: digest(b["ids"])).alias("n_best_sha256")
    )


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Digests of the n best segmentations of every whole text of documents, and of the text decoded from the best."""
    return digested(table(spark, sf_dir, "documents").select("doc_id", "text"))
