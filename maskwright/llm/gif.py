"""GIF media: decode code streams, palettes, disposal and transparency to timed frames with colour histograms.

`frames` follows the GIF89a layout and yields one frame at a time over one running canvas. Between two clear codes the
width of the n-th code depends on n alone, so all codes of such a run are cut from the bit string at once, with 12-bit
codes for as long as a clear code is deferred; the codes of a run are expanded together. `encode_bytes` stores any
bytes as 8-bit indices of a 256-colour picture, in frames of at most FRAME_ROWS rows.

Sizes in a file are claims: root sizes beyond 2 to 8 bits and pictures of more than MAX_PIXELS are refused, and the
canvas is no larger than what the frames touch.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text, small_batches, table

UNIT, FRAME_ROWS, DELAY = 192, 4096, 4
MAX_PIXELS = 1 << 26  # of a canvas or frame
BINS = 8
#: What a damaged or hostile file may raise.
BROKEN = (ValueError, struct.error, IndexError)


@dataclass
class Frame:
    """One picture of a file: when it shows (centiseconds), its indices, and the canvas after drawing it, a 32-bit number
    a pixel (red in the low byte, then green, blue, and 255 for opaque). The canvas is valid until the next frame."""

    start: int
    delay: int
    disposal: int
    transparent: int | None
    indices: np.ndarray
    canvas: np.ndarray


# ---------------------------------------------------------------- LZW


def _bits(data: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Codes of up to 12 bits that begin at these bit offsets, least significant bit first."""
    byte = at >> 3
    word = data[byte].astype(np.uint32) | data[byte + 1].astype(np.uint32) << 8 | data[byte + 2].astype(np.uint32) << 16
    return ((word >> (at & 7).astype(np.uint32)) & ((1 << width) - 1).astype(np.uint32)).astype(np.int64)


@lru_cache(maxsize=16)
def _offsets(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offset and width of each code after a clear code, as far as the table grows, and a stretch beyond."""
    clear = 1 << size
    entries = clear + 2 + np.maximum(np.arange(4096) - 1, 0)  # entries known when code n is read
    width = np.maximum(size + 1, np.minimum(12, np.floor(np.log2(np.maximum(entries, 1))).astype(np.int64) + 1))
    return np.concatenate(([0], np.cumsum(width)[:-1])), width


def _deferred(data: np.ndarray, base: int, past: int, total: int, codes: np.ndarray, stop: tuple[int, int], most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The codes of a run that outlasts _offsets, up to its first clear or end code: the table is full, so 12-bit codes
    go on. With them, where that code is (or nowhere), and how far from base the run reaches."""
    parts, n = [codes], len(codes)
    while n < most:
        at = base + past + 12 * np.arange(min(n, (total - base - past) // 12))
        if not len(at):
            break
        more = _bits(data, at, np.full(len(at), 12))
        found = np.nonzero((more == stop[0]) | (more == stop[1]))[0]
        more = more[: found[0] + 1] if len(found) else more
        parts.append(more)
        n, past = n + len(more), past + 12 * len(more)
        if len(found):
            return np.concatenate(parts), np.array([n - 1]), past
    return np.concatenate(parts), np.zeros(0, dtype=np.int64), past


def _expanded(run: np.ndarray, clear: int, most: int) -> tuple[np.ndarray, bool]:
    """Samples of the codes between two clear codes, at most `most`, and whether all codes were valid.

    Table entry j stands for what code j put out and one sample more, and both lie in the output. So a code is a reference
    to the place of an earlier one, and all references are followed at once, halving the way each time."""
    n = len(run)
    index = np.arange(n)
    literal, parent = run < clear, run - (clear + 2)
    bad = np.nonzero(~literal & (parent >= index))[0]
    if len(bad):
        run, index, literal, parent = (x[: bad[0]] for x in (run, index, literal, parent))
    if not len(run):
        return np.zeros(0, dtype=np.uint8), not len(bad)
    length, to = (~literal).astype(np.int64), np.where(literal, index, parent)
    while True:
        beyond = to[to]
        if (beyond == to).all():
            break
        length, to = length + length[to], beyond
    length += 1
    start = np.cumsum(length) - length
    if start[-1] + length[-1] > most:
        k = int(np.searchsorted(start, most))
        run, literal, parent, length, start, index = run[:k], literal[:k], parent[:k], length[:k], start[:k], index[:k]
    at = np.arange(int(start[-1] + length[-1]))
    source = at - np.repeat(np.where(literal, 0, start - start[np.where(literal, index, parent)]), length)
    value = np.repeat(run, length).astype(np.uint8)
    while True:
        beyond = source[source]
        if (beyond == source).all():
            return value[source], not len(bad)
        source = beyond


def lzw_decode(size: int, stream: bytes, expect: int) -> np.ndarray:
    """Indices of one code stream with root size `size`, at most `expect` of them. A broken stream gives what came before."""
    clear, end = 1 << size, (1 << size) + 1
    data = np.frombuffer(stream + b"\0\0\0\0", dtype=np.uint8)
    total = len(stream) * 8
    at_in_run, widths = _offsets(size)
    ends = at_in_run + widths
    out, have, base = [], 0, 0
    while base < total and have < expect:
        n = int(np.searchsorted(ends, total - base, side="right"))
        if not n:
            break
        codes = _bits(data, base + at_in_run[:n], widths[:n])
        stops = np.nonzero((codes == clear) | (codes == end))[0]
        past = int(ends[n - 1])
        if n == len(at_in_run) and not len(stops):
            codes, stops, past = _deferred(data, base, past, total, codes, (clear, end), expect - have)
            n = len(codes)
        stop = int(stops[0]) if len(stops) else n
        if stop:
            piece, whole = _expanded(codes[:stop], clear, expect - have)
            out.append(piece)
            have += len(piece)
            if not whole:
                break
        if stop == n or codes[stop] == end:
            break
        base += int(ends[stop]) if stop < len(at_in_run) else past
    return np.concatenate(out)[:expect] if out else np.zeros(0, dtype=np.uint8)


def lzw_encode(data: bytes) -> bytes:
    """A code stream for 8-bit samples, with a clear code first and wherever the table is full, and an end code."""
    codes, runs = [256], []
    table: dict[int, int] = {}
    look, put, free = table.get, codes.append, 258 << 8
    # a code stands here with its eight low bits free for the next sample
    now = data[0] << 8 if data else 0
    for x in memoryview(data)[1:]:
        longer = look(now | x)
        if longer:
            now = longer
        else:
            put(now >> 8)
            if free < 4096 << 8:
                table[now | x] = free
                free += 256
            else:
                put(256)
                runs.append(len(codes))
                table.clear()
                free = 258 << 8
            now = x << 8
    if data:
        put(now >> 8)
    put(257)
    value = np.array(codes, dtype=np.uint32)
    # place of each code in its run, the clear code that ends a run counting with it
    begin = np.array([1, *runs], dtype=np.int64)
    place = np.arange(len(codes)) - np.repeat(begin, np.diff([0, *begin[1:], len(codes)]))
    width = np.where(place < 0, 9, _offsets(8)[1][np.maximum(place, 0)])
    at = np.concatenate(([0], np.cumsum(width)))
    byte, moved = at[:-1] >> 3, value << (at[:-1] & 7).astype(np.uint32)
    size = (int(at[-1]) + 7 >> 3) + 3
    # codes share bytes but no bits, so sums put them together
    out = sum(np.bincount(byte + k, (moved >> np.uint32(8 * k)) & np.uint32(255), size) for k in range(3))
    return out.astype(np.uint8)[: size - 3].tobytes()


# ---------------------------------------------------------------- container


def _blocks(stream: bytes) -> bytes:
    full = len(stream) // 255 * 255
    body = np.frombuffer(stream[:full], dtype=np.uint8).reshape(-1, 255)
    head = np.concatenate((np.full((len(body), 1), 255, dtype=np.uint8), body), axis=1).tobytes() if full else b""
    rest = stream[full:]
    return head + (bytes((len(rest),)) + rest if rest else b"") + b"\0"


def encode_bytes(payload: bytes) -> bytes:
    """A GIF whose samples are these bytes, UNIT a row; the length must be a positive multiple of UNIT. The palette is grey."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT)
    height = min(len(rows), FRAME_ROWS)
    grey = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
    out = [b"GIF89a", struct.pack("<HHBBB", UNIT, height, 0xF7, 0, 0), grey]
    for k in range(0, len(rows), height):
        part = rows[k : k + height]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, DELAY, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, UNIT, len(part), 0), b"\x08", _blocks(lzw_encode(part.tobytes()))]
    return b"".join([*out, b"\x3b"])


def _sub_blocks(b: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(b) and b[at]:
        parts.append(b[at + 1 : at + 1 + b[at]])
        at += 1 + b[at]
    return b"".join(parts), at + 1


def _layout(b: bytes) -> Iterator[tuple]:
    """Control fields and pictures of a file in order: ("control", disposal, delay, transparent) and ("picture", x, y,
    width, height, interlaced, palette or None, root size, where its code stream begins)."""
    if b[:3] != b"GIF" or len(b) < 13:
        raise ValueError("not a GIF file")

    def colours(at: int, flags: int) -> tuple[np.ndarray | None, int]:
        if not flags & 0x80:
            return None, at
        n = 3 << ((flags & 7) + 1)
        rgb = np.frombuffer(b[at : at + n], dtype=np.uint8).reshape(-1, 3).astype(np.uint32)
        return rgb[:, 0] | rgb[:, 1] << 8 | rgb[:, 2] << 16 | np.uint32(0xFF000000), at + n

    shared, at = colours(13, b[10])
    while at < len(b) and b[at] in (0x21, 0x2C):
        if b[at] == 0x21:
            body, after = _sub_blocks(b, at + 2)
            if b[at + 1] == 0xF9 and len(body) >= 4:
                yield "control", body[0] >> 2 & 7, body[1] | body[2] << 8, body[3] if body[0] & 1 else None
            at = after
        else:
            x, y, w, h, flags = struct.unpack("<HHHHB", b[at + 1 : at + 10])
            own, at = colours(at + 10, flags)
            yield "picture", x, y, w, h, bool(flags & 0x40), shared if own is None else own, b[at], at + 1
            at += 1
            while at < len(b) and b[at]:
                at += 1 + b[at]
            at += 1


def _rows(h: int) -> np.ndarray:
    """Order of the rows of an interlaced picture."""
    return np.concatenate([np.arange(s, h, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])


def frames(b: bytes) -> Iterator[Frame]:
    """Frames of a GIF file, over one running canvas: transparent pixels leave it as it is; disposal 2 clears the frame's
    area afterwards, 3 puts back what was there before. The canvas is the screen, cut to what frames touch.

    Raises ValueError for other data, and for sizes that are refused; a file that ends early gives the frames before."""
    width, height = struct.unpack("<HH", b[6:10]) if len(b) >= 10 else (0, 0)
    right = bottom = 0
    for kind, *f in _layout(b):
        if kind == "picture":
            x, y, w, h, size = f[0], f[1], f[2], f[3], f[6]
            if not 2 <= size <= 8:
                raise ValueError(f"root size {size}")
            if w * h > MAX_PIXELS:
                raise ValueError(f"a picture of {w} x {h}")
            right, bottom = max(right, min(width, x + w)), max(bottom, min(height, y + h))
    if right * bottom > MAX_PIXELS:
        raise ValueError(f"a canvas of {right} x {bottom}")
    canvas = np.zeros((bottom, right), dtype=np.uint32)
    clock, delay, disposal, clear = 0, 0, 0, None
    for kind, *f in _layout(b):
        if kind == "control":
            disposal, delay, clear = f
            continue
        x, y, w, h, interlaced, palette, size, at = f
        indices = lzw_decode(size, _sub_blocks(b, at)[0], w * h)
        if len(indices) < w * h:
            indices = np.concatenate((indices, np.zeros(w * h - len(indices), dtype=np.uint8)))
        indices = indices.reshape(h, w)
        if interlaced:
            straight = np.empty_like(indices)
            straight[_rows(h)] = indices
            indices = straight
        area = canvas[y : y + h, x : x + w]
        own = indices[: area.shape[0], : area.shape[1]]
        before = area.copy() if disposal == 3 else None
        if palette is None or not len(palette):
            palette = np.full(1, 0xFF000000, dtype=np.uint32)
        # indices beyond the palette take its last colour
        drawn = np.concatenate((palette, np.full(max(0, 256 - len(palette)), palette[-1])))[own]
        area[...] = drawn if clear is None else np.where(own == clear, area, drawn)
        yield Frame(clock, delay, disposal, clear, indices, canvas)
        if disposal == 2:
            area[...] = 0
        elif disposal == 3:
            area[...] = before
        clock, delay, disposal, clear = clock + delay, 0, 0, None


def histograms(canvas: np.ndarray) -> list[list[int]]:
    """Counts of red, green and blue of the opaque pixels in BINS equal bins each."""
    flat = canvas.reshape(-1)
    seen = flat >> np.uint32(24) == 255
    flat = flat if seen.all() else flat[seen]
    shift = 8 - (BINS.bit_length() - 1)
    return [np.bincount(((flat >> np.uint32(8 * k)) & np.uint32(255)) >> np.uint32(shift), minlength=BINS).tolist() for k in range(3)]


FRAMES = {
    "key": ("long", pa.int64()), "frame": ("int", pa.int32()), "start_cs": ("long", pa.int64()), "delay_cs": ("int", pa.int32()), "disposal": ("int", pa.int32()),
    "width": ("int", pa.int32()), "height": ("int", pa.int32()), "red": ("array<long>", pa.list_(pa.int64())), "green": ("array<long>", pa.list_(pa.int64())), "blue": ("array<long>", pa.list_(pa.int64())),
    "pixels": ("binary", pa.binary()),
}
OUT_BYTES = 32 << 20  # of frames in one batch that goes back


def gif_frames(media: DataFrame, key: str = "media_id", column: str = "media") -> DataFrame:
    """One row for each frame of the GIF files in a binary column: key, frame, start_cs, delay_cs, disposal, width,
    height, red, green, blue (histograms of the opaque canvas pixels in 8 bins), pixels (RGBA bytes of the canvas).

    A null, a file that is not a GIF or one whose sizes are refused gives no row; of a file that breaks off, the frames
    before that. Frames go back as they are made. Other columns are ignored; equal rows give equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*made), FRAMES.values())], names=[*FRAMES])

        for b in batches:
            for k, media in zip(b.column(0).to_pylist(), b.column(1)):
                data = media.as_py()
                try:
                    for i, x in enumerate(frames(data) if data is not None else ()):
                        pixels = x.canvas.astype("<u4").tobytes()
                        made.append((k, i, x.start, x.delay, x.disposal, x.canvas.shape[1], x.canvas.shape[0], *histograms(x.canvas), pixels))
                        held += len(pixels)
                        if held > OUT_BYTES:
                            yield batch()
                            made, held = [], 0
                except BROKEN:
                    continue
        if made:
            yield batch()

    return small_batches(media).select(F.col(key).cast("long"), F.col(column).cast("binary")).mapInArrow(run, ", ".join(f"{k} {t}" for k, (t, _) in FRAMES.items()))


def text_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (a GIF with the padded text as samples) of every row; a null text counts as empty, a very long
    one becomes many frames. Repeated rows are all returned; other columns are ignored."""

    def work(texts: list) -> list:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        return [[len(r) for r in raw], [encode_bytes(r.ljust(max(1, -(-len(r) // UNIT)) * UNIT)) for r in raw]]

    return per_text(docs, ["doc_id"], {"n_bytes": ("long", pa.int64()), "media": ("binary", pa.binary())}, work)


FEATURES = {
    "payload_bytes": ("long", pa.int64()),
    "payload_sha256": ("string", pa.string()),
    "tail_crc32": ("long", pa.int64()),
    "media_bytes": ("long", pa.int64()),
    "media_sha256": ("string", pa.string()),
    "feature": ("string", pa.string()),
}


def read_back(media: DataFrame) -> DataFrame:
    """Decode each stored GIF and digest its samples: payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256 and feature (frames, total time, and the canvases' histograms of red, green and blue, summed)."""

    def one(b: bytes) -> tuple:
        payload, n, time, bins = [], 0, 0, np.zeros((3, BINS), dtype=np.int64)
        for x in frames(b):
            payload.append(x.indices.tobytes())
            n, time, bins = n + 1, x.start + x.delay, bins + np.array(histograms(x.canvas))
        whole = b"".join(payload)
        feature = "|".join([str(n), str(time), *(",".join(map(str, band)) for band in bins.tolist())])
        return len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-16:]), len(b), hashlib.sha256(b).hexdigest(), feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(b.as_py()) for b in batch.column("media")]
            made = [pa.array(x, t) for x, (_, t) in zip(zip(*rows) if rows else [[]] * len(FEATURES), FEATURES.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *made], names=["doc_id", "n_bytes", *FEATURES])

    kind = media.schema["doc_id"].dataType.simpleString()
    return small_batches(media).mapInArrow(run, f"doc_id {kind}, n_bytes long, " + ", ".join(f"{k} {t}" for k, (t, _) in FEATURES.items()))


def op7_media_gif(spark, sf_dir: str) -> DataFrame:
    """All documents as GIF files, read back from the stored bytes with canvas, timing and colour histograms."""
    return read_back(text_media(table(spark, sf_dir, "documents")))
