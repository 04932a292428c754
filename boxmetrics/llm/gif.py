"""GIF media columns: bytes to timed, composited frames with colour histograms, and back.

The decoder follows the GIF89a format: global and local palettes, variable
width LZW codes with clear and end codes, interlacing, transparency, the
disposal rules and frame delays. Damaged data never stops a job: what could be
decoded is kept and ``error`` says what went wrong.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

ROW = 64
FRAME_ROWS = 256
BINS = 4  # a channel


# ---------------------------------------------------------------- LZW


def lzw_encode(data: bytes, size: int = 8) -> bytes:
    """LZW code stream (least significant bit first) of samples below 2^size."""
    clear = 1 << size
    codes: list[int] = []
    lengths: list[int] = []  # codes between two clear codes
    it = iter(data)
    prefix = next(it, None)
    while prefix is not None:
        begun = len(codes)
        emit, put = codes.append, {}.setdefault
        free = clear + 2
        for c in it:
            code = put(prefix << 8 | c, free)
            if code != free:
                prefix = code
            else:
                emit(prefix)
                prefix = c
                free += 1
                if free == 4097:  # the code that would be 4096 is not made; start anew
                    break
        else:
            emit(prefix)
            prefix = None
        lengths.append(len(codes) - begun)
    # a clear code before each run, the end code after the last; both as wide as the codes before them
    width = _widths(size)[0]
    stream, widths, done, after = [], [], 0, size + 1
    for n in lengths or [0]:
        stream += (clear,)
        stream += codes[done : done + n]
        widths += ([after], width[:n])
        done, after = done + n, width[n]
    stream.append(clear + 1)
    return _packed(np.array(stream, np.uint32), np.concatenate([*widths, [after]]))


@lru_cache(maxsize=16)
def _widths(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the codes after a clear code while the table grows, and the bits before each of them."""
    width = np.minimum(12, np.frexp((1 << size) + 1 + np.maximum(np.arange(4097), 1))[1]).astype(np.int64)
    return width, np.concatenate([[0], np.cumsum(width)])


def _packed(codes: np.ndarray, widths: np.ndarray) -> bytes:
    ends = np.cumsum(widths)
    starts = ends - widths
    shifted = codes << (starts & 7).astype(np.uint32)
    size = int(ends[-1] + 7) // 8
    out = np.zeros(size + 3)
    for i in range(3):  # the codes share no bits, so a sum joins them
        part = np.bincount((starts >> 3) + i, weights=(shifted >> np.uint32(8 * i)) & np.uint32(255))
        out[: len(part)] += part
    return out[:size].astype(np.uint8).tobytes()


def _codes(data: np.ndarray, bit: int, width: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, int]:
    """The codes at ``bit`` of the widths given, as many as the data holds, and where they end.

    ``before`` are the bits before each code, one more than ``width``.
    """
    starts = bit + before
    whole = int(np.searchsorted(starts[1:], (len(data) - 3) * 8, side="right"))
    at = starts[:whole] >> 3
    word = data[at].astype(np.uint32) | data[at + 1].astype(np.uint32) << 8 | data[at + 2].astype(np.uint32) << 16
    return (word >> (starts[:whole] & 7).astype(np.uint32) & ((1 << width[:whole]) - 1).astype(np.uint32)), int(starts[whole])


_FULL = np.full(4096, 12, np.int64), np.arange(4097, dtype=np.int64) * 12


def lzw_samples(stream: bytes, size: int) -> Iterator[bytes | str]:
    """The samples of a code stream in pieces, then what is wrong with it (empty: it ended with its end code).

    A piece is what at most 64 codes stand for, so it and the table are bounded
    whatever the stream holds, and whoever has enough can stop reading.
    """
    if not 1 <= size <= 8:
        yield "bad code size"
        return
    data = np.frombuffer(stream + b"\0\0\0", np.uint8)
    clear, end = 1 << size, (1 << size) + 1
    literals = [bytes([i]) for i in range(clear)] + [b"", b""]
    bit = 0
    while True:  # a clear code, or the begin, was read: a new table
        table, last, stop = literals.copy(), b"", -1
        widths = _widths(size)[0][:4096], _widths(size)[1][:4097]
        while stop < 0:
            found, after = _codes(data, bit, *widths)
            if not len(found):
                yield "no end code"
                return
            stops = np.flatnonzero((found == clear) | (found == end))
            stop = int(stops[0]) if len(stops) else -1
            run = found[:stop].tolist() if stop >= 0 else found.tolist()
            n = len(table)
            for at in range(0, len(run), 64):
                out: list[bytes] = []
                for code in run[at : at + 64]:
                    if code < n:
                        entry = table[code]
                    elif code == n and last:
                        entry = last + last[:1]
                    else:
                        yield b"".join(out)
                        yield "bad code"
                        return
                    out.append(entry)
                    if n < 4096 and last:
                        table.append(last + entry[:1])
                        n += 1
                    last = entry
                yield b"".join(out)
            if stop >= 0 and found[stop] == end:
                yield ""
                return
            bit = bit + int(widths[1][stop + 1]) if stop >= 0 else after
            widths = _FULL  # the table is full and stays


def lzw_decode(stream: bytes, size: int, limit: int) -> tuple[bytes, str]:
    """Samples of a code stream, at most ``limit``, and what is wrong with it (empty: nothing)."""
    out, have = [], 0
    for piece in lzw_samples(stream, size):
        if isinstance(piece, str):
            return b"".join(out), piece or ("" if have == limit else "wrong number of samples")
        if have + len(piece) > limit:
            return b"".join(out) + piece[: limit - have], "wrong number of samples"
        out.append(piece)
        have += len(piece)
    return b"".join(out), "no end code"


# ---------------------------------------------------------------- container


@dataclass
class Frame:
    pixels: np.ndarray  # height x width x 4 (RGBA) of the composited canvas
    start_ms: int
    delay_ms: int
    box: tuple[int, int, int, int]  # left, top, width, height of the drawn part
    disposal: int
    any_drawn: bool = True


@dataclass
class Image:
    width: int = 0
    height: int = 0
    loops: int | None = None
    frames: list[Frame] = field(default_factory=list)
    error: str = ""


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and (n := data[at]):
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    raw = data[at : at + 3 * n].ljust(3 * n, b"\0")
    return np.frombuffer(raw, np.uint8).reshape(-1, 3), at + 3 * n


MAX_PIXELS = 1 << 24  # of a canvas held at a time; a larger one is composited in stripes of rows


def _stream_rows(height: int, laced: bool) -> list[tuple[int, int]]:
    """(first image row, step) of each pass in which a frame's rows are stored."""
    return [(0, 8), (4, 8), (2, 4), (1, 2)] if laced else [(0, 1)]


def _drawn_rows(stream: bytes, size: int, width: int, height: int, laced: bool, low: int, high: int, shown: int) -> tuple[np.ndarray, np.ndarray, str]:
    """Samples of the rows low..high and the first ``shown`` columns of a frame, which are there, and what is wrong with the stream.

    Samples outside are read over and not kept: a frame may be far larger than the canvas.
    """
    rows = max(0, high - low)
    index, there = np.zeros(rows * shown, np.uint8), np.zeros(rows * shown, bool)
    wanted = []  # (first sample in the stream, last, image row, row step)
    done = 0
    for first, step in _stream_rows(height, laced):
        n = len(range(first, height, step))
        skip = max(0, -(-(low - first) // step))
        upto = min(n, max(skip, -(-(high - first) // step)))
        if upto > skip:
            wanted.append(((done + skip) * width, (done + upto) * width, first + skip * step, step))
        done += n
    have, limit, wrong = 0, width * height, "no end code"
    for piece in lzw_samples(stream, size):
        if isinstance(piece, str):
            wrong = piece or ("" if have == limit else "wrong number of samples")
            break
        for begin, end, row, step in wanted:
            a, z = max(begin, have), min(end, have + len(piece))
            if a < z:
                got = np.frombuffer(piece, np.uint8)[a - have : z - have]
                if step == 1 and shown == width:
                    at = slice((row - low) * width + a - begin, (row - low) * width + z - begin)
                else:
                    place = np.arange(a - begin, z - begin)
                    seen = place % width < shown
                    place, got = place[seen], got[seen]
                    at = (row - low + place // width * step) * shown + place % width
                index[at], there[at] = got, True
        have += len(piece)
        if have > limit:
            wrong = "wrong number of samples"
            break
    return index.reshape(rows, shown), there.reshape(rows, shown), wrong


class Reader:
    """A GIF's canvas, and its frames one at a time, composited."""

    def __init__(self, data: bytes | None):
        self.data, self.width, self.height, self.loops, self.error = data or b"", 0, 0, None, ""
        if not data or data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
            self.error = "not a GIF" if data else "empty"
            return
        self.width, self.height, self.flags = struct.unpack_from("<HHB", data, 6)

    def stripes(self, max_pixels: int = MAX_PIXELS) -> list[tuple[int, int]]:
        """Rows (low, high) of the canvas that are composited at a time; none without a canvas."""
        rows = max(1, max_pixels // max(1, self.width))
        return [(r, min(self.height, r + rows)) for r in range(0, self.height, rows)] if self.width else []

    def frames(self, low: int, high: int) -> Iterator[Frame]:
        """The frames over the rows low..high of the canvas. A frame cut short keeps the pixels it has."""
        data, w = self.data, self.width
        common, at = _palette(data, 13, self.flags)
        canvas = np.zeros((high - low, w, 4), np.uint8)
        clock, delay, disposal, hidden = 0, 0, 0, None
        while at < len(data):
            kind = data[at]
            if kind == 0x3B:
                return
            if kind == 0x21 and at + 1 < len(data):
                body, after = _blocks(data, at + 2)
                if data[at + 1] == 0xF9 and len(body) >= 4:
                    disposal, delay = body[0] >> 2 & 7, struct.unpack_from("<H", body, 1)[0] * 10
                    hidden = body[3] if body[0] & 1 else None
                elif data[at + 1] == 0xFF and body[:11] == b"NETSCAPE2.0" and len(body) >= 14:
                    self.loops = struct.unpack_from("<H", body, 12)[0]
                at = after
                continue
            if kind != 0x2C or at + 10 > len(data):
                self.error = self.error or "unknown block"
                return
            x, y, fw, fh, fflags = struct.unpack_from("<HHHHB", data, at + 1)
            local, at = _palette(data, at + 10, fflags)
            if at >= len(data):
                self.error = self.error or "frame cut short"
                return
            size = data[at]
            stream, at = _blocks(data, at + 1)
            top, bottom = min(max(low - y, 0), fh), min(max(high - y, 0), fh)  # rows of the frame
            index, drawn, wrong = _drawn_rows(stream, size, fw, fh, bool(fflags & 0x40), top, bottom, min(fw, max(0, w - x)))
            self.error = self.error or wrong
            colours = local if local is not None else common if common is not None else np.zeros((1, 3), np.uint8)
            drawn &= index < len(colours)
            if hidden is not None:
                drawn &= index != hidden
            cw = max(0, min(fw, w - x))
            part, mask = index[:, :cw], drawn[:, :cw]
            region = canvas[max(0, y + top - low) :, x : x + cw][: bottom - top]
            before = region.copy() if disposal == 3 else None
            if mask.all():
                region[:, :, :3] = colours[part]
                region[:, :, 3] = 255
            else:
                region[mask] = np.concatenate([colours[part[mask]], np.full((int(mask.sum()), 1), 255, np.uint8)], axis=1)
            yield Frame(canvas, clock, delay, (x, max(0, y + top - low), cw, bottom - top), disposal, bool(mask.any()))
            clock += delay
            if disposal == 2:
                region[:] = 0
            elif disposal == 3:
                region[:] = before
            delay, disposal, hidden = 0, 0, None
        self.error = self.error or "no trailer"


def decode(data: bytes | None, max_pixels: int = MAX_PIXELS) -> Image:
    """All frames of a GIF at once, each with a canvas of its own; for images known to be small.

    Null, empty or foreign bytes give no frames and an error.
    """
    reader = Reader(data)
    parts = [[replace(f, pixels=f.pixels.copy()) for f in reader.frames(a, z)] for a, z in reader.stripes(max_pixels)]
    frames = [replace(f[0], pixels=np.concatenate([g.pixels for g in f]), box=_box([g.box for g in f], [a for a, _ in reader.stripes(max_pixels)])) for f in zip(*parts, strict=True)]
    return Image(reader.width, reader.height, reader.loops, frames, reader.error)


def _box(boxes: list[tuple[int, int, int, int]], tops: list[int]) -> tuple[int, int, int, int]:
    """The drawn part of a frame, from its parts in each stripe."""
    held = [(x, y + t, w, h) for (x, y, w, h), t in zip(boxes, tops, strict=True) if h]
    if not held:
        return (*boxes[0][:3], 0)
    return held[0][0], held[0][1], held[0][2], sum(h for *_, h in held)


def histogram(pixels: np.ndarray) -> list[int]:
    """Counts of the visible pixels by colour: 64 cells, red slowest, then one cell for hidden pixels."""
    flat = pixels.reshape(-1, 4)
    high = flat[:, :3] >> 6
    cell = high[:, 0] << 4 | high[:, 1] << 2 | high[:, 2]
    hidden = flat[:, 3] == 0
    if hidden.any():
        cell[hidden] = BINS**3
    return np.bincount(cell, minlength=BINS**3 + 1).tolist()


_RAMP = bytes(v for i in range(256) for v in (i, i, i))
_FALLING = bytes(255 - v for v in _RAMP)
_INVERTED = bytes(range(255, -1, -1))


def _laced(part: bytes, row: int) -> bytes:
    """Rows in the order in which an interlaced frame stores them."""
    rows = np.frombuffer(part, np.uint8).reshape(-1, row)
    return np.concatenate([rows[first::step] for first, step in _stream_rows(len(rows), True)]).tobytes()


def encode_samples(data: bytes, row: int = ROW, rows: int = FRAME_ROWS, delay_cs: int = 10) -> bytes:
    """8-bit samples as an animation of grey frames, ``row`` wide and at most ``rows`` high; lossless.

    The length must be a positive multiple of ``row``. Frames take turns in what
    the format offers: every second one is interlaced, every fourth has a palette
    of its own with falling greys, disposal is keep, clear and put back in turn,
    and a sample value that a frame does not use is its transparent one. Each
    frame draws all of its rows, so none of this loses a sample. The last frame
    may be lower than the canvas.
    """
    height = len(data) // row
    if not data or len(data) % row:
        raise ValueError("samples must fill whole rows")
    out = [b"GIF89a", struct.pack("<HHBBB", row, min(height, rows), 0xF7, 0, 0), _RAMP]
    for n, top in enumerate(range(0, height, rows)):
        part = data[top * row : (top + rows) * row]
        laced, own = n % 2 == 1, n % 4 == 2
        if own:
            part = part.translate(_INVERTED)
        if laced:
            part = _laced(part, row)
        unused = bytes(set(range(256)).difference(part))
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", (1 + n % 3) << 2 | bool(unused), delay_cs, unused[-1] if unused else 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, row, len(part) // row, (0x40 if laced else 0) | (0x87 if own else 0)))
        out.append((_FALLING if own else b"") + b"\x08")
        stream = lzw_encode(part)
        out.extend(bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255))
        out.append(b"\0")
    out.append(b"\x3b")
    return b"".join(out)


def samples_of(frame: Frame) -> bytes:
    """The samples that :func:`encode_samples` stored in a frame, from its drawn part."""
    x, y, w, h = frame.box
    return frame.pixels[y : y + h, x : x + w, 0].tobytes()


# ---------------------------------------------------------------- DataFrame operators


def text_to_gif(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, gif) per row: the text's UTF-8, padded with 0 to rows of 64, as a lossless GIF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                raw = batch.column(1).slice(i, 64).cast(pa.binary()).to_pylist()
                gifs = [encode_samples(t + bytes(-len(t) % ROW or (ROW if not t else 0))) for t in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 64), pa.array([len(t) for t in raw], pa.int64()), pa.array(gifs, pa.binary())], ["doc_id", "n_bytes", "gif"])

    return texts(docs).mapInArrow(run, "doc_id long, n_bytes long, gif binary")


FRAME_SCHEMA = "id long, frame int, top int, start_ms long, delay_ms int, width int, height int, disposal int, pixels binary, histogram array<int>, error string"


def gif_frames(images: DataFrame, id_col: str = "id", data_col: str = "gif", max_pixels: int = MAX_PIXELS) -> DataFrame:
    """A table of timed frames: one row per composited frame, RGBA pixels and colour histogram.

    A canvas of over ``max_pixels`` comes in stripes of rows, ``top`` the first
    row of each; a stripe without a drawn pixel has null pixels, so a forged
    size costs nothing. ``error`` is what was found wrong up to this frame. An
    image without frames (null, empty or foreign bytes) gives one row with null
    frame columns and its error, so no image is lost. A null id keeps its rows,
    repeated rows are answered each, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                im = Reader(raw.as_py())
                some = False
                for low, high in im.stripes(max_pixels):
                    seen = False
                    for i, f in enumerate(im.frames(low, high)):
                        some, seen = True, seen or f.any_drawn
                        row = (key, i, low, f.start_ms, f.delay_ms, im.width, im.height, f.disposal, f.pixels.tobytes() if seen else None, histogram(f.pixels), im.error)
                        yield pa.RecordBatch.from_pylist([dict(zip(_FRAME.names, row, strict=True))], schema=_FRAME)
                if not some:
                    row = (key, None, None, None, None, im.width, im.height, None, None, None, im.error)
                    yield pa.RecordBatch.from_pylist([dict(zip(_FRAME.names, row, strict=True))], schema=_FRAME)

    return images.select(F.col(id_col).alias("id"), F.col(data_col).alias("gif")).mapInArrow(run, FRAME_SCHEMA)


_FRAME = pa.schema([("id", pa.int64()), ("frame", pa.int32()), ("top", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("disposal", pa.int32()), ("pixels", pa.binary()), ("histogram", pa.list_(pa.int32())), ("error", pa.string())])

_TIMED = "array<struct<start_ms:long,delay_ms:int,disposal:int,histogram:array<int>>>"


def gif_digest(images: DataFrame) -> DataFrame:
    """Columns read back from stored GIFs (doc_id, n_bytes, gif): payload and media digests, timed frames.

    Frames are composited one at a time, so a long animation needs no more memory
    than a short one. ``frames`` has the time, disposal and colour histogram of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = []
                for doc, n, raw in zip(*(batch.column(i).slice(lo, 256).to_pylist() for i in (0, 1)), batch.column(2).slice(lo, 256), strict=True):
                    rows.append(_digest(doc, n, raw.as_py() or b""))
                yield pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, r, strict=True)) for r in rows], schema=_DIGEST)

    return images.select("doc_id", "n_bytes", "gif").mapInArrow(run, f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames int, duration_ms long, frames {_TIMED}, error string")


def _digest(doc: int | None, n: int, gif: bytes) -> tuple:
    im = Reader(gif)
    whole, tail, size = hashlib.sha256(), b"", 0
    total = np.zeros(BINS**3 + 1, np.int64)
    timed = []
    for low, high in im.stripes():
        for f in im.frames(low, high):
            payload = samples_of(f)
            whole.update(payload)
            tail, size = (tail + payload)[-ROW:], size + len(payload)
            cells = histogram(f.pixels)
            total += cells
            timed.append({"start_ms": f.start_ms, "delay_ms": f.delay_ms, "disposal": f.disposal, "histogram": cells})
    greys = total[:-1].reshape(BINS, BINS, BINS)[range(BINS), range(BINS), range(BINS)]
    feature = f"{im.width}x{im.height}:" + ",".join(map(str, greys.tolist()))
    return doc, n, size, whole.hexdigest(), zlib.crc32(tail), len(gif), hashlib.sha256(gif).hexdigest(), feature, len(timed), sum(t["delay_ms"] for t in timed), timed, im.error


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_frames", pa.int32()), ("duration_ms", pa.int64()), ("frames", pa.list_(pa.struct([("start_ms", pa.int64()), ("delay_ms", pa.int32()), ("disposal", pa.int32()), ("histogram", pa.list_(pa.int32()))]))), ("error", pa.string())])


def op1_gif_media(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return gif_digest(text_to_gif(table(spark, sf_dir, "documents"))).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "duration_ms", "frames")
