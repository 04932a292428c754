import hashlib
import random
import struct
import tracemalloc
import zlib

import numpy as np
import pytest

from boxmetrics.llm import gif

from .cases import AWKWARD, docs


def brute_lzw(stream, size):
    """Textbook decoder: one code at a time, entries as bytes."""
    bits = int.from_bytes(stream, "little")
    clear, end = 1 << size, (1 << size) + 1
    out, at, table, width, last = b"", 0, [], size + 1, None
    while True:
        code = bits >> at & (1 << width) - 1
        at += width
        if code == clear:
            table, width, last = [bytes([i]) for i in range(clear)] + [b"", b""], size + 1, None
        elif code == end:
            return out
        elif last is None:
            last = table[code]
            out += last
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            out += entry
            if len(table) < 4096:
                table.append(last + entry[:1])
                if len(table) == 1 << width and width < 12:
                    width += 1
            last = entry


@pytest.mark.parametrize("letters,size", [(2, 2), (4, 2), (3, 8), (256, 8)])
def test_lzw_round_trip(letters, size):
    rng = random.Random(letters)
    for n in (0, 1, 2, 3, 500, 40_000):
        data = bytes(rng.choices(range(letters), k=n))
        stream = gif.lzw_encode(data, size)
        assert brute_lzw(stream, size) == data
        assert gif.lzw_decode(stream, size, n) == (data, "")


def test_lzw_late_clear_code():
    """A full table may be kept in use: codes stay 12 bits wide."""
    rng = random.Random(5)
    data = bytes(rng.choices(range(256), k=9000))
    codes, table, prefix = [256], {bytes([i]): i for i in range(256)}, b""
    widths, free = [9], 258
    for c in data:
        if prefix + bytes([c]) in table:
            prefix += bytes([c])
            continue
        codes.append(table[prefix])
        widths.append(min(12, max(9, (free - 1).bit_length() if len(codes) > 2 else 9)))
        if free < 4096:
            table[prefix + bytes([c])] = free
            free += 1
        prefix = bytes([c])
    codes += [table[prefix], 257]
    k = np.arange(len(codes) - 1)
    real = np.concatenate([[9], np.minimum(12, np.frexp(257 + np.maximum(k, 1))[1])])
    stream = gif._packed(np.array(codes, np.uint32), real)
    assert brute_lzw(stream, 8) == data
    assert gif.lzw_decode(stream, 8, len(data)) == (data, "")


def image(frames, width=2, height=2, palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    """frames: (left, top, w, h, samples, disposal, hidden, delay, interlaced, local palette)."""
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0x80 | 1, 0, 0), bytes(v for c in palette for v in c)]
    for left, top, w, h, samples, disposal, hidden, delay, lace, local in frames:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", disposal << 2 | (hidden is not None), delay, hidden or 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", left, top, w, h, (0x40 if lace else 0) | (0x81 if local else 0)))
        out.append(bytes(v for c in local or () for v in c))
        s = gif.lzw_encode(bytes(samples), 2)
        out.append(b"\x02" + bytes([len(s)]) + s + b"\0")
    return b"".join(out) + b"\x3b"


def test_disposal_transparency_palettes_and_times():
    data = image(
        [
            (0, 0, 2, 2, [1, 1, 1, 1], 1, None, 5, False, None),
            (0, 0, 1, 2, [2, 0], 2, 0, 10, False, None),  # the second sample is hidden; then cleared
            (1, 1, 1, 1, [3], 3, None, 0, False, None),  # then put back
            (0, 0, 2, 1, [1, 1], 0, None, 7, False, ((9, 9, 9), (8, 8, 8), (7, 7, 7), (6, 6, 6))),
        ]
    )
    im = gif.decode(data)
    rgb = [[tuple(p) for row in f.pixels for p in row] for f in im.frames]
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    assert rgb[0] == [red] * 4
    assert rgb[1] == [green, red, red, red]
    assert rgb[2] == [none, red, none, blue]
    assert rgb[3] == [(8, 8, 8, 255), (8, 8, 8, 255), none, red]
    assert [(f.start_ms, f.delay_ms) for f in im.frames] == [(0, 50), (50, 100), (150, 0), (150, 70)]
    assert im.error == ""
    assert sum(gif.histogram(im.frames[2].pixels)) == 4 and gif.histogram(im.frames[2].pixels)[64] == 2


def test_interlace():
    rows = list(range(10))
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7, 9]
    im = gif.decode(image([(0, 0, 1, 10, [rows[i] % 4 for i in order], 0, None, 0, True, None)], 1, 10))
    got = [tuple(p[0][:3]) for p in im.frames[0].pixels]
    palette = ((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))
    assert got == [palette[r % 4] for r in rows]


def test_damaged_bytes_give_errors_not_crashes():
    good = gif.encode_samples(bytes(range(64)) * 40)
    rng = random.Random(1)
    for _ in range(300):
        bad = bytearray(good[: rng.randint(0, len(good))])
        for _ in range(rng.randint(0, 4)):
            if bad:
                bad[rng.randrange(len(bad))] = rng.randrange(256)
        gif.decode(bytes(bad), max_pixels=1 << 18)
    assert gif.decode(None).error == "empty" and gif.decode(b"PNG").error == "not a GIF"


def test_query_columns_equal_brute_force(spark):
    got = gif.gif_digest(gif.text_to_gif(docs(spark, AWKWARD))).collect()
    assert len(got) == len(AWKWARD)
    want = sorted(((i, t or "") for i, t in AWKWARD), key=str)
    for r, (i, t) in zip(sorted(got, key=lambda r: str((r.doc_id, next(t or "" for j, t in AWKWARD if j == r.doc_id)))), want, strict=True):
        raw = t.encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (i, len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.error == "" and r.media_bytes > 0 and len(r.frames) == r.n_frames == -(-len(payload) // 16384)
        for k, f in enumerate(r.frames):
            cells = [0] * 65
            for v in payload[k * 16384 : (k + 1) * 16384]:
                cells[(v >> 6) * 21] += 1
            assert (f.start_ms, f.delay_ms, f.disposal) == (100 * k, 100, 1 + k % 3)
            assert len(payload[k * 16384 :]) < 16384 and k or list(f.histogram) == cells


def test_frames_table(spark):
    images = gif.text_to_gif(docs(spark, [(1, "a" * 40_000), (2, None)]))
    rows = gif.gif_frames(images, "doc_id").orderBy("id", "frame").collect()
    assert [(r.id, r.frame, r.start_ms) for r in rows] == [(1, 0, 0), (1, 1, 100), (1, 2, 200), (2, 0, 0)]
    assert bytes(rows[0].pixels)[:4] == b"aaa\xff"
    odd = spark.createDataFrame([(1, None), (2, bytearray(b"no gif"))], "id long, gif binary")
    assert {(r.id, r.frame, r.error) for r in gif.gif_frames(odd).collect()} == {(1, None, "empty"), (2, None, "not a GIF")}


def test_empty_table(spark):
    assert gif.gif_digest(gif.text_to_gif(docs(spark, []))).count() == 0


def test_stripes_equal_the_whole_canvas(spark):
    frames = [(0, 0, 5, 40, [i % 4 for i in range(200)], 1, 2, 5, True, None), (1, 7, 3, 30, [i % 3 for i in range(90)], 3, None, 5, False, None), (2, 20, 3, 15, [1] * 45, 2, None, 0, True, None), (0, 3, 5, 9, [2] * 45, 1, 1, 0, False, None)]
    data = image(frames, 5, 40)
    whole = gif.decode(data)
    for pixels in (5, 35, 64):
        cut = gif.decode(data, max_pixels=pixels)
        assert all((a.pixels == b.pixels).all() and a.box == b.box for a, b in zip(whole.frames, cut.frames, strict=True)) and not cut.error
    table = spark.createDataFrame([(1, bytearray(data))], "id long, gif binary")
    rows = gif.gif_frames(table, max_pixels=35).orderBy("frame", "top").collect()
    assert [b"".join(bytes(r.pixels) for r in rows if r.frame == i) for i in range(4)] == [f.pixels.tobytes() for f in whole.frames]


def _forged(width, height, codes, canvas=None):
    """A full table, then codes of its longest entries: each stands for thousands of samples."""
    run = [256, 0, *range(258, 4096), *[4095] * codes]
    widths = np.concatenate([[9], np.minimum(12, np.frexp(257 + np.maximum(np.arange(len(run) - 1), 1))[1])])
    stream = gif._packed(np.array(run, np.uint32), widths)
    blocks = b"".join(bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255))
    return b"GIF89a" + struct.pack("<HHBBB", *(canvas or (width, height)), 0, 0, 0) + b"\x2c" + struct.pack("<HHHHB", 0, 0, width, height, 0) + b"\x08" + blocks + b"\0\x3b"


def test_forged_streams_and_canvases_need_little_memory():
    small, large = _forged(64, 64, 700_000), _forged(65535, 65535, 10)
    tracemalloc.start()
    try:
        assert gif.decode(small).error == "wrong number of samples"
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
        im = gif.Reader(large)
        low, high = im.stripes(1 << 18)[-1]
        assert [f.any_drawn for f in im.frames(low, high)] == [False]
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
    assert gif.lzw_decode(b"", 9, 4) == (b"", "bad code size") and gif.lzw_decode(b"", 0, 4) == (b"", "bad code size")


def test_frames_larger_than_the_canvas_are_cropped_before_they_are_held():
    for canvas in ((1, 65535), (65535, 1), (3, 3), (1, 1)):
        tracemalloc.start()
        try:
            im = gif.Reader(_forged(65535, 65535, 10, canvas))
            for low, high in im.stripes(1 << 18):
                assert len(list(im.frames(low, high))) == 1
            assert tracemalloc.get_traced_memory()[1] < 60 << 20
        finally:
            tracemalloc.stop()


@pytest.mark.parametrize("laced", [False, True])
def test_cropped_frames_equal_plain_ones(laced):
    wide = [(i * 7) % 4 for i in range(12 * 20)]
    for x, y in ((0, 0), (2, 3), (4, 0), (5, 9), (60, 60)):
        data = image([(x, y, 12, 20, wide, 1, None, 0, laced, None)], 5, 9)
        im = gif.decode(data)
        plain = image([(0, 0, 12, 20, wide, 1, None, 0, laced, None)], 12, 20)
        whole = gif.decode(plain).frames[0].pixels
        part = whole[: max(0, 9 - y), : max(0, 5 - x)]
        assert (im.frames[0].pixels[y : y + part.shape[0], x : x + part.shape[1]] == part).all() and not im.error
