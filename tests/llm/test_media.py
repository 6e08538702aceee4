"""Baseline JPEG: our files, files with AC coefficients and colour, broken files."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from fernlight.llm import media


class Bits:
    def __init__(self):
        self.text = []

    def put(self, value, n):
        if n:
            self.text.append(format(value, f"0{n}b"))

    def done(self):
        s = "".join(self.text)
        s += "1" * (-len(s) % 8)
        out = bytes(int(s[k : k + 8], 2) for k in range(0, len(s), 8))
        return out.replace(b"\xff", b"\xff\x00")


def flat_table(symbols, bits):
    """A table that gives every symbol a code of `bits` bits."""
    counts = [0] * 16
    counts[bits - 1] = len(symbols)
    return counts, bytes(symbols), {s: (k, bits) for k, s in enumerate(symbols)}


def size_bits(v):
    s = abs(v).bit_length()
    return s, v if v >= 0 else v + (1 << s) - 1


def jpeg(rng, width, height, sampling, restart, quant):
    """A file of random coefficients, and the DC values of its first component."""
    dc_counts, dc_symbols, dc = flat_table(range(12), 4)
    ac_all = [0x00, 0xF0] + [(r << 4) | s for r in range(16) for s in range(1, 8)]
    ac_counts, ac_symbols, ac = flat_table(ac_all, 7)
    wide, high = max(h for h, _ in sampling), max(v for _, v in sampling)
    single = len(sampling) == 1
    if single:
        sampling, wide, high = [(1, 1)], 1, 1
    across, down = -(-width // (8 * wide)), -(-height // (8 * high))
    h0, v0 = sampling[0]
    grid = np.zeros((down * v0, across * h0), np.int64)
    data, bits, pred, n = b"", Bits(), [0] * len(sampling), 0
    for my in range(down):
        for mx in range(across):
            if restart and n and n % restart == 0:
                data += bits.done() + bytes([0xFF, 0xD0 + (n // restart - 1) % 8])
                bits, pred = Bits(), [0] * len(sampling)
            n += 1
            for c, (h, v) in enumerate(sampling):
                for y in range(v):
                    for x in range(h):
                        value = rng.randrange(-60, 60)
                        if c == 0:
                            grid[my * v + y, mx * h + x] = value
                        s, extra = size_bits(value - pred[c])
                        pred[c] = value
                        bits.put(*dc[s])
                        bits.put(extra, s)
                        k = 1
                        for _ in range(rng.randrange(4)):
                            run = rng.randrange(0, 40)
                            if k + run > 63:
                                break
                            k += run
                            while run > 15:
                                bits.put(*ac[0xF0])
                                run -= 16
                            a = rng.choice([-90, -3, -1, 1, 2, 77])
                            s, extra = size_bits(a)
                            bits.put(*ac[(run << 4) | s])
                            bits.put(extra, s)
                            k += 1
                        if k < 64:
                            bits.put(*ac[0])
    data += bits.done()
    part = lambda m, b: struct.pack(">BBH", 0xFF, m, len(b) + 2) + b
    head = b"\xff\xd8" + part(0xFE, b"a comment \xff\xda") + part(0xDB, bytes([0]) + bytes([quant] * 64))
    head += part(0xC0, struct.pack(">BHHB", 8, height, width, len(sampling)) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(sampling)))
    head += part(0xC4, b"\x00" + bytes(dc_counts) + dc_symbols + b"\x10" + bytes(ac_counts) + ac_symbols)
    if restart:
        head += part(0xDD, struct.pack(">H", restart))
    head += part(0xDA, bytes([len(sampling)]) + b"".join(bytes([k + 1, 0]) for k in range(len(sampling))) + b"\x00\x3f\x00")
    own = grid[: -(-height * v0 // (8 * high)), : -(-width * h0 // (8 * wide))]
    return head + data + b"\xff\xd9", np.clip(np.rint(own * quant / 8) + 128, 0, 255).astype(np.uint8)


@pytest.mark.parametrize("sampling", [[(1, 1)], [(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)], [(1, 2), (1, 1), (1, 1)]])
@pytest.mark.parametrize("restart", [0, 1, 3])
def test_reads_files_with_everything(sampling, restart):
    rng = random.Random(str(sampling) + str(restart))
    made = [jpeg(rng, rng.randrange(1, 90), rng.randrange(1, 70), sampling, restart, rng.choice([1, 7, 16])) for _ in range(6)]
    for image, (_, want) in zip(media.read_jpegs([f for f, _ in made]), made, strict=True):
        assert np.array_equal(image.thumbnail, want)


def test_says_what_is_wrong():
    good, _ = jpeg(random.Random(1), 20, 20, [(1, 1)], 0, 8)
    for bad in (b"", b"abc", good[:30], b"\xff\xd8\xff\xd9", good.replace(b"\xff\xc0", b"\xff\xc2")):
        with pytest.raises(ValueError):
            media.read_jpegs([bad])


SHAPES = [([(1, 1)], 0), ([(1, 1)], 2), ([(2, 1), (1, 1), (1, 1)], 3)]


@pytest.mark.parametrize(("sampling", "restart"), SHAPES)
def test_no_cut_file_has_an_image(sampling, restart):
    good, _ = jpeg(random.Random(2), 40, 24, sampling, restart, 8)
    got = media.read_each([good[:k] for k in range(len(good) - 1)])  # all but the last byte of the end mark
    assert all(isinstance(x, str) and x for x in got)
    assert isinstance(media.read_each([good])[0], media.Image)


@pytest.mark.parametrize(("sampling", "restart"), SHAPES)
def test_a_changed_byte_gives_an_image_or_a_reason(sampling, restart):
    rng = random.Random(3)
    good, want = jpeg(rng, 40, 24, sampling, restart, 8)
    files = []
    for _ in range(700):
        at = rng.randrange(len(good))
        files.append(good[:at] + bytes([rng.randrange(256)]) + good[at + 1 :])
    got = media.read_each([good, *files, good])
    assert all(np.array_equal(got[k].thumbnail, want) for k in (0, -1))
    assert all(isinstance(x, media.Image) or isinstance(x, str) for x in got) and sum(isinstance(x, str) for x in got) > 100


def test_a_small_file_of_a_large_image_takes_no_time():
    good, _ = jpeg(random.Random(2), 40, 24, [(1, 1)], 0, 8)
    at = good.index(b"\xff\xc0") + 5
    assert media.read_each([good[:at] + b"\xff\xff\xff\xff" + good[at + 4 :]]) == ["fewer bits than blocks need"]


def test_media_column(spark):
    good, want = jpeg(random.Random(4), 33, 17, [(1, 1)] * 3, 0, 8)
    rows = [(1, good), (2, None), (3, b""), (4, good[:-9]), (5, good), (None, good), (1, b"no image at all")]
    files = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, media binary, width int, error string").repartition(1)
    out = media.read_media(files).collect()
    assert sorted((str(r.doc_id), r.error is None) for r in out) == sorted((str(i), f == good) for i, f in rows)
    for r in out:
        told = (33, 17, f"{media.average_hash(want):016x}") if r.error is None else (None, None, None)
        assert (r.width, r.height, r.thumbnail_hash) == told
    assert media.read_media(files.limit(0)).count() == 0


def test_writer_is_a_stock_file_and_loses_nothing():
    rng = np.random.default_rng(3)
    rows = np.array([1, 5, 700])
    payload = rng.integers(0, 256, int(rows.sum()) * 64, dtype=np.uint8)
    files = media.write_jpegs(payload, rows)
    images = media.read_jpegs(files)
    assert b"".join(x.thumbnail.tobytes() for x in images) == payload.tobytes()
    assert [(x.width, x.height) for x in images] == [(512, 8 * r) for r in rows]
    assert files[1] == media.write_jpegs(payload[64 : 6 * 64], rows[1:2])[0]


def test_query_columns(spark):
    texts = [None, "", "a", "x" * 63, "x" * 64, "x" * 65, "é" * 200, "\x00", "long " * 150_000, "a"]
    docs = spark.createDataFrame([(k, t, "clash", b"") for k, t in enumerate(texts)], "doc_id long, text string, payload string, media binary")
    out = {r.doc_id: r for r in media.text_media_digests(docs).collect()}
    full = {r.doc_id: r for r in media.store_texts(docs).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        r = out[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert bytes(full[k].payload) == payload and hashlib.sha256(full[k].media).hexdigest() == r.media_sha256 and len(full[k].media) == r.media_bytes
    assert out[2].media_sha256 == out[9].media_sha256 and out[2].feature == out[9].feature and out[8].feature.count(";") == 1
    assert media.text_media_digests(docs.limit(0)).count() == 0


def test_average_hash_of_thin_images():
    for shape in ((1, 1), (1, 64), (3, 5), (100, 7)):
        assert 0 <= media.average_hash(np.arange(shape[0] * shape[1]).reshape(shape)) < 1 << 64


@pytest.mark.parametrize("restart", [0, 2])
def test_reads_files_of_several_scans(restart):
    file, _ = jpeg(random.Random(7), 40, 24, [(1, 1)], restart, 8)
    frame, scan = file.index(b"\xff\xc0"), file.index(b"\xff\xda\x00\x08")
    size = int.from_bytes(file[frame + 2 : frame + 4], "big")
    body = file[frame + 4 : frame + 2 + size]
    other = bytes([next(c for c in range(1, 5) if c != body[6])]) + body[7:9]
    header = b"\xff\xc0" + (size + 3).to_bytes(2, "big") + body[:5] + b"\x02" + body[6:] + other
    own = file[scan:-2]
    second = own[:5] + other[:1] + own[6:]
    for scans in (own + second, second + own):
        image = media.read_jpegs([file[:frame] + header + file[frame + 2 + size : scan] + scans + b"\xff\xd9"])[0]
        assert (image.width, image.height) == (40, 24) and (image.thumbnail == media.read_jpegs([file])[0].thumbnail).all()
