"""Media columns: baseline JPEG read by numpy, down to thumbnails of block means and their hashes.

`read_jpegs` parses the markers of baseline files (SOF0: 8 bits, one to four components, any
sampling; DQT, DHT, DRI, restarts; scans that hold all components, or one) and decodes
scans to the DC coefficient of each luminance block, whose dequantised value over 8, plus 128, is the
block's mean: one thumbnail pixel for each 8 x 8 block. Files that use the same tables are decoded
together: each restart interval is a lane, and all lanes take their next symbol at once from tables
indexed by the next 16 bits. AC coefficients are walked over, not reconstructed.

`write_jpegs` stores bytes without loss in the same form: one byte is one 8 x 8 block of even grey, so
the file's thumbnail is the payload. Rows are 64 blocks wide, one restart interval each; a payload
over 8,191 rows becomes several files, one after the other.

Cases: null text counts as empty. A payload is the text's UTF-8, with bytes 0 up to a positive
multiple of 64. A file that breaks the format raises ValueError with the reason. Memory follows
one chunk of about 1 MB and, for a longer text, one file of half a megabyte at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlight.llm.common import chunks, column_bytes, ragged

WIDTH = 64
MOST_ROWS = 65535 // 8

#: Bits of the code of each DC size 0 to 8; longer for rarer ones, and with room for the code of ones.
_DC_BITS = (5, 5, 4, 3, 3, 3, 2, 3, 5)


def _codes(counts: list[int], symbols: bytes) -> list[tuple[int, int, int]]:
    """(code, bits, symbol) of a DHT's counts of codes of 1 to 16 bits."""
    out, code, k = [], 0, 0
    for bits, n in enumerate(counts, start=1):
        for _ in range(n):
            out.append((code, bits, symbols[k]))
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _dc_table() -> tuple[list[int], bytes]:
    order = sorted(range(9), key=lambda s: (_DC_BITS[s], s))
    return [sum(b == n for b in _DC_BITS) for n in range(1, 17)], bytes(order)


# --- writing

_DC_COUNTS, _DC_SYMBOLS = _dc_table()


def _writer_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bits of each difference -255 to 255 (at + 255), with the end of block behind it, and how many."""
    code = {s: (c, b) for c, b, s in _codes(_DC_COUNTS, _DC_SYMBOLS)}
    bits, sizes = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        c, b = code[s]
        extra = d if d >= 0 else d + (1 << s) - 1
        bits[d + 255], sizes[d + 255] = ((c << s) | extra) << 1, b + s + 1
    return bits, sizes


_BITS, _SIZES = _writer_tables()


def _header(rows: int) -> bytes:
    part = lambda mark, body: struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body
    return b"".join([
        b"\xff\xd8", part(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"), part(0xDB, b"\0" + bytes([8] * 64)),
        part(0xC0, struct.pack(">BHHB3B", 8, rows * 8, WIDTH * 8, 1, 1, 0x11, 0)),
        part(0xC4, b"\x00" + bytes(_DC_COUNTS) + _DC_SYMBOLS), part(0xC4, b"\x10" + bytes([1] + [0] * 15) + b"\0"),
        part(0xDD, struct.pack(">H", WIDTH)), part(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
    ])


def write_jpegs(payload: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """Files of `rows` rows of 64 bytes each, from the bytes of all of them."""
    total = int(rows.sum())
    grid = payload.reshape(total, WIDTH).astype(np.int64)
    diff = np.diff(grid, axis=1, prepend=128) + 255
    sizes = _SIZES[diff]
    ends = np.cumsum(sizes, axis=1)
    length = (ends[:, -1] + 7) >> 3
    start = np.concatenate([[0], np.cumsum(length)])
    at = ((ends - sizes) + (start[:-1, None] << 3)).ravel()
    sizes = sizes.ravel()
    word = _BITS[diff].ravel() << (24 - sizes - (at & 7))
    byte, n = at >> 3, int(start[-1])
    coded = np.zeros(n + 2)
    for k in range(3):
        coded[k : n + 2] += np.bincount(byte, weights=((word >> (16 - 8 * k)) & 255).astype(np.float64), minlength=n + 2)[: n + 2 - k]
    coded = coded[:n].astype(np.uint8)
    spare = (length << 3) - ends[:, -1]
    coded[start[1:] - 1] |= ((1 << spare) - 1).astype(np.uint8)
    # a zero behind each byte 0xFF, and a restart mark behind each row but a file's last
    row = np.repeat(np.arange(total), length)
    full = coded == 255
    first = np.concatenate([[0], np.cumsum(rows)])
    last = np.zeros(total, bool)
    last[first[1:] - 1] = True
    number = np.arange(total) - np.repeat(first[:-1], rows)
    shift = np.concatenate([[0], np.cumsum(full)[:-1]]) + 2 * row if n else np.zeros(0, np.int64)
    out = np.zeros(n + int(full.sum()) + 2 * total, np.uint8)
    out[np.arange(n) + shift] = coded
    stuffed = np.concatenate([[0], np.cumsum(full)])
    marks = start[1:] + stuffed[start[1:]] + 2 * np.arange(total)
    out[marks] = 0xFF
    out[marks + 1] = np.where(last, 0xD9, 0xD0 + number % 8)
    cut = np.concatenate([[0], marks[last] + 2])
    return [_header(int(r)) + out[a:b].tobytes() for r, a, b in zip(rows, cut[:-1], cut[1:], strict=True)]


# --- reading


@dataclass
class Frame:
    width: int = 0
    height: int = 0
    restart: int = 0
    parts: list = field(default_factory=list)  # (id, h, v, quantiser)
    quant: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)
    scan: list = field(default_factory=list)  # (id, DC table, AC table)
    data: int = 0


def _tables(body: bytes, out: Frame) -> None:
    """Huffman tables of a DHT."""
    while body:
        n = sum(body[1:17])
        if len(body) < 17 + n or n > 256 or body[0] & 0xEF > 3:
            raise ValueError("a Huffman table that does not end")
        if sum(c << (15 - k) for k, c in enumerate(body[1:17])) > 1 << 16:
            raise ValueError("more codes than there are")
        if body[0] < 16 and any(size > 11 for size in body[17 : 17 + n]):
            raise ValueError("a difference of more than 11 bits")
        out.tables[body[0]] = bytes(body[1 : 17 + n])
        body = body[17 + n :]


def parse(file: bytes) -> Frame:
    """Reads the markers up to the data of the scan with the luminance; only that scan's components stay in parts. ValueError with the reason if the file breaks the format."""
    if file[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    out, at = Frame(), 2
    while True:
        while at < len(file) and file[at] == 0xFF and file[at + 1 : at + 2] == b"\xff":
            at += 1
        if at + 4 > len(file) or file[at] != 0xFF:
            raise ValueError("a marker was to come")
        mark, size = file[at + 1], struct.unpack_from(">H", file, at + 2)[0]
        if mark in (0xD8, 0xD9):
            raise ValueError("no scan")
        if mark in (0x00, 0x01) or 0xD0 <= mark <= 0xD7 or size < 2 or at + 2 + size > len(file):
            raise ValueError("a segment that does not end")
        body = file[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                if wide > 1 or len(body) < 1 + 64 * (1 + wide):
                    raise ValueError("a quantiser table that does not end")
                first = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                out.quant[body[0] & 15] = first
                body = body[1 + 64 * (1 + wide) :]
        elif mark == 0xC0:
            if len(body) < 6 or len(body) < 6 + 3 * body[5] or not 1 <= body[5] <= 4 or out.parts:
                raise ValueError("a frame that does not end")
            depth, out.height, out.width, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or not out.height or not out.width:
                raise ValueError("not a baseline frame")
            out.parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
            if len({p[0] for p in out.parts}) < n or any(not 1 <= x <= 4 for p in out.parts for x in p[1:3]):
                raise ValueError("components that are none")
        elif 0xC1 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline frame")
        elif mark == 0xC4:
            _tables(body, out)
        elif mark == 0xDD:
            if len(body) != 2:
                raise ValueError("a restart interval that does not end")
            out.restart = struct.unpack(">H", body)[0]
        elif mark == 0xDA:
            if not body or not 1 <= body[0] <= 4 or len(body) < 4 + 2 * body[0]:
                raise ValueError("a scan that does not end")
            out.scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            if not out.parts:
                raise ValueError("no frame before the scan")
            named = [c for c, _, _ in out.scan]
            if named != [p[0] for p in out.parts if p[0] in named] or bytes(body[1 + 2 * body[0] : 4 + 2 * body[0]]) != b"\0\x3f\0":
                raise ValueError("not a baseline scan")
            if out.parts[0][0] not in named:  # luminance is in a later scan
                while at + 1 < len(file) and (file[at] != 0xFF or file[at + 1] in (0x00, 0xFF) or 0xD0 <= file[at + 1] <= 0xD7):
                    at += 1
                continue
            if len(out.scan) != len(out.parts):
                if out.parts[0][1:3] != (max(p[1] for p in out.parts), max(p[2] for p in out.parts)):
                    raise ValueError("luminance of less than full size in a scan of its own")
                out.parts = [p for p in out.parts if p[0] in named]
            if out.parts[0][3] not in out.quant or any(d not in out.tables or 16 + a not in out.tables for _, d, a in out.scan):
                raise ValueError("a scan names what the file lacks")
            if len(out.parts) > 1 and sum(p[1] * p[2] for p in out.parts) > 10:
                raise ValueError("more blocks than a unit holds")
            out.data = at
            return out


_SPREAD: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def _spread(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and bits by the next 16 bits; 0 bits where no code begins so."""
    if table not in _SPREAD:
        symbol, bits = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        for c, b, s in _codes(list(table[:16]), table[16:]):
            symbol[c << (16 - b) : (c + 1) << (16 - b)], bits[c << (16 - b) : (c + 1) << (16 - b)] = s, b
        if len(_SPREAD) > 64:
            _SPREAD.clear()
        _SPREAD[table] = symbol, bits
    return _SPREAD[table]


_WHOLE: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}


def _whole(dc: bytes, ac: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Difference and bits of a block that is a DC code and an end of block, where both fit in 16 bits; else 0 bits."""
    if (dc, ac) not in _WHOLE:
        peek = np.arange(1 << 16)
        (size, bits), (symbol, more) = _spread(dc), _spread(ac)
        value = (peek >> np.maximum(16 - bits - size, 0)) & ((1 << size) - 1)
        diff = np.where((size > 0) & (value < (1 << np.maximum(size - 1, 0))), value - (1 << size) + 1, value)
        used = bits + size
        rest = (peek << np.minimum(used, 16)) & 0xFFFF
        whole = (bits > 0) & (used < 16) & (more[rest] > 0) & (symbol[rest] == 0) & (used + more[rest] <= 16)
        if len(_WHOLE) > 32:
            _WHOLE.clear()
        _WHOLE[dc, ac] = diff.astype(np.int32), np.where(whole, used + more[rest], 0)
    return _WHOLE[dc, ac]


def _unstuff(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A scan's bytes without stuffed zeros and marks, and the starts and the end of its restart intervals among them."""
    nxt = np.concatenate([data[1:], [0]]).astype(np.uint8)
    ff = data == 255
    mark = ff & (nxt != 0) & (nxt != 255)
    ends = np.flatnonzero(mark & ((nxt < 0xD0) | (nxt > 0xD7)))
    if not len(ends):
        raise ValueError("a scan without an end")
    data, nxt, ff, mark = data[: ends[0]], nxt[: ends[0]], ff[: ends[0]], mark[: ends[0]]
    if (nxt[mark] != 0xD0 + np.arange(mark.sum()) % 8).any():
        raise ValueError("restart marks out of order")
    drop = mark | ff & (nxt == 255)
    drop[1:] |= ((ff & (nxt == 0)) | mark)[:-1]
    kept = np.cumsum(~drop)
    return data[~drop], np.concatenate([[0], kept[mark], kept[-1:]])


def _decode(words: np.ndarray, at: np.ndarray, blocks: np.ndarray, pattern: list[tuple[bytes, bytes, int]], lumas: int) -> np.ndarray:
    """DC differences (block, lane) of the lanes that begin at bit `at` and have `blocks` blocks, most first; `at` is moved to the lanes' ends."""
    n = int(blocks.max())
    out = np.zeros((n, len(at)), np.int32)
    peek = lambda p: (words[p >> 3] >> (16 - (p & 7))) & 0xFFFF
    live = len(at)
    for t in range(n):
        while blocks[live - 1] <= t:
            live -= 1
        dc, ac, _ = pattern[t % len(pattern)]
        diffs, used = _whole(dc, ac)
        p = at[:live]
        head = peek(p)
        step, out[t, :live] = used[head], diffs[head]
        slow = np.flatnonzero(step == 0)
        p += step
        if len(slow):
            (size, bits), (symbol, more) = _spread(dc), _spread(ac)
            q, h = p[slow], head[slow]
            if not bits[h].all():
                raise ValueError("a code that the tables lack")
            s = size[h]
            q = q + bits[h]
            value = peek(q) >> (16 - s)
            out[t, slow] = np.where((s > 0) & (value < (1 << np.maximum(s - 1, 0))), value - (1 << s) + 1, value)
            q = q + s
            k, todo = np.ones(len(q), np.int64), np.arange(len(q))
            while len(todo):
                h = peek(q[todo])
                if not more[h].all():
                    raise ValueError("a code that the tables lack")
                sym = symbol[h]
                q[todo] += more[h] + (sym & 15)
                k[todo] += np.where(sym == 0, 64, (sym >> 4) + 1)
                todo = todo[k[todo] < 64]
            p[slow] = q
    return out


@dataclass
class Image:
    width: int
    height: int
    thumbnail: np.ndarray


def read_each(files: list[bytes]) -> list[Image | str]:
    """Images of files, or the reason why there is none."""
    out: list = [None] * len(files)
    for k, f in enumerate(files):
        try:
            parse(f)
        except ValueError as reason:
            out[k] = str(reason)
    sound = [k for k, x in enumerate(out) if x is None]
    todo = [sound] if sound else []
    while todo:  # a batch with a bad file is halved
        part = todo.pop()
        try:
            for k, image in zip(part, read_jpegs([files[k] for k in part]), strict=True):
                out[k] = image
        except ValueError as reason:
            if len(part) == 1:
                out[part[0]] = str(reason)
            else:
                todo += [part[: len(part) // 2], part[len(part) // 2 :]]
    return out


def read_jpegs(files: list[bytes]) -> list[Image]:
    """Dimensions and luminance thumbnails of baseline files; ValueError if one of them is none."""
    frames = [parse(f) for f in files]
    groups: dict[tuple, list[int]] = defaultdict(list)
    for k, x in enumerate(frames):
        parts = {p[0]: p for p in x.parts}
        shape = tuple((x.tables[d], x.tables[16 + a], *((parts[i][1], parts[i][2]) if len(x.scan) > 1 else (1, 1))) for i, d, a in x.scan)
        groups[shape].append(k)
    out: list = [None] * len(files)
    for shape, members in groups.items():
        pattern = [(dc, ac, c) for c, (dc, ac, h, v) in enumerate(shape) for _ in range(h * v)]
        each, lumas = len(pattern), shape[0][2] * shape[0][3]
        data, starts = zip(*(_unstuff(np.frombuffer(files[k], np.uint8, offset=frames[k].data)) for k in members), strict=True)
        base = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        flat = np.concatenate([*data, np.zeros(8, np.uint8)]).astype(np.int64)
        words = flat[:-3] << 24 | flat[1:-2] << 16 | flat[2:-1] << 8 | flat[3:]
        lanes, until, mcus, sizes = [], [], [], []
        for n, k in enumerate(members):
            x = frames[k]
            wide, high = max(p[1] for p in x.parts) if each > 1 or len(shape) > 1 else 1, max(p[2] for p in x.parts) if each > 1 or len(shape) > 1 else 1
            across, down = -(-x.width // (8 * wide)), -(-x.height // (8 * high))
            total = across * down
            count = -(-total // x.restart) if x.restart else 1
            if len(starts[n]) != count + 1:
                raise ValueError("not as many restart intervals as there are to be")
            if 2 * total * each > 8 * len(data[n]):
                raise ValueError("fewer bits than blocks need")
            lanes.append(starts[n][:-1] + base[n])
            until.append(starts[n][1:] + base[n])
            each_lane = np.full(count, x.restart or total)
            each_lane[-1] = total - (count - 1) * (x.restart or total)
            mcus.append(each_lane)
            sizes.append((across, down, wide, high))
        bits, blocks = np.concatenate(lanes) << 3, np.concatenate(mcus) * each
        order = np.argsort(-blocks, kind="stable")
        diffs = np.empty((int(blocks.max()), len(bits)), np.int32)
        ends = bits[order]
        try:
            diffs[:, order] = _decode(words, ends, blocks[order], pattern, lumas)
        except IndexError:
            raise ValueError("data that end before their blocks") from None
        spare = (np.concatenate(until)[order] << 3) - ends
        if ((spare < 0) | (spare > 7)).any():
            raise ValueError("data that do not end with their blocks")
        luma = np.array([t % each < lumas for t in range(len(diffs))])
        dc = np.cumsum(diffs[luma], axis=0)
        lane = 0
        for n, k in enumerate(members):
            x, (across, down, _, _) = frames[k], sizes[n]
            h, v = shape[0][2], shape[0][3]
            values = dc[:, lane : lane + len(lanes[n])].T
            flat_dc = np.concatenate([row[: c * lumas] for row, c in zip(values, mcus[n], strict=True)]) if len(mcus[n]) > 1 and (mcus[n] != mcus[n][0]).any() else values[:, : mcus[n][0] * lumas].ravel()
            lane += len(lanes[n])
            grid = flat_dc.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            part = next(p for p in x.parts if p[0] == x.scan[0][0])
            own_w, own_h = -(-x.width * h // (8 * sizes[n][2])), -(-x.height * v // (8 * sizes[n][3]))
            pixels = np.rint(grid[:own_h, :own_w] * x.quant[part[3]] / 8.0) + 128
            out[k] = Image(x.width, x.height, np.clip(pixels, 0, 255).astype(np.uint8))
    return out


def average_hash(thumbnail: np.ndarray) -> int:
    """64 bits: which of 8 x 8 areas are lighter than their mean."""
    rows, cols = thumbnail.shape
    at = lambda n: (np.arange(8) * n) // 8
    area = np.add.reduceat(np.add.reduceat(thumbnail.astype(np.int64), at(rows), axis=0), at(cols), axis=1)
    high, wide = (np.maximum(np.diff(np.append(at(n), n)), 1) for n in (rows, cols))
    mean = area / (high[:, None] * wide[None, :])
    return int.from_bytes(np.packbits(mean > mean.mean()).tobytes(), "big")


# --- the operators

_READ = pa.schema([("i", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("thumbnail_hash", pa.string()), ("error", pa.string())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = column_bytes(batch.column(1))
        for i, j in chunks(at, 1 << 20):
            got = read_each([raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)])
            seen = [(x.width, x.height, f"{average_hash(x.thumbnail):016x}", None) if isinstance(x, Image) else (None, None, None, x) for x in got]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array([r[k] for r in seen], f.type) for k, f in enumerate(list(_READ)[1:]))], schema=_READ)


def read_media(files: DataFrame, *, media_col: str = "media", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, width, height, thumbnail_hash (16 hex digits) of a column of baseline JPEG files, and error, the reason where there is none."""
    own = files.select(F.col(id_col).cast("long").alias("i"), F.col(media_col).cast("binary").alias("m"))
    return own.mapInArrow(_read, "i long, width int, height int, thumbnail_hash string, error string").withColumnRenamed("i", id_col)


_OUT = pa.schema([("i", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.binary()), ("media", pa.binary()), ("width", pa.int32()), ("height", pa.int32()), ("feature", pa.string())])


def _rows_of(n: int) -> list[int]:
    rows = max(1, -(-n // WIDTH))
    return [min(MOST_ROWS, rows - at) for at in range(0, rows, MOST_ROWS)]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = column_bytes(batch.column(1))
        for i, j in chunks(at, 1 << 20):
            texts = np.diff(at[i : j + 1])
            shapes = [_rows_of(int(n)) for n in texts]
            padded = np.array([sum(s) * WIDTH for s in shapes])
            payload = np.zeros(int(padded.sum()), np.uint8)
            payload[ragged(np.concatenate([[0], np.cumsum(padded)[:-1]]), texts)] = raw[at[i] : at[j]]
            rows = np.array([r for s in shapes for r in s])
            edge = np.concatenate([[0], np.cumsum(rows)])
            step, files, images, k = (1 << 20) // WIDTH, [], [], 0
            while k < len(rows):  # a long text's files go one after the other
                m = max(k + 1, int(np.searchsorted(edge, edge[k] + step, side="right")) - 1)
                made = write_jpegs(payload[edge[k] * WIDTH : edge[m] * WIDTH], rows[k:m])
                files += made
                images += read_jpegs(made)
                k = m
            out, k = defaultdict(list), 0
            for s in shapes:
                own = images[k : k + len(s)]
                out["media"].append(b"".join(files[k : k + len(s)]))
                out["payload"].append(b"".join(x.thumbnail.tobytes() for x in own))
                out["width"].append(own[0].width)
                out["height"].append(sum(x.height for x in own))
                out["feature"].append(";".join(f"{x.width}x{x.height}:{average_hash(x.thumbnail):016x}" for x in own))
                k += len(s)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(texts), *(pa.array(out[f.name], f.type) for f in list(_OUT)[2:])], schema=_OUT)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _store(batches):
        payload, media = batch.column(2), batch.column(3)
        views = [memoryview(x.as_buffer()) for x in payload], [memoryview(x.as_buffer()) for x in media]
        sha = [pa.array([hashlib.sha256(x).hexdigest() for x in v], pa.string()) for v in views]
        size = [pa.array([len(x) for x in v], pa.int64()) for v in views]
        tail = pa.array([zlib.crc32(x[-64:]) for x in views[0]], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size[0], sha[0], tail, size[1], sha[1], batch.column(4), batch.column(5), batch.column(6)], names=["i", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "width", "height", "feature"])


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def store_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, payload as read back, media (the files), width, height, feature."""
    out = _own(docs, id_col, text_col).mapInArrow(_store, "i long, n_bytes long, payload binary, media binary, width int, height int, feature string")
    return out.withColumnRenamed("i", id_col)


def text_media_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As store_texts, with sizes and digests in place of the bytes, made beside them."""
    out = _own(docs, id_col, text_col).mapInArrow(_digest, "i long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width int, height int, feature string")
    return out.withColumnRenamed("i", id_col)
