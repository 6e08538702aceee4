"""Shared pieces: checkpoints, Arrow text buffers, word spans and vectorised hashes."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 2 << 20

#: White space that separates words: 0x20 and 0x09 to 0x0D.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ONE = np.uint64(1)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; make one of our own only where all runs in one process (tests)."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="fernlight-"))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours in the checkpoint folder's file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors where they can't already import it."""
    package = Path(__file__).resolve().parents[1]
    places = [os.path.realpath(p or ".") for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)] if os.environ.get("PYTHONPATH") else []
    context = spark.sparkContext
    if str(package.parent) in places or getattr(context, "_fernlight_shipped", False):
        return
    file = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(file))
    context._fernlight_shipped = True


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through a file in the shared checkpoint folder, which survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and len + 1 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at if len(at) else np.zeros(1, np.int64)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in raw, and the offset of each row's first word.

    offsets: of the rows in raw, from 0 to len(raw).
    """
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[raw]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    starts = np.flatnonzero(word & ~before)
    after = before
    after[-1], after[:-1] = False, word[1:]
    ends_at = offsets[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made once and grown on need."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[_ONE], np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTES, _BYTES_B, _WORDS_A, _WORDS_B = Powers(0x9E3779B97F4A7C15), Powers(0xB5026F5AA96619E9), Powers(0xC2B2AE3D27D4EB4F), Powers(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _prefix(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], dtype=np.uint64, out=total[1:])
    return total, down


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and do not overlap. second: by another base."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        j = min(j, len(starts))
        low = starts[i]
        total, down = _prefix(raw[low : ends[j - 1]].astype(np.uint64) + _ONE, _BYTES_B if second else _BYTES)
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every run of `length` words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    total, down = _prefix(words, _WORDS_A)
    n = len(words) - length + 1
    return mix64((total[length:] - total[:n]) * down[:n])


def run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of word hashes, of any lengths."""
    total, down = _prefix(mix64(words ^ np.uint64(0x3C79AC492BA7B653)), _WORDS_B)
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of `width` values, by doubling runs."""
    have, low = 1, values
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)
