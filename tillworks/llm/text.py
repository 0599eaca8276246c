"""Words and hashes of Arrow text columns, worked out over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
BATCH_ROWS = 1000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, a to z and all bytes of non-ASCII characters.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows, unless the session asks for fewer: long texts come in bounded pieces."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def is_training(doc_id) -> Column:
    """crc32 of the id as text, modulo 4, is not 2. A null id counts as training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text; NULL has one of its own."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n (or more)."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64)))) for b in (base, inverse))
        if size <= 8 * CHUNK_BYTES:
            _POWERS[int(base)] = have
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(base, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hashes(values: np.ndarray, n: int, base: np.uint64 = BASE_2) -> np.ndarray:
    """Hash of every n consecutive values, by its first."""
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(values) - n + 1, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        out = out * base + values[i:len(values) - n + 1 + i]
    return mix(out)


@dataclass
class Texts:
    """Some texts of a batch: their bytes in lower case, and where each text and each word begins and ends."""

    first: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def word_text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a text column; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, bounds


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, bounds) of pieces of about CHUNK_BYTES; a text is never cut."""
    raw, bounds = buffers(column)
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, raw[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
        i = j


def spans_of(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; a run never crosses a bound."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(flags) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate(([False], flags[:-1])) & ~edge[:-1]
    after = np.concatenate((flags[1:], [False])) & ~edge[1:]
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


def worded(column: pa.Array) -> Iterator[Texts]:
    """The lower-case words of every text."""
    for first, raw, bounds in chunks(column):
        data = LOWER[raw]
        starts, ends = spans_of(IS_WORD[data], bounds)
        yield Texts(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))


# --- a filter of fixed size -----------------------------------------------------------------------------------------

FILTER_BITS = 1 << 23


def filter_bits(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter with one probe over a long column: at most bits / 64 rows reach the driver, however many hashes there are."""
    slots = bits // 64
    position = F.col(column).bitwiseAND(F.lit(bits - 1).cast("long"))
    rows = (hashes.where(F.col(column).isNotNull())
            .groupBy(F.shiftright(position, 6).alias("_slot"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(`%s` & 63 as int))" % column)).alias("_bits")).collect())
    out = np.zeros(slots, dtype=np.uint64)
    for r in rows:
        out[r["_slot"]] = np.uint64(r["_bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def in_filter(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    position = hashes & np.uint64(len(table) * 64 - 1)
    return (table[(position >> np.uint64(6)).astype(np.int64)] >> (position & np.uint64(63))) & np.uint64(1) == 1
