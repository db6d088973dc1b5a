"""Vectorised work on Arrow batches of text: words, shingles and hashes without a loop over rows.

Every function takes the UTF-8 bytes of several documents as one buffer with offsets. Null texts
count as empty. A batch is cut into slices of half a megabyte, so the memory of a task does not
depend on how many rows Spark puts into an Arrow batch; one document is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 19
BATCH_ROWS = 1000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch than Spark's 10 000: documents are long, and each running task holds
    some batches in the JVM and in Python. Holds for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def byte_table(seed: int, fold: bool = False) -> np.ndarray:
    """A random 64-bit word for each byte; fold gives ASCII capitals the word of the small letter."""
    table = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
    if fold:
        table[65:91] = table[97:123]
    return table


PLAIN, SECOND, FOLDED = byte_table(11), byte_table(12), byte_table(13, fold=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _power(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def prefix_of(codes: np.ndarray) -> np.ndarray:
    """Sums of hashed prefixes of 64-bit codes, for span_hash; one longer than codes."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _power(_BASE, len(codes)), dtype=np.uint64, out=out[1:])
    return out


def prefix_hash(data: np.ndarray, table: np.ndarray = PLAIN) -> np.ndarray:
    return prefix_of(table[data])


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes have equal hashes wherever they stand."""
    value = (prefix[end] - prefix[start]) * _power(_BASE_INVERSE, len(prefix))[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Moduli and bases of prime_hash. Sums modulo 2^64 can agree for crafted long strings; these do not.
PRIMES = ((2147483647, 1103515245), (2147483629, 1812433253))


def _prime_power(prime: int, base: int, n: int) -> np.ndarray:
    known = _powers.get(prime * base)
    if known is None or len(known) < n:
        known, size = np.ones(1, np.uint64), 1
        while size < max(n, 1 << 16):
            known = np.concatenate([known, known * np.uint64(pow(base, size, prime)) % np.uint64(prime)])
            size *= 2
        _powers[prime * base] = known
    return known[:n]


def prime_prefix(codes: np.ndarray) -> list[np.ndarray]:
    """Like prefix_of, modulo each of PRIMES: of the codes' upper 31 bits and of their lower 31 bits, so
    that products stay below 2^62 (and sums of less than 2^32 residues exact)."""
    out = []
    for (prime, base), half in zip(PRIMES, (codes >> np.uint64(33), codes & np.uint64((1 << 31) - 1)), strict=True):
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(half * _prime_power(prime, base, len(codes)) % np.uint64(prime), dtype=np.uint64, out=sums[1:])
        out.append(sums)
    return out


def prime_hash(prefixes: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span, 31 bits from each of two prime fields."""
    parts = [(sums[end] - sums[start]) % np.uint64(prime) * _prime_power(prime, pow(base, -1, prime), len(sums))[start] % np.uint64(prime) for (prime, base), sums in zip(PRIMES, prefixes, strict=True)]
    return mix((parts[0] << np.uint64(32) | parts[1]) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about limit bytes."""
    data, at = buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = int(max(i + 1, min(n, np.searchsorted(at, at[i] + limit, "right") - 1)))
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes above 32 (words are separated by ASCII blanks)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = data > 32
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = at[(at > 0) & (at < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of n rows in a sorted list of row numbers."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of `size` words; a row with fewer words gives one run of them all."""
    at = per_row(rows, n)
    count = np.diff(at)
    out = np.zeros(len(hashes), dtype=np.uint64)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for k in range(min(size, len(hashes))):
        out[: len(hashes) - k] += hashes[k:] * weights[k]
    left = at[1:][rows] - np.arange(len(rows))  # words from here to the row's end
    keep = left >= size
    for r in np.flatnonzero((count > 0) & (count < size)):
        first, m = at[r], count[r]
        out[first] = (hashes[first : first + m] * weights[:m]).sum(dtype=np.uint64) + np.uint64(m)
        keep[first] = True
    return mix(out[keep]), rows[keep]


def map_texts(df: DataFrame, keep: list[str], text: str, fn: Callable, schema: str) -> DataFrame:
    """mapInArrow with fn(columns kept, bytes, offsets) -> list of columns, slice by slice."""
    names = [*keep, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in slices(batch.column(len(keep))):
                kept = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in fn(kept, data, at)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    chosen = df.select(*[df[c] for c in names])
    named = schema
    out = chosen.mapInArrow(run, _positional(named))
    return out.toDF(*[f.split()[0] for f in named.split(",")])


def _positional(schema: str) -> str:
    return ", ".join(f"c{k} {f.split(None, 1)[1]}" for k, f in enumerate(f.strip() for f in schema.split(",")))


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of each row: the bytes that don't continue a character."""
    ahead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=ahead[1:])
    return ahead[at[1:]] - ahead[at[:-1]]
