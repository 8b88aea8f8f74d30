"""Vectorised views of whole texts: words, lines and 64-bit fingerprints over Arrow string buffers.

An Arrow string column is one byte buffer and row offsets. The helpers here find words of every
row of a batch at once with numpy. Texts are never cut: a batch is dealt out in chunks of whole
rows, and one very long row is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Text of one chunk: each byte takes some tens of bytes in numpy while its chunk is worked on.
CHUNK_BYTES = 400_000
#: Rows and bytes of one Arrow batch at most (one row may be longer): a batch's texts lie in the memory of the JVM and of the Python worker at once.
BATCH_ROWS = 1000
BATCH_BYTES = 4_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of words that end at white space.
NOT_SPACE = ~SPACE
#: Bytes of words of letters and digits; every byte of a non-ASCII character counts.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_U = np.uint64
#: Bytes of one piece of a long range: pieces are hashed side by side, and then their hashes as a range of their own.
_PIECE = 256
#: Masks that keep the first k of eight bytes.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each short byte range: its eight-byte words go through mix() one after another."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    size = ends - starts
    out = size.astype(_U) * _U(0xD6E8FEB86659FD93) + _U(0x2545F4914F6CDD1D)
    live = np.arange(len(starts))
    for at in range(0, int(size.max(initial=0)), 8):
        live = live[size[live] > at]
        word = words[starts[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        out[live] = mix(out[live] * _U(0x9FB21C651E98DF25) ^ word)
    return out


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range of ``data``; equal ranges get equal hashes anywhere.

    Every byte goes through a mixing step together with all before it, so that no regular pattern of bytes cancels out.
    """
    size = ends - starts
    if not (size > _PIECE).any():
        return _piece_hashes(data, starts, ends)
    out = np.empty(len(starts), _U)
    short = size <= _PIECE
    out[short] = _piece_hashes(data, starts[short], ends[short])
    a, b = starts[~short], ends[~short]
    count = -(-(b - a) // _PIECE)
    edges = np.concatenate(([0], np.cumsum(count)))
    low = np.repeat(a, count) + (np.arange(edges[-1]) - np.repeat(edges[:-1], count)) * _PIECE
    own = _piece_hashes(data, low, np.minimum(low + _PIECE, np.repeat(b, count)))
    out[~short] = mix(fingerprints(own.view(np.uint8), edges[:-1] * 8, edges[1:] * 8) ^ mix((b - a).astype(_U)))
    return out


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns (doc_id and text) of ``docs``, to be read by Python in batches of bounded rows and bytes.

    Spark reads these two bounds from the session when a job starts, so they stay lowered in the session after this call.
    """
    conf = docs.sparkSession.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        had = conf.get(name, None)
        if had is None or not had.isdigit() or not 0 < int(had) <= most:
            conf.set(name, str(most))
    return docs.select(*(columns or ("doc_id", "text")))


def type_of(df: DataFrame, column: str) -> str:
    """A column's type in a schema string."""
    return df.schema[column].dataType.simpleString()


@dataclass
class Rows:
    """Some whole rows of a text column: UTF-8 bytes and offsets of len + 1."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a per-byte array by row."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, row) of the longest runs of flagged bytes that stay in one row."""
        n = len(self.data)
        if not n:
            none = np.empty(0, np.int64)
            return none, none, none
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1


def rows_of(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES, fold: bool = True) -> Iterator[Rows]:
    """The column in chunks of whole rows; null is the empty text. fold lower-cases A-Z."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        yield Rows(first, LOWER[part] if fold else part, offsets[first : last + 1] - offsets[first])
        first = last


def by_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums of values by row number."""
    return np.bincount(row, weights=values, minlength=rows).astype(np.int64) if len(row) else np.zeros(rows, np.int64)


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``width`` words; a row of fewer words, but not none, has one of all."""
    n = len(hashes)
    odd = [_U((0xA24BAED4963EE407 * (2 * k + 1) + 2 * k) & (2**64 - 1) | 1) for k in range(width)]
    made, at = np.empty(0, _U), np.empty(0, np.int64)
    if n >= width:
        whole = np.flatnonzero(row[: n - width + 1] == row[width - 1 :])
        made = np.zeros(n - width + 1, _U)
        for k in range(width):
            made = made + hashes[k : n - width + 1 + k] * odd[k]
        made, at = mix(made[whole]), row[whole]
    count = np.bincount(row, minlength=rows) if n else np.zeros(rows, np.int64)
    for r in np.flatnonzero((count > 0) & (count < width)):
        own = hashes[np.searchsorted(row, r) : np.searchsorted(row, r, "right")]
        total = count[r : r + 1].astype(_U)
        for k in range(len(own)):
            total = total + own[k : k + 1] * odd[k]
        made, at = np.append(made, mix(total ^ _U(0x5851F42D4C957F2D))), np.append(at, r)
    order = np.argsort(at, kind="stable")
    return made[order], at[order]
