"""A Bloom filter of bounded size, made by a grouped bit-or and tested over whole arrays of hashes.

What it passes by mistake costs work only where it is used: callers count or index a little more than they need, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64
#: Words of 64 bits of a filter at most, 64 MB: what comes to the driver and goes to each worker.
MOST_WORDS = 1 << 23
#: Words of a part of a filter, half a MB: rows become parts before they come to the driver.
_BLOCK = 1 << 16


class HashFilter:
    """Words of 64 bits; a hash has four bits in one of them."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def empty(cls) -> HashFilter:
        return cls(np.zeros(1, _U))

    @classmethod
    def of(cls, hashes: DataFrame) -> HashFilter:
        """The filter of ``hashes`` (h long), of 16 to 32 bits for each up to MOST_WORDS in all; with more hashes it passes more by mistake."""
        size = min(MOST_WORDS, 1 << max(4, (hashes.count() // 4).bit_length()))
        bits = "shiftleft(1L, cast(h & 63 as int)) | shiftleft(1L, cast(shiftright(h, 6) & 63 as int)) | shiftleft(1L, cast(shiftright(h, 12) & 63 as int)) | shiftleft(1L, cast(shiftright(h, 18) & 63 as int))"
        rows = hashes.select((F.shiftrightunsigned("h", 24) % size).alias("at"), F.expr(bits).alias("bits")).groupBy("at").agg(F.bit_or("bits").alias("bits"))
        per = min(size, _BLOCK)
        blocks = rows.repartition(max(1, size // (8 * per)), F.expr(f"at div {per}")).mapInArrow(lambda batches: _blocks(batches, per), "block long, words binary")
        words = np.zeros(size, _U)
        # Parts of a large filter come to the driver one after another.
        for r in blocks.toLocalIterator() if size > 16 * per else blocks.collect():
            words[r["block"] * per : (r["block"] + 1) * per] = np.frombuffer(r["words"], _U)
        return cls(words)

    def has(self, h: np.ndarray) -> np.ndarray:
        bits = np.zeros(len(h), _U)
        for k in (0, 6, 12, 18):
            bits |= _U(1) << ((h >> _U(k)) & _U(63))
        return self.words[((h >> _U(24)) % _U(len(self.words))).astype(np.int64)] & bits == bits


def _blocks(batches: Iterator[pa.RecordBatch], per: int) -> Iterator[pa.RecordBatch]:
    """(block, words) of rows (at, bits): the blocks of ``per`` words that have any."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        at, bits = batch.column("at").to_numpy(), batch.column("bits").to_numpy().view(_U)
        block = at // per
        for b in np.unique(block):
            own = block == b
            held.setdefault(int(b), np.zeros(per, _U))[at[own] - b * per] = bits[own]
    for b, words in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([words.tobytes()], pa.binary())], names=["block", "words"])


def any_has(filters: list[HashFilter | Broadcast], h: np.ndarray) -> np.ndarray:
    """Whether any of ``filters``, some of which may be broadcast, has each hash."""
    found = np.zeros(len(h), bool)
    for f in filters:
        found |= (f.value if isinstance(f, Broadcast) else f).has(h)
    return found
