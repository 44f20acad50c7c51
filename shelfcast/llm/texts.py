"""Texts of a partition as bytes and numpy arrays, handed on in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

#: Bytes of text that one slice holds, unless a single text is longer.
SLICE_BYTES = 2 << 20

#: A-Z to a-z; every other ASCII character that is no letter or digit to a blank.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces whose column ``text`` holds about ``limit`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(size, dtype=np.int64) - size) // limit
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, with memory that Arrow no longer uses given back when a partition ends: workers live on."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def plain_words(text: bytes | None) -> list[bytes]:
    """Maximal pieces without ASCII white space; none for a null."""
    return text.split() if text else []


def normal_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) pieces of ASCII letters, digits and non-ASCII characters; none for a null."""
    return text.translate(_NORMAL).split() if text else []


def word_digests(words: list[bytes]) -> np.ndarray:
    """64-bit digests of words."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def sequence_digests(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Digest of the ``n`` values from each place on; the result has ``len(words) - n + 1`` places."""
    places = len(words) - n + 1
    if places <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(places, np.uint64)
    for k, factor in enumerate(odd_numbers(n, seed)):
        total += mix(words[k : k + places] ^ factor) * factor
    return mix(total)


def with_id(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns of ``df``; others, whatever their names, cannot clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
