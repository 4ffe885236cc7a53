"""Words, windows and hashes of whole texts, many texts at a time.

A word is a longest run of bytes other than ``[\\x20\\x09-\\x0D]``. Functions
here take the texts of an Arrow column as one buffer, so their cost is a few
array passes and no loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_LETTER_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Odd multipliers of the two independent halves of a window's hash.
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_CHUNK_BYTES = 4 << 20
#: Text behind one hash bucket at most, on average; a task holds several times as much for its bucket.
BUCKET_BYTES = 64 << 20


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Record batches cut between rows so that each holds about ``limit`` bytes of text.

    A single longer text is a piece of its own and stays whole.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        marks = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def hash_buckets(docs: DataFrame, text: str = "text") -> int:
    """As many buckets as shuffles have partitions, or more where the texts need them."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, -(-total // BUCKET_BYTES))


def boxed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, text): all other columns in one, so that their names clash with nothing."""
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    return docs.select(F.struct(*rest).alias("row"), F.col(text))


def unboxed(rows: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns in the order given, those but ``text`` from ``row``."""
    return rows.select(*[
        F.col(text) if name == text else F.col("row").getField(name).alias(name) for name in columns
    ])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; null reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_bytes(column: pa.Array) -> list[bytes]:
    """Each text as bytes; null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of each text's first word.

    The third array has one entry more than there are texts.
    """
    inside = ~_SPACE[data]
    firsts, lasts = inside.copy(), inside.copy()
    firsts[1:] &= ~inside[:-1]
    lasts[:-1] &= ~inside[1:]
    filled = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
    firsts[heads] = inside[heads]
    lasts[tails] = inside[tails]
    starts, ends = np.flatnonzero(firsts), np.flatnonzero(lasts) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False
) -> np.ndarray:
    """A 64-bit hash of each word's bytes, or a second one independent of it."""
    lengths = ends - starts
    hashes = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return hashes
    powers = np.full(int(lengths.max()), _LETTER_BASES[other], dtype=np.uint64)
    powers = np.cumprod(powers, dtype=np.uint64)
    groups = np.cumsum(lengths) // _CHUNK_BYTES
    edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(starts)]
    for low, high in zip(edges, edges[1:]):
        sizes = lengths[low:high]
        first = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        letters = data[within + np.repeat(starts[low:high], sizes)].astype(np.uint64)
        letters += np.uint64(1)
        letters *= powers[within]
        hashes[low:high] = np.add.reduceat(letters, first)
    return mixed(hashes ^ (lengths.astype(np.uint64) << np.uint64(48)))


def joined_hashes(left: np.ndarray, right_words: int, right: np.ndarray, base: int) -> np.ndarray:
    """Hash of a window from the hashes of its two parts, the second of ``right_words`` words."""
    return left * np.uint64(pow(base, right_words, 1 << 64)) + right


def window_hashes(words: np.ndarray, size: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """Hash of the ``size`` words from each word on, ignoring where texts end.

    Built by doubling; entries within ``size - 1`` of the end are left out.
    """
    if len(words) < size:
        return np.empty(0, dtype=np.uint64)
    if size == 1:
        return words
    half = window_hashes(words, size // 2, base)
    count = len(words) - size + 1
    whole = joined_hashes(half[:count], size // 2, half[size // 2 : size // 2 + count], base)
    if size % 2:
        whole = joined_hashes(whole, 1, words[size - 1 : size - 1 + count], base)
    return whole


def whole_windows(first_word: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the words from which a window of ``size`` words stays inside its text."""
    counts = np.maximum(np.diff(first_word) - size + 1, 0)
    return np.arange(int(counts.sum())) + np.repeat(
        first_word[:-1] - (np.cumsum(counts) - counts), counts
    )
