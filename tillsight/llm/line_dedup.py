"""Repeated lines are kept in the first document that holds them.

Distinct line hashes are dealt out over shards by hash. Each shard holds a
minimal perfect hash over its lines, built level by level: every level is a bit
array in which a line owns a bit if no other line of that level falls on it,
and lines without one go on to the next. The rank of a line's bit is its place
in three compact arrays: fingerprint, number of documents, first document.
Documents look their lines up in these arrays by shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.texts import boxed, mixed, pieces, text_bytes, unboxed
from tillsight.workspace import cut_lineage

#: The shortest key, in code points, that is looked at.
LEAST_KEY = 10
#: Lines looked up per shard of the index, about.
SHARD_LINES = 500_000

_BITS_PER_LINE = 2
_ASKED = "line binary, doc_id bigint, documents bigint, ask boolean"
_INDEX = "shard int, lines bigint, levels array<binary>, fingerprints binary, counts binary, firsts binary"


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z lower-cased (bytes methods touch ASCII only)."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class PerfectHash:
    """A minimal perfect hash over distinct pairs of 64-bit numbers."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks = [np.cumsum(bits, dtype=np.int64) - bits for bits in levels]
        self._before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            slots = cls._slots(high, low, len(levels), max(64, _BITS_PER_LINE * len(high)))
            owned = np.bincount(slots[0], minlength=slots[1]) == 1
            levels.append(owned)
            left = ~owned[slots[0]]
            high, low = high[left], low[left]
        return cls(levels)

    @staticmethod
    def _slots(high, low, level, size):
        size = -(-size // 8) * 8
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return mixed(mixed(high.astype(np.uint64) ^ seed) + low.astype(np.uint64)) % np.uint64(
            size
        ), size

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of each pair; any number, or -1, for pairs it was not built from."""
        found = np.full(len(high), -1, dtype=np.int64)
        open_ = np.arange(len(high))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            slots, _ = self._slots(high[open_], low[open_], level, len(bits))
            owned = bits[slots]
            found[open_[owned]] = self._before[level] + self._ranks[level][slots[owned]]
            open_ = open_[~owned]
        return found

    def packed(self) -> list[bytes]:
        return [np.packbits(bits).tobytes() for bits in self.levels]

    @classmethod
    def unpacked(cls, levels: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in levels])


def _fingerprint(high: np.ndarray) -> np.ndarray:
    return (high.astype(np.uint64) >> np.uint64(48)).astype(np.uint16)


def _questions(least: int):
    """Per piece of the input: each line key once, asked for by the first document that has it.

    The other documents of the piece that have the key lose it whatever the
    rest of the corpus holds, so they need not ask; a line that is everywhere
    comes up once per piece and not once per document.
    """

    def run(batches):
        for piece in pieces(batches):
            seen: dict[bytes, list[int]] = {}
            for doc, text in zip(piece.column("doc_id").to_pylist(), text_bytes(piece.column("text"))):
                if doc is None:
                    continue
                for key in {line_key(line) for line in text.split(b"\n")}:
                    if _long_enough(key, least):
                        seen.setdefault(_digest(key), []).append(doc)
            digests, docs, counts, ask = [], [], [], []
            for digest, holders in seen.items():
                holders = sorted(set(holders))
                docs += holders
                counts += [len(holders)] + [0] * (len(holders) - 1)
                ask += [True] + [False] * (len(holders) - 1)
                digests += [digest] * len(holders)
            yield pa.record_batch(
                [pa.array(digests, pa.binary()), pa.array(docs, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(ask, pa.bool_())],
                names=["line", "doc_id", "documents", "ask"],
            )

    return run


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    whole = np.frombuffer(b"".join(table.column("line").to_pylist()), dtype="<u8").reshape(-1, 2)
    return whole[:, 0], whole[:, 1]


def _build_shard(table: pa.Table) -> pa.Table:
    high, low = _halves(table)
    function = PerfectHash.build(high, low)
    place = function.places(high, low)
    column = lambda name: table.column(name).to_numpy()
    arrays = {}
    for name, values, kind in (
        ("fingerprints", _fingerprint(high), np.uint16),
        ("counts", np.minimum(column("documents"), 2**31 - 1), np.int32),
        ("firsts", column("first"), np.int64),
    ):
        arrays[name] = np.empty(len(place), dtype=kind)
        arrays[name][place] = values
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
        "lines": pa.array([len(place)], pa.int64()),
        "levels": pa.array([function.packed()], pa.list_(pa.binary())),
        **{name: pa.array([values.tobytes()], pa.binary()) for name, values in arrays.items()},
    })


def _probe_shard(asked: pa.Table, index: pa.Table) -> pa.Table:
    """The questions whose key an earlier document holds."""
    if not asked.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "line": pa.array([], pa.binary())})
    high, low = _halves(asked)
    docs = asked.column("doc_id").to_numpy()
    row = {name: index.column(name)[0].as_py() for name in index.column_names}
    place = PerfectHash.unpacked(row["levels"]).places(high, low)
    lost = np.frombuffer(row["fingerprints"], np.uint16)[place] == _fingerprint(high)
    lost &= np.frombuffer(row["counts"], np.int32)[place] >= 2
    lost &= np.frombuffer(row["firsts"], np.int64)[place] < docs
    return asked.select(["doc_id", "line"]).filter(pa.array(lost))


def line_index(asked: DataFrame) -> DataFrame:
    """One row per shard: the perfect hash over its lines and the arrays it points into."""
    lines = asked.filter("ask").groupBy("shard", "line").agg(
        F.sum("documents").alias("documents"), F.min("doc_id").alias("first")
    )
    return lines.groupBy("shard").applyInArrow(_build_shard, _INDEX)


def repeated_lines(docs: DataFrame, least: int = LEAST_KEY, shard_lines: int = SHARD_LINES) -> DataFrame:
    """(doc_id, line) for every line, as its key's hash, that the document has to give up.

    A document without an id neither counts nor gives up a line. Rows that
    share an id are one document to this count.
    """
    found = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    asked = cut_lineage(found.mapInArrow(_questions(least), _ASKED), "lines")
    shards = max(1, math.ceil(asked.count() / shard_lines))
    asked = asked.withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int"))
    index = cut_lineage(line_index(asked), "line-index")
    told = (
        asked.filter("ask")
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInArrow(_probe_shard, "doc_id bigint, line binary")
    )
    return told.union(asked.filter("not ask").select("doc_id", "line"))


def _kept_lines(text: bytes, lost: set[bytes], least: int) -> tuple[list[bytes], int]:
    lines = text.split(b"\n")
    if not lost:
        return lines, len(lines)
    kept = []
    for line in lines:
        key = line_key(line)
        if not (_long_enough(key, least) and _digest(key) in lost):
            kept.append(line)
    return kept, len(lines)


def _rewritten(least: int):
    """Texts without the lines they give up, and the two counts; ``row`` is passed on."""

    def run(batches):
        for piece in pieces(batches):
            texts, totals, dropped = [], [], []
            lost_column = piece.column("lost").to_pylist()
            for text, lost in zip(text_bytes(piece.column("text")), lost_column):
                kept, total = _kept_lines(text, set(lost or ()), least)
                texts.append(b"\n".join(kept))
                totals.append(total)
                dropped.append(total - len(kept))
            new = pa.array(texts, pa.binary()).cast(pa.string())
            new = pc.if_else(piece.column("text").is_valid(), new, pa.scalar(None, pa.string()))
            yield pa.record_batch(
                [piece.column("row"), new, pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    return run


def _without_repeats(docs: DataFrame, least: int, shard_lines: int) -> DataFrame:
    """(row, text, n_lines, n_dropped): the row as it was, the text that stays, the counts."""
    lost = repeated_lines(docs, least, shard_lines).groupBy("doc_id").agg(F.collect_set("line").alias("lost"))
    rows = boxed(docs).select(
        "row", F.col("text").cast("string").alias("text"), F.col("row.doc_id").cast("bigint").alias("id")
    )
    joined = rows.join(lost, rows["id"] == lost["doc_id"], "left").select("row", "text", "lost")
    counted = T.StructType([
        rows.schema["row"], T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
    ])
    return joined.mapInArrow(_rewritten(least), counted)


def drop_repeated_lines(
    docs: DataFrame, least: int = LEAST_KEY, shard_lines: int = SHARD_LINES
) -> DataFrame:
    """``docs`` with texts that have lost the lines an earlier document holds.

    A line's key is the line stripped and with A-Z lower-cased. A key of at
    least ``least`` code points that two documents hold stays only in the one
    with the smallest ``doc_id``, there with all its repeats. A null text is
    one empty line and stays null; all other columns pass through unchanged; an
    empty table gives an empty one.
    """
    return unboxed(_without_repeats(docs, least, shard_lines), docs.columns)


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``n_lines``, ``n_dropped`` and the SHA-256 of the text that stays."""
    shortened = _without_repeats(docs.select("doc_id", "text"), LEAST_KEY, SHARD_LINES)
    return shortened.select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
