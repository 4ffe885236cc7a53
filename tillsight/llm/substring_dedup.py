"""Passages that a corpus repeats are kept where they come first.

Repeats are found level by level. At the first level short parts of windows are
compared, and of those only one in each full window: the one with the smallest
hash, so equal windows put forward equal parts. Only windows whose part is
repeated survive; at the next level parts of twice the length speak for these,
and so on until no window survives or the parts are whole windows, of which all
but the first of equal ones are removed. A window that a level drops is not
compared again, and a document without any is not hashed again.

Each piece of the input settles its own repeats before it asks the rest of the
corpus, so a passage that is everywhere is asked for once per piece.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.texts import (
    WINDOW_BASES,
    hash_buckets,
    mixed,
    pieces,
    text_buffer,
    text_bytes,
    whole_windows,
    window_hashes,
    word_hashes,
    word_spans,
)
from tillsight.workspace import cut_lineage

#: Words of a window.
WINDOW = 20
#: Words of a part at least: shorter ones are repeated everywhere and would drop nothing.
LEAST_PART = 8

_DEALT = "bucket int, known boolean, hashes binary, checks binary, docs binary, starts binary"
_KINDS = {"hashes": np.uint64, "checks": np.uint32, "docs": np.int64, "starts": np.int32}


def _dealt(bucket: int, known: bool, **arrays) -> dict:
    empty = {name: np.empty(0, kind) for name, kind in _KINDS.items()}
    packed = {
        name: np.ascontiguousarray(values, _KINDS[name]).tobytes()
        for name, values in (empty | arrays).items()
    }
    return {"bucket": bucket, "known": known} | packed


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("bucket", pa.int32()), ("known", pa.bool_()), *((name, pa.binary()) for name in _KINDS)]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def _gathered(table: pa.Table, known: bool) -> dict[str, np.ndarray]:
    """The arrays of all rows of a bucket that are settled already, or that are not."""
    flags = table["known"].to_pylist()
    return {
        name: np.concatenate([
            np.empty(0, kind),
            *(np.frombuffer(x, kind) for x, k in zip(table[name].to_pylist(), flags) if k == known),
        ])
        for name, kind in _KINDS.items()
    }


def _by_bucket(hashes: np.ndarray, buckets: int):
    """(bucket, members) of those that have any."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for number in np.flatnonzero(np.diff(edges)).tolist():
        yield number, order[edges[number] : edges[number + 1]]


class _Windows:
    """The windows of a piece of the input that the level before let survive."""

    def __init__(self, piece: pa.RecordBatch, size: int, before: int | None = None):
        data, bounds = text_buffer(piece.column("text"))
        starts, ends, self.first = word_spans(data, bounds)
        self.words = word_hashes(data, starts, ends)
        self.at = whole_windows(self.first, size)
        self.size = size
        if before is not None:
            lists = piece.column("_parts")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            starts = np.repeat(self.first[:-1], sizes) + lists.flatten().to_numpy(zero_copy_only=False)
            repeated = np.zeros(len(self.words), dtype=bool)
            repeated[starts[starts < len(repeated)]] = True
            self.parts, self.speaker = self.spoken_for(before)
            survives = repeated[self.speaker]
            self.at, self.speaker = self.at[survives], self.speaker[survives]
        ids = np.array([-1 if i is None else i for i in piece.column("doc_id").to_pylist()], np.int64)
        named = piece.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(piece.num_rows), np.diff(self.first))
        self.doc, self.named = ids[row], named[row]
        self.place = np.arange(len(row)) - self.first[row]

    def spoken_for(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of parts of ``length`` words, and the place of the one that speaks for each window."""
        parts = mixed(window_hashes(self.words, length))
        if not len(self.at):
            return parts, self.at
        smallest = sliding_window_view(parts, self.size - length + 1).argmin(axis=1)
        return parts, self.at + smallest[self.at]


def _surviving(batches):
    """Documents that the level before found a repeated part in."""
    for batch in batches:
        yield batch.filter(batch.column("_parts").is_valid())


def part_lengths(size: int) -> list[int]:
    """Words of a part at each level: half a window, half of that, and so on, the shortest first."""
    lengths = [size // 2]
    while lengths[0] % 2 == 0 and lengths[0] // 2 >= LEAST_PART:
        lengths.insert(0, lengths[0] // 2)
    return lengths


def _ask_parts(size: int, length: int, before: int | None, buckets: int):
    """A level: the parts of ``length`` words that speak for a window still there."""

    def run(batches):
        spread = count()
        for piece in pieces(batches if before is None else _surviving(batches)):
            windows = _Windows(piece, size, before)
            parts, speaker = windows.spoken_for(length)
            at = np.unique(speaker[windows.named[speaker]])
            hashes = parts[at]
            _, first, which, times = np.unique(
                hashes, return_index=True, return_inverse=True, return_counts=True
            )
            single = times[which] == 1
            rows = []
            # asks carry a document; repeats within the piece only tell that they are there
            for places, tell in ((at[single], False), (at[first[times > 1]], True)):
                found = parts[places]
                for bucket, members in _by_bucket(found, buckets):
                    docs = np.full(len(members), -1) if tell else windows.doc[places[members]]
                    starts = np.full(len(members), -1) if tell else windows.place[places[members]]
                    rows.append(_dealt(bucket, False, hashes=found[members], docs=docs, starts=starts))
            repeated = at[~single]
            if len(repeated):
                rows.append(_dealt(
                    (next(spread) * 7919 + int(repeated[0])) % buckets, True,
                    docs=windows.doc[repeated], starts=windows.place[repeated],
                ))
            if rows:
                yield _batch(rows)

    return run


def _repeated_parts(table: pa.Table) -> pa.Table:
    """(doc_id, start) of every part that occurs twice."""
    asked, known = _gathered(table, False), _gathered(table, True)
    _, which, times = np.unique(asked["hashes"], return_inverse=True, return_counts=True)
    # what tells but does not ask stands for two at least
    told = np.bincount(which, weights=asked["starts"] < 0, minlength=len(times)) > 0
    wanted = ((times > 1) | told)[which] & (asked["starts"] >= 0)
    return pa.table({
        "doc_id": np.concatenate([known["docs"], asked["docs"][wanted]]),
        "start": np.concatenate([known["starts"], asked["starts"][wanted]]),
    })


def _ask_windows(size: int, before: int, buckets: int):
    """Last level: the windows still there, whole."""

    def run(batches):
        spread = count()
        for piece in pieces(_surviving(batches)):
            windows = _Windows(piece, size, before)
            at, speaker = windows.at, windows.speaker
            if not len(at):
                continue
            hashes = mixed(window_hashes(windows.words, size))[at]
            checks = (mixed(window_hashes(windows.words, size, WINDOW_BASES[1]))[at] >> np.uint64(32)).astype(np.uint32)
            docs, starts = windows.doc[at], windows.place[at]
            order = np.lexsort((starts, docs, checks, hashes))
            same = (hashes[order][1:] == hashes[order][:-1]) & (checks[order][1:] == checks[order][:-1])
            later = np.zeros(len(at), dtype=bool)
            # of windows that share both document and start, as rows that share an id have, none is later
            firsts = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(at)), 0))
            earliest = order[firsts]
            later[order] = (docs[order] != docs[earliest]) | (starts[order] != starts[earliest])
            rows = []
            asking = np.flatnonzero(~later)
            for bucket, members in _by_bucket(windows.parts[speaker[asking]], buckets):
                chosen = asking[members]
                rows.append(_dealt(
                    bucket, False, hashes=hashes[chosen], checks=checks[chosen],
                    docs=docs[chosen], starts=starts[chosen],
                ))
            if later.any():
                rows.append(_dealt(
                    (next(spread) * 7919 + int(hashes[0] % np.uint64(buckets))) % buckets, True,
                    docs=docs[later], starts=starts[later],
                ))
            yield _batch(rows)

    return run


def _later_windows(table: pa.Table) -> pa.Table:
    """Runs (doc_id, start, count) of windows that occur earlier too."""
    asked, known = _gathered(table, False), _gathered(table, True)
    order = np.lexsort((asked["starts"], asked["docs"], asked["checks"], asked["hashes"]))
    hashes, checks, docs, starts = (asked[name][order] for name in _KINDS)
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (checks[1:] == checks[:-1])])[: len(order)]
    earliest = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    later = (docs != docs[earliest]) | (starts != starts[earliest])
    docs = np.concatenate([known["docs"], docs[later]])
    starts = np.concatenate([known["starts"], starts[later]])
    order = np.lexsort((starts, docs))
    docs, starts = docs[order], starts[order]
    opens = np.concatenate([[True], (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + 1)])[: len(docs)]
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(docs))[: len(at)] - 1
    return pa.table({
        "doc_id": docs[at], "start": starts[at], "count": (starts[last] - starts[at] + 1).astype(np.int32)
    })


def _kept_words(words: list[bytes], runs: list[tuple[int, int]], size: int) -> list[bytes]:
    """The words that no removed window covers."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int32)
    for start, number in runs:
        if start < len(words):
            cover[start] += 1
            cover[min(len(words), start + number - 1 + size)] -= 1
    keep = np.cumsum(cover[:-1]) == 0
    return [word for word, kept in zip(words, keep.tolist()) if kept]


def repeated_runs(docs: DataFrame, size: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """(doc_id, runs): runs of removed windows of each document that has any.

    ``docs`` has just ``doc_id`` and ``text``.
    """
    buckets = buckets or hash_buckets(docs)
    lengths = part_lengths(size)
    left = docs
    for before, length in zip([None, *lengths], lengths):
        parts = (
            left.mapInArrow(_ask_parts(size, length, before, buckets), _DEALT)
            .groupBy("bucket")
            .applyInArrow(_repeated_parts, "doc_id bigint, start int")
        )
        by_doc = parts.groupBy(F.col("doc_id").alias("_of")).agg(F.collect_list("start").alias("_parts"))
        by_doc = cut_lineage(by_doc, f"repeated-parts-{length}")
        if by_doc.isEmpty():
            return docs.sparkSession.createDataFrame([], "_of bigint, _runs array<struct<start:int,count:int>>")
        # a left join, so that documents are shuffled once for this and the last join; see _surviving
        left = docs.join(by_doc, docs["doc_id"] == by_doc["_of"], "left").select("doc_id", "text", "_parts")
    later = (
        left.mapInArrow(_ask_windows(size, lengths[-1], buckets), _DEALT)
        .groupBy("bucket")
        .applyInArrow(_later_windows, "doc_id bigint, start int, count int")
    )
    return later.groupBy(F.col("doc_id").alias("_of")).agg(
        F.collect_list(F.struct("start", "count")).alias("_runs")
    )


def _shortened(size: int, names: list[str]):
    def run(batches):
        for piece in pieces(batches):
            texts, totals, removed = [], [], []
            for text, runs in zip(text_bytes(piece.column("text")), piece.column("_runs").to_pylist()):
                words = text.split()
                kept = _kept_words(words, [(r["start"], r["count"]) for r in runs or ()], size)
                texts.append(b" ".join(kept))
                totals.append(len(words))
                removed.append(len(words) - len(kept))
            yield pa.record_batch(
                [*(piece.column(name) for name in names), pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(totals, pa.int64()), pa.array(removed, pa.int64())],
                names=[*names, "text", "_n_words", "_n_removed"],
            )

    return run


def remove_repeated_windows(docs: DataFrame, size: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, _n_words, _n_removed): texts without what is said earlier.

    A word goes if a window of ``size`` words over it also starts earlier: in a
    document of smaller id, or before in the same. What stays is joined by
    single spaces. ``size`` is even. A null text has no words. A document
    without an id is neither compared nor shortened. ``doc_id`` names a text:
    rows that share an id do not remove each other's windows of equal start,
    and each loses what is removed from any of them. An empty table gives an
    empty one. There are as many hash buckets as shuffles have partitions, or
    more where the texts need them.
    """
    if size % 2 or size < 2:
        raise ValueError("a window has an even number of words")
    needed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    runs = repeated_runs(needed, size, buckets)
    return (
        needed.join(runs, needed["doc_id"] == runs["_of"], "left")
        .select("doc_id", "text", "_runs")
        .mapInArrow(
            _shortened(size, ["doc_id"]), "doc_id bigint, text string, _n_words bigint, _n_removed bigint"
        )
    )


def substring_dedup_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, words, removed words, and the hash of what is kept.

    Nulls, empty texts, repeated rows and rows without an id as in
    ``remove_repeated_windows``; other columns are ignored.
    """
    return remove_repeated_windows(docs).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
