"""Documents into batches of about equal length within a budget of tokens.

A batch is padded to the length limit of its bucket. Dynamic programming over
the histogram of all lengths finds the limits that need the least padding. The
histogram starts coarse above a few thousand tokens; a cell that the solution
puts a limit in is cut finer until every limit is a length of its own, so the
driver sees few cells and the limits are the best of all. Inside a bucket each
batch takes as many documents as the budget allows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillsight.llm.texts import pieces, text_bytes
from tillsight.workspace import cut_lineage

BUCKETS = 16
#: Tokens of a batch, padding included.
TOKEN_BUDGET = 65_536
#: Documents that one task numbers, about.
ROWS_PER_SHARD = 100_000
#: Lengths up to this are told apart at first; longer ones by steps of a 64th of a power of two.
EXACT_LENGTHS = 4_096
#: Parts that a cell is cut into.
PARTS = 64


def length_cell():
    """Where a length falls in a histogram whose size does not depend on the data."""
    step = F.greatest(F.lit(1.0), F.pow(2.0, F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))) - 6))
    coarse = F.ceil(F.col("n_tokens") / step) * step
    return F.when(F.col("n_tokens") <= EXACT_LENGTHS, F.col("n_tokens")).otherwise(
        coarse.cast("bigint")
    )


def length_counts(lengths: DataFrame) -> DataFrame:
    """(n_tokens, documents): a row for each length, stored."""
    return cut_lineage(lengths.groupBy("n_tokens").agg(F.count("*").alias("documents")), "length-counts")


def _histogram(counts: DataFrame, cell) -> np.ndarray:
    """(smallest length, largest, documents, tokens) of each cell."""
    rows = counts.groupBy(cell.alias("cell")).agg(
        F.min("n_tokens"), F.max("n_tokens"), F.sum("documents"), F.sum(F.col("documents") * F.col("n_tokens"))
    )
    return np.array([row[1:] for row in rows.collect()], dtype=np.int64).reshape(-1, 4)


def _cut_finer(counts: DataFrame, cells: np.ndarray) -> np.ndarray:
    """The histogram of these cells (no more than there are buckets), each in equal parts."""
    part, inside = F.lit(None).cast("bigint"), F.lit(False)
    for number, (shortest, longest) in enumerate(cells[:, :2].tolist()):
        step = math.ceil((longest - shortest + 1) / PARTS)
        here = F.col("n_tokens").between(shortest, longest)
        at = F.floor((F.col("n_tokens") - shortest) / step) + number * PARTS
        part, inside = F.when(here, at).otherwise(part), inside | here
    return _histogram(counts.filter(inside), part)


def _limit_cells(cells: np.ndarray, buckets: int) -> list[int]:
    """Numbers of the cells that the cheapest limits lie in, at most ``buckets``; never too dear.

    Documents of a cell with a limit count as unpadded, and those of the cells
    between two limits as padded to the smallest length of the upper one. This
    is no more than any limits inside the cells need, and exact where each cell
    with a limit has one length.
    """
    count = len(cells)
    shortest = cells[:, 0].astype(float)
    documents = np.concatenate([[0], np.cumsum(cells[:, 2])]).astype(float)
    tokens = np.concatenate([[0], np.cumsum(cells[:, 3])]).astype(float)
    buckets = min(buckets, count)
    # least[k, j]: padding of the first j cells in k buckets; came[k, j]: where the last begins
    least = np.full((buckets + 1, count + 1), np.inf)
    came = np.zeros((buckets + 1, count + 1), dtype=np.int64)
    least[0, 0] = 0
    for end in range(1, count + 1):
        inner = documents[end - 1] - documents[:end], tokens[end - 1] - tokens[:end]
        totals = least[:-1, :end] + (shortest[end - 1] * inner[0] - inner[1])
        came[1:, end] = totals.argmin(axis=1)
        least[1:, end] = totals[np.arange(buckets), came[1:, end]]
    chosen, end = [], count
    for k in range(int(least[1:, count].argmin()) + 1, 0, -1):
        chosen.append(end - 1)
        end = came[k, end]
    return chosen[::-1]


def best_limits(histogram: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` length limits with the least padding in total.

    ``histogram`` has a row (length, documents, tokens) for each length, ascending.
    """
    if not len(histogram):
        return []
    return histogram[_limit_cells(histogram[:, [0, 0, 1, 2]], buckets), 0].tolist()


def optimal_limits(counts: DataFrame, buckets: int = BUCKETS) -> tuple[list[int], list[int]]:
    """The limits of ``best_limits`` without a row for each length, and the documents of each bucket.

    ``counts`` has a row (n_tokens, documents) for each length. Limits are
    chosen as if every limit were free to lie anywhere in its cell, which is
    never too dear; while a chosen cell has several lengths it is cut finer.
    Once none has, what is chosen costs what it seems to, so nothing is cheaper.
    """
    cells = _histogram(counts, length_cell())
    while len(cells):
        cells = cells[np.argsort(cells[:, 0])]
        chosen = _limit_cells(cells, buckets)
        wide = [at for at in chosen if cells[at, 0] < cells[at, 1]]
        if not wide:
            limits = cells[chosen, 0]
            of = np.searchsorted(limits, cells[:, 1])
            return limits.tolist(), np.bincount(of, weights=cells[:, 2], minlength=len(limits)).astype(int).tolist()
        cells = np.concatenate([np.delete(cells, wide, axis=0), _cut_finer(counts, cells[wide])])
    return [], []


def _word_counts(batches):
    for piece in pieces(batches):
        counts = [len(text.split()) for text in text_bytes(piece.column("text"))]
        yield pa.record_batch(
            [piece.column("doc_id"), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
        )


def word_lengths(docs: DataFrame) -> DataFrame:
    """``n_tokens`` of each document, counted in words; null and empty texts have none."""
    needed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return needed.mapInArrow(_word_counts, "doc_id bigint, n_tokens bigint")


def pack(
    lengths: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, rows_per_shard: int = ROWS_PER_SHARD
) -> DataFrame:
    """One row per row of ``lengths`` (doc_id, n_tokens): its bucket, batch and place in it.

    ``bucket_tokens`` is the length the document is padded to, and a batch has
    at most ``budget`` of them in all. A document longer than the budget is a
    batch by itself, whole. Large buckets are numbered in shards by hash of the
    id; each shard leaves one batch short at most. An empty table gives an
    empty one; a null length is zero.
    """
    lengths = cut_lineage(
        lengths.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0)).alias("n_tokens"),
        ),
        "lengths",
    )
    limits, totals = optimal_limits(length_counts(lengths), buckets)
    sizes = [max(1, budget // max(1, limit)) for limit in limits]
    shards = [max(1, math.ceil(total / rows_per_shard)) for total in totals]

    def of_bucket(values):
        return F.element_at(F.array(*[F.lit(v) for v in values or [1]]), F.col("bucket") + 1)

    bucket = sum((F.when(F.col("n_tokens") > limit, 1).otherwise(0) for limit in limits[:-1]), F.lit(0))
    # rows without an id are spread by their place in the stored table
    own = F.when(F.col("doc_id").isNull(), F.xxhash64(F.monotonically_increasing_id()))
    placed = lengths.withColumn("_hash", F.coalesce(own, F.xxhash64("doc_id"))).withColumn("bucket", bucket)
    placed = placed.withColumn("shard", F.pmod("_hash", of_bucket(shards)).cast("int"))
    order = Window.partitionBy("bucket", "shard").orderBy("_hash", "doc_id", "n_tokens")
    number = F.row_number().over(order) - 1
    per_batch = of_bucket(sizes)
    return placed.select(
        "doc_id", "n_tokens", "bucket", of_bucket(limits).cast("bigint").alias("bucket_tokens"), "shard",
        F.floor(number / per_batch).cast("bigint").alias("batch"),
        (number % per_batch).cast("int").alias("place"),
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """The batches of ``docs`` by their words, as ``pack`` gives them.

    One row per document: a null or empty text has length zero, each of
    repeated rows has a place of its own, and other columns are ignored.
    """
    return pack(word_lengths(docs))
