"""Quality rules: base counts of a text, and how like trusted text it reads.

A word n-gram falls into one of a fixed number of hash buckets. Two
multinomials over the buckets, one counted from every document and one from
trusted documents, give each bucket a log-likelihood ratio. A document's score
is the mean ratio of its n-grams. It is kept if the base rules pass and the
score reaches a threshold read from labelled documents. For the threshold these
are scored like documents without a label: by counts of other trusted ones.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.texts import (
    joined_hashes,
    WINDOW_BASES,
    mixed,
    pieces,
    text_bytes,
    text_buffer,
    whole_windows,
    word_hashes,
    word_spans,
)
from tillsight.workspace import cut_lineage

#: Hash buckets of n-grams; bounds the model, whatever the corpus.
BUCKETS = 1 << 17
#: Parts of the labelled documents; each is scored by the trusted counts of the others.
FOLDS = 16
#: Base rules: fewest words, and most of them in repeated windows, in percent.
LEAST_WORDS = 50
MOST_REPEATED = 50
_SYMBOLS = [symbol.encode() for symbol in "#*$%&|<>"]
_CHUNKS = 32
#: Tasks whose counts are added up together before all are.
FAN_IN = 256

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five base counts of one text, in the order of ``BASE``."""
    words = text.split()
    letters = b"".join(words)
    chars = len(letters) if letters.isascii() else len(letters.decode())
    symbols = sum(text.count(symbol) for symbol in _SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) < len(windows):
        covered_to = 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeated += start + 3 - max(start, covered_to)
                covered_to = start + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _grams(piece: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of words, and the row each comes from."""
    data, bounds = text_buffer(piece.column("text"))
    starts, ends, first = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(piece.num_rows), np.diff(first))
    at = whole_windows(first, 2)
    pairs = joined_hashes(words[at], 1, words[at + 1], WINDOW_BASES[0]) if len(at) else words[:0]
    slots = (np.concatenate([words, mixed(pairs)]) & np.uint64(buckets - 1)).astype(np.int64)
    return slots, np.concatenate([row, row[at]])


def _count_grams(buckets: int, parts: int):
    """Each task's counts for each ``part`` of the rows, as packed runs of buckets."""

    def run(batches):
        counts = np.zeros((parts, buckets), dtype=np.int64)
        for piece in pieces(batches):
            slots, row = _grams(piece, buckets)
            of = piece.column("part").to_numpy(zero_copy_only=False)
            for part in np.unique(of):
                counts[part] += np.bincount(slots[(of == part)[row]], minlength=buckets)
        runs = counts.reshape(parts, _CHUNKS, -1).transpose(1, 0, 2)
        yield pa.record_batch([
            pa.array(range(_CHUNKS), pa.int32()),
            pa.array([TaskContext.get().partitionId() // FAN_IN] * _CHUNKS, pa.int32()),
            pa.array([np.ascontiguousarray(run).tobytes() for run in runs], pa.binary()),
        ], names=["run", "lot", "counts"])

    return run


def _add_up(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0)
    return pa.table({
        "run": table.column("run").slice(0, 1), "lot": table.column("lot").slice(0, 1),
        "counts": pa.array([total.tobytes()], pa.binary()),
    })


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of every labelled document, each once."""
    known = labels.filter("doc_id is not null and quality is not null")
    ids = known.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int"))
    return ids.groupBy("doc_id").agg(F.max("quality").alias("quality"))


def gram_counts(texts: DataFrame, parts: int, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in each ``part`` of (text, part).

    All rows are counted. Counts are added up by lots of ``FAN_IN`` tasks and
    then over all lots. They come to the driver, ``buckets`` numbers a part.
    """
    columns = "run int, lot int, counts binary"
    counted = texts.mapInArrow(_count_grams(buckets, parts), columns)
    by_lot = counted.groupBy("run", "lot").applyInArrow(_add_up, columns)
    runs = by_lot.groupBy("run").applyInArrow(_add_up, columns).collect()
    if not runs:
        return np.zeros((parts, buckets), np.int64)
    by_run = {row["run"]: np.frombuffer(row["counts"], np.int64).reshape(parts, -1) for row in runs}
    return np.concatenate([by_run[run] for run in range(_CHUNKS)], axis=1)


def gram_ratios(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Log ratio of trusted to raw probability; one is added to each count."""
    raw, trusted = raw + 1.0, trusted + 1.0
    return np.log(trusted / trusted.sum(axis=-1, keepdims=True)) - np.log(raw / raw.sum())


def _scored(ratios, buckets: int):
    """Appends the base counts, and each row's score by the last ratios and by those of its ``part``."""

    def run(batches):
        table = ratios.value
        for piece in pieces(batches):
            counts = np.array([base_counts(t) for t in text_bytes(piece.column("text"))], np.int64)
            counts = counts.reshape(piece.num_rows, len(BASE))
            slots, row = _grams(piece, buckets)
            part = piece.column("part").to_numpy(zero_copy_only=False)
            number = np.maximum(np.bincount(row, minlength=piece.num_rows), 1)
            score, held_out = (
                np.bincount(row, weights=weights, minlength=piece.num_rows) / number
                for weights in (table[-1, slots], table[part[row], slots])
            )
            rest = [name for name in piece.schema.names if name not in ("text", "part")]
            yield pa.record_batch(
                [*(piece.column(name) for name in rest),
                 *(pa.array(counts[:, i]) for i in range(len(BASE))), pa.array(score), pa.array(held_out)],
                names=[*rest, *BASE, "score", "held_out"],
            )

    return run


def base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )


def best_threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut that parts labelled texts best, set as low as that allows.

    Among all cuts it maximises the share of good texts at or above it plus
    the share of bad texts below it; then it moves down to the middle of the
    gap under it. Without both kinds of label nothing is rejected.
    """
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    cuts = np.flatnonzero(np.concatenate([[True], scores[1:] > scores[:-1]]))
    good_below = np.concatenate([[0], np.cumsum(good)])[cuts]
    bad_below = cuts - good_below
    gain = bad_below / (~good).sum() - good_below / good.sum()
    best = int(np.argmax(gain))
    at = cuts[best]
    return float(scores[at]) if at == 0 else float((scores[at] + scores[at - 1]) / 2)


def threshold_of(judged: DataFrame) -> float:
    """``best_threshold`` of (score, good) rows, however many: one total per range comes together in one task."""
    classes = [F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")]
    groups = judged.groupBy("score").agg(*classes)
    in_ranges = groups.repartitionByRange("score").withColumn("range", F.spark_partition_id())
    ranges = cut_lineage(in_ranges, "quality-cuts")
    every = ranges.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not every.good or not every.bad:
        return float("-inf")
    totals = ranges.groupBy("range").agg(F.max("score").alias("last"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    earlier = Window.orderBy("range")
    until = earlier.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "range", F.lag("last").over(earlier).alias("last"),
        *[F.coalesce(F.sum(name).over(until), F.lit(0)).alias(f"{name}_before") for name in ("good", "bad")],
    )
    within = Window.partitionBy("range").orderBy("score")
    lower = within.rowsBetween(Window.unboundedPreceding, -1)

    def share_below(name):
        below = F.col(f"{name}_before") + F.coalesce(F.sum(name).over(lower), F.lit(0))
        return below / F.lit(every[name])

    # A row for each range.
    cuts = ranges.join(F.broadcast(totals), "range").select(
        "score", F.coalesce(F.lag("score").over(within), "last").alias("below"),
        (share_below("good") - share_below("bad")).alias("loss"),
    )
    best = cuts.agg(F.min(F.struct("loss", "score", "below")).alias("best")).first().best
    return best.score if best.below is None else (best.score + best.below) / 2


def scored_documents(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, float]:
    """Base counts and score of every document, and the threshold of the score.

    One row per row of ``docs``, stored, without the texts. A null text is
    empty: no words, score zero. Ties at the threshold are kept. An empty table
    has no rows and rejects nothing.
    """
    spark = docs.sparkSession
    needed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = cut_lineage(labelled(labels), "quality-labels")
    trusted_texts = needed.join(known.filter("quality = 1"), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    raw = gram_counts(needed.select("text", F.lit(0).alias("part")), 1, buckets)[0]
    by_fold = gram_counts(trusted_texts.select("text", fold.alias("part")), FOLDS, buckets)
    trusted = by_fold.sum(axis=0)
    counts = ", ".join(f"{name} bigint" for name in BASE)
    # Each fold's ratios are without its own trusted texts; the last are by all.
    ratios = spark.sparkContext.broadcast(gram_ratios(raw, np.vstack([trusted - by_fold, trusted])))
    columns = f"doc_id bigint, {counts}, score double, held_out double"
    scores = needed.withColumn("part", fold).mapInArrow(_scored(ratios, buckets), columns)
    scored = cut_lineage(scores, "quality-scores")
    judged = scored.filter(~base_failed()).join(known, "doc_id")
    threshold = threshold_of(judged.select(F.col("held_out").alias("score"), (F.col("quality") == 1).alias("good")))
    return scored.drop("held_out"), threshold


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: base counts, ``base_failed``, ``score`` and ``kept``.

    Nulls, ties, repeated rows and empty tables as in ``scored_documents``.
    """
    scored, threshold = scored_documents(docs, labels)
    return scored.select(
        "doc_id", *BASE, base_failed().alias("base_failed"),
        (~base_failed() & (F.col("score") >= F.lit(threshold))).alias("kept"), "score",
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they have.

    Rows that share an id pass if one of them does; a row without an id passes
    by the base rules' and the score's verdict on texts without an id taken
    together, the same way.
    """
    kept = quality_verdicts(docs, labels).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
