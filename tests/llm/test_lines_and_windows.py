"""Line and substring dedup against plain versions, and the perfect hash by itself."""

import hashlib
import random
import re

import numpy as np
import pytest
from awkward_rows import AWKWARD

from tillsight.llm import line_dedup, substring_dedup
from tillsight.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_lines(rows, least=10):
    blanks = " \t\n\x0b\x0c\r"
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    key = lambda line: line.strip(blanks).translate(lower)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None:
                holders.setdefault(key(line), set()).add(doc)
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if doc is None or len(key(line)) < least or doc == min(holders[key(line)])
        ]
        result.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return result


def plain_windows(rows, size=20):
    first, result = {}, []
    words = lambda text: re.findall(r"[^\x20\x09-\x0D]+", text or "")
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            if doc is not None:
                at = tuple(w[i : i + size])
                first[at] = min(first.get(at, (doc, i)), (doc, i))
    for doc, text in rows:
        w = words(text)
        keep = [True] * len(w)
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i : i + size])] != (doc, i):
                keep[i : i + size] = [False] * size
        kept = [word for word, k in zip(w, keep) if k]
        result.append((doc, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return result


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def made_up(seed, count=120):
    random.seed(seed)
    passages = [" ".join(random.choices("abcdefgh", k=random.randint(5, 60))) for _ in range(8)]
    lines = ["A line that Many share ", "short", "  a line that many SHARE", "zwölf Wörter sind es", "\tx", "0123456789"]
    rows = []
    for doc in range(count):
        parts = random.choices(passages, k=random.randint(0, 3)) + [" ".join(random.choices("ijklmnop", k=25))]
        random.shuffle(parts)
        rows.append((doc, " ".join(parts) + "\n" + "\n".join(random.choices(lines, k=random.randint(0, 4)))))
    return rows


@pytest.mark.parametrize("rows", [AWKWARD, made_up(1), made_up(2)], ids=["awkward", "made up", "more"])
def test_lines(documents, rows):
    found = line_dedup.line_dedup_digest(documents(rows))
    assert ordered(found.collect()) == ordered(plain_lines(rows))


def test_lines_over_many_shards(documents):
    rows = made_up(3)
    table = documents(rows, 7)
    kept = line_dedup.drop_repeated_lines(table, shard_lines=5)
    assert kept.columns == table.columns
    counts = {(row[0], row[3]) for row in plain_lines(rows)}
    assert {(r.doc_id, sha(r.text)) for r in kept.collect()} == counts


def test_lines_keep_nulls_and_other_columns(documents):
    table = documents([(1, None), (2, "b")])
    assert ordered(line_dedup.drop_repeated_lines(table).collect()) == ordered(table.collect())


def test_lines_of_nothing(documents):
    assert line_dedup.line_dedup_digest(documents([])).collect() == []


def test_perfect_hash_is_minimal():
    pairs = np.random.default_rng(1).integers(0, 2**64, (5000, 2), dtype=np.uint64)
    pairs[:2500, 0] = pairs[0, 0]  # halves that repeat
    function = line_dedup.PerfectHash.build(pairs[:, 0], pairs[:, 1])
    again = line_dedup.PerfectHash.unpacked(function.packed())
    assert sorted(again.places(pairs[:, 0], pairs[:, 1]).tolist()) == list(range(5000))


@pytest.mark.parametrize("rows", [AWKWARD, made_up(4), made_up(5)], ids=["awkward", "made up", "more"])
def test_windows(documents, rows):
    found = substring_dedup.substring_dedup_digest(documents(rows))
    assert ordered(found.collect()) == ordered(plain_windows(rows))


@pytest.mark.parametrize("size", [2, 6, 48])
def test_windows_of_other_sizes(documents, size):
    rows = made_up(6, 40)
    found = substring_dedup.remove_repeated_windows(documents(rows, 5), size=size, buckets=3)
    digest = [(r.doc_id, r._n_words, r._n_removed, sha(r.text)) for r in found.collect()]
    assert ordered(digest) == ordered(plain_windows(rows, size))


def test_levels_double():
    assert substring_dedup.part_lengths(20) == [10]
    assert substring_dedup.part_lengths(64) == [8, 16, 32]
    assert substring_dedup.part_lengths(2) == [1]


@pytest.mark.parametrize("shared, asked", [(0, [8]), (12, [8, 16]), (70, [8, 16, 32])])
def test_levels_end_when_no_window_survives(documents, monkeypatch, shared, asked):
    # no part of 16 words is repeated where twelve are shared, so no level follows that one
    passage = [f"p{i}" for i in range(shared)]
    own = lambda doc, side: [f"{doc}{side}{i}" for i in range(80)]
    rows = [(doc, " ".join(own(doc, "a") + passage + own(doc, "b"))) for doc in range(6)]
    levels, ask = [], substring_dedup._ask_parts

    def counted(size, length, *others):
        levels.append(length)
        return ask(size, length, *others)

    monkeypatch.setattr(substring_dedup, "_ask_parts", counted)
    found = substring_dedup.remove_repeated_windows(documents(rows, 3), size=64)
    digest = [(r.doc_id, r._n_words, r._n_removed, sha(r.text)) for r in found.collect()]
    assert ordered(digest) == ordered(plain_windows(rows, 64))
    assert levels == asked[: len(levels)]
    assert shared < 64 or levels == asked


def test_odd_windows_are_refused(documents):
    with pytest.raises(ValueError):
        substring_dedup.remove_repeated_windows(documents([]), size=7)


def test_windows_of_nothing(documents):
    assert substring_dedup.substring_dedup_digest(documents([])).collect() == []


def test_windows_on_the_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(QUERIES["op3_substring_dedup"](spark, small).collect()) == ordered(plain_windows(rows))
