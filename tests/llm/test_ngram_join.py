"""The n-gram join and its trie against plain versions."""

import random
import re
import time
from itertools import combinations

import numpy as np
import pytest
from awkward_rows import AWKWARD

from tillsight.llm import ngram_join
from tillsight.llm import components as components_module
from tillsight.llm.components import components
from tillsight.llm.queries import QUERIES


def shingles(text):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows, percent=75):
    sets = [(doc, shingles(text)) for doc, text in rows]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i][1], sets[j][1]
        same = len(a & b)
        linked = same and 100 * same >= percent * (len(a) + len(b) - same)
        if linked and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for (doc, grams), g in zip(sets, group):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    return sorted(((d, len(s), least.get(g, d)) for (d, s), g in zip(sets, group)), key=str)


def near_copies(seed, count=90):
    """Families of edited texts, some of them linked only through others."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefghij", k=4))
    passage = [word() for _ in range(30)]
    rows, bases = [], []
    for doc in range(count):
        if bases and random.random() < 0.7:
            words = list(random.choice(bases))
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = word()
            words = words[random.randint(0, 4) :]
        else:
            words = [word() for _ in range(random.randint(3, 80))]
        if random.random() < 0.3:
            words = words + passage
        bases.append(words)
        rows.append((doc, " ".join(w.title() if random.random() < 0.1 else w for w in words)))
    return rows


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.mark.parametrize("rows", [AWKWARD, near_copies(1), near_copies(2)], ids=["awkward", "near", "more"])
def test_components(documents, rows):
    assert found(ngram_join.linked_components(documents(rows))) == plain(rows)


@pytest.mark.parametrize("block", [1, 4])
def test_families_cut_into_blocks(documents, block):
    rows = near_copies(3)
    assert found(ngram_join.linked_components(documents(rows), block_sets=block, buckets=5)) == plain(rows)


def test_nothing(documents):
    assert found(ngram_join.linked_components(documents([]))) == []


def test_one_of_each_keeps_columns(documents):
    table = documents([*AWKWARD, (None, None)])
    kept = ngram_join.one_of_each(table)
    assert kept.columns == table.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 6, 8, 9, 10, None, None], key=str)


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op2_ngram_join"](spark, small)) == plain(rows)


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_trie_finds_what_overlaps(percent):
    random = np.random.default_rng(percent)
    sets = [np.unique(random.integers(0, 25, random.integers(1, 20))) for _ in range(150)]
    sizes = [len(s) + int(random.integers(0, 3)) for s in sets]  # with some that are their own
    trie = ngram_join.SetTrie(sets, sizes)
    for values, size in zip(sets, sizes):
        expected = [
            i for i, (other, n) in enumerate(zip(sets, sizes))
            if (100 + percent) * len(np.intersect1d(values, other)) >= percent * (size + n)
        ]
        assert sorted(trie.linked(values, size, 25, percent)) == expected


@pytest.mark.parametrize("seed", range(8))
def test_settled_component_hides_no_link(seed):
    """Windows over a line of numbers link in chains; half of them soon are one component."""
    random = np.random.default_rng(seed)
    starts = np.concatenate([random.integers(0, 15, 20), random.integers(15, 60, 15)])
    sets = [np.arange(start, start + random.integers(18, 23)) for start in random.permutation(starts)]
    joined = _groups(len(sets), ngram_join.block_links(sets, [len(s) for s in sets], 100, 75))
    every = [
        (i, j) for i, j in combinations(range(len(sets)), 2)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    ]
    assert joined == _groups(len(sets), every)


def test_a_large_block_is_walked_for_many_sets_at_once():
    """Sets of one text edited at random link to some and not to others; one by one they took half a minute."""
    random = np.random.default_rng(5)
    edits = random.integers(15, 60, 1200)
    sets = [np.union1d(random.choice(400, 400 - n, replace=False) + 4000, random.integers(0, 4000, n)) for n in edits]
    sizes = [len(s) for s in sets]
    began = time.process_time()
    joined = _groups(len(sets), ngram_join.block_links(sets, sizes, 4400, 75))
    assert time.process_time() - began < 10
    rows = np.zeros((len(sets), 4400), np.float32)
    for row, values in zip(rows, sets):
        row[values] = 1
    same = rows @ rows.T
    size = np.array(sizes)
    every = 175 * same >= 75 * (size[:, None] + size)
    least = np.arange(len(sets))
    while (lower := np.where(every, least, len(sets)).min(axis=1)).tolist() != least.tolist():
        least = lower
    assert 1 < len(set(joined)) < len(sets) and joined == least.tolist()


def _groups(count, pairs):
    group = list(range(count))
    for a, b in pairs:
        group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    return group


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)] + [(139, 90), (7, 7)]
    links = spark.createDataFrame(path + star, "a bigint, b bigint")
    names = {r.node: r.component for r in components(links).collect()}
    assert {names[i] for i in range(61)} == {0}
    assert {names[i] for i in [90, *range(100, 140)]} == {90}


def shapes():
    random = np.random.default_rng(11)
    number = random.permutation(1000).tolist()
    ascending = [(i, i + 1) for i in range(999)]
    return {
        "ascending": ascending, "descending": [(b, a) for a, b in reversed(ascending)],
        "random": [(number[a], number[b]) for a, b in ascending], "star": [(999, i) for i in range(999)],
        "least hubs": [(500 + i // 2, i) for i in range(999) if i != 500 + i // 2],
    }


@pytest.mark.parametrize("name", sorted(shapes()))
def test_rounds_grow_as_the_logarithm(spark, monkeypatch, name):
    """Rounds, and doublings of all rounds together, on paths and stars of a thousand nodes."""
    kept = []
    store = components_module.stored
    monkeypatch.setattr(components_module, "stored", lambda df, label: kept.append(label) or store(df, label))
    pairs = shapes()[name]
    names = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert names == _named(pairs)
    limit = 2 * np.log2(1000) + 2
    assert kept.count("links") - 1 <= limit and kept.count("pointers") <= 2 * limit


def _named(pairs):
    """Every node's least node, by union and find."""
    parent = {}

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in list(parent)}


def test_a_component_leaves_no_tables_behind(spark):
    from pathlib import Path

    from tillsight.workspace import shared_folder

    folder = Path(shared_folder(spark))
    before = {path.name for path in folder.iterdir()}
    components(spark.createDataFrame([(1, 2), (2, 3), (5, 4)], "a bigint, b bigint")).collect()
    left = {path.name.rsplit("-", 1)[0] for path in folder.iterdir() if path.name not in before}
    assert left == {"components", "links"}
