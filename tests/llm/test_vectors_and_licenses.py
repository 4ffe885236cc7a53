"""Centroid clustering, whitening and the licence scan against plain versions and SQL."""

import hashlib
import re

import numpy as np
import pytest
from awkward_rows import AWKWARD

from tillsight.llm import centroids, license_scan, whitening
from tillsight.llm.queries import ORACLE, QUERIES

NAN, INF = float("nan"), float("inf")
KIND = "vec_id bigint, embedding array<double>, x int, cluster string, norm string, component string, place int, given string"


def vectors(spark, rows, partitions=3):
    """A table of (vec_id, embedding) with columns of clashing names."""
    return spark.createDataFrame([(*row, 1, "a", "b", "c", 2, "d") for row in rows], KIND).repartition(partitions)


def clustered(seed, count, width=64):
    random = np.random.default_rng(seed)
    middles = random.normal(0, 0.3, (6, width))
    return [(int(i), (middles[random.integers(6)] + random.normal(0, 0.1, width)).tolist()) for i in range(count)]


AWKWARD_VECTORS = [
    (900, None), (901, []), (902, [1.0] * 63), (903, [None] + [0.5] * 63), (904, [NAN] + [0.5] * 63),
    (905, [INF] * 64), (906, [0.0] * 64), (907, [0.0] * 64), (907, [0.0] * 64), (None, [0.25] * 64),
    (908, [-1e-9] * 64), (-5, [100.0] * 64),
]


def plain_clusters(rows):
    kept = [
        (i, [int(np.floor(1024 * c)) for c in v]) for i, v in rows
        if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()
    ]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None]
    middles = [x for _, x in sorted(named)[:8]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    assign = lambda: [min(range(len(middles)), key=lambda k: (apart(x, middles[k]), k)) for _, x in kept]
    for _ in range(10):
        of = assign()
        for k in range(len(middles)):
            members = [x for (_, x), c in zip(kept, of) if c == k]
            if members:
                middles[k] = [sum(column) // len(members) for column in zip(*members)]
    of = assign()
    far = [apart(x, middles[c]) for (_, x), c in zip(kept, of)]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return sorted(
        [(i, c, t, sum(t2 for t2, c2 in zip(far, of) if c2 == c), sum(far), shas[c]) for (i, _), c, t in zip(kept, of, far)],
        key=str,
    )


@pytest.mark.parametrize("rows", [
    clustered(1, 150) + AWKWARD_VECTORS, clustered(2, 5), [(7, [0.5] * 64)] * 30,
    [(i, [0.001 * (i % 3)] * 64) for i in range(60)],
], ids=["awkward", "few", "equal", "ties"])
def test_clusters_are_those_of_the_plain_way(spark, rows):
    found = centroids.cluster_digest(vectors(spark, rows))
    assert sorted(map(tuple, found.collect()), key=str) == plain_clusters(rows)


def test_no_vectors_no_clusters(spark):
    empty = vectors(spark, AWKWARD_VECTORS[:6])
    assert centroids.cluster_digest(empty).collect() == []
    assert centroids.cluster_digest(empty.limit(0)).collect() == []


def test_only_changed_components_are_multiplied(spark):
    import pyarrow as pa

    random = np.random.default_rng(3)
    x, old = random.integers(-900, 900, (40, 64)), random.integers(-900, 900, (4, 64))
    new = old.copy()
    new[1, 5] += 7
    new[3] -= 2
    batch = pa.RecordBatch.from_pydict({
        "vec_id": range(40), "x": x.tolist(), "norm": (x * x).sum(axis=1), "dots": (x @ old.T).tolist(), "cluster": [0] * 40,
    })
    (after,) = centroids._carried_on(new - old, new)([batch])
    assert after["dots"].to_pylist() == (x @ new.T).tolist()
    apart = ((x[:, None, :] - new[None]) ** 2).sum(axis=2)
    assert after["cluster"].to_pylist() == apart.argmin(axis=1).tolist()
    assert after["distance"].to_pylist() == apart.min(axis=1).tolist()


def test_a_component_too_large_is_refused(spark):
    with pytest.raises(Exception, match="too large for exact distances"):
        centroids.cluster_digest(vectors(spark, [(1, [1e30] * 64)]))


def test_two_state_tables_at_most(spark):
    from pathlib import Path

    from tillsight.workspace import shared_folder

    folder = Path(shared_folder(spark))
    before = {path.name for path in folder.iterdir()}
    centroids.cluster(vectors(spark, clustered(4, 80)))
    left = [path.name for path in folder.iterdir() if path.name not in before]
    assert len([name for name in left if name.startswith(("distances", "whole-vectors"))]) == 1


def plain_whitening(rows, components=16):
    """By the eigenvectors of the covariance itself."""
    kept = [(i, v) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    width = max((len(v) for _, v in kept), default=0)
    x = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    middle = np.array([s / n for s in sums])
    centred = np.array(fit, dtype=float) - middle
    values, unit = np.linalg.eigh(centred.T @ centred / n)
    values, unit = values[::-1], unit[:, ::-1]
    found = {}
    for i, v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for j in range(min(components, width)):
            if values[j] > 1e-9 * max(values[0], 1):
                white = (np.array(v) - middle) @ unit[:, j] / np.sqrt(values[j])
                found.setdefault((i, j + 1), []).append((n, deviation, white, values[j] / values.sum()))
    return found


@pytest.mark.parametrize("rows", [
    clustered(5, 300) + [row for row in AWKWARD_VECTORS if row[1] != []],
    [(i, np.random.default_rng(i).normal(0, 1, 5).tolist()) for i in range(40)] + [(99, [3.0])] * 4,
    [(i, [float(i % 7), float(i % 7) * 2, 0.5]) for i in range(30)],
], ids=["awkward", "ragged", "one direction"])
def test_whitened_as_the_plain_way(spark, rows):
    found = whitening.whiten(vectors(spark, rows)).collect()
    plain = plain_whitening(rows)
    assert len(found) == sum(map(len, plain.values()))
    signs = {}
    for row in found:
        n, deviation, white, explained = plain[row.vec_id, row.component][0]
        assert (row.n, row.deviation) == (n, deviation)
        assert row.explained == pytest.approx(explained, rel=1e-9)
        assert row.identity_error < 1e-9
        assert abs(row.whitened) == pytest.approx(abs(white), abs=1e-6)
        if abs(white) > 1e-3:
            signs.setdefault(row.component, set()).add(np.sign(white) == np.sign(row.whitened))
    assert all(len(sides) == 1 for sides in signs.values())


def test_nothing_to_whiten(spark):
    equal = vectors(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])
    assert whitening.whiten(equal).collect() == []
    assert whitening.whiten(equal.limit(0)).collect() == []
    assert whitening.whiten(vectors(spark, [(1, []), (2, None)])).collect() == []


def test_factor_and_rotation():
    random = np.random.default_rng(6)
    for rank, size in ((1, 4), (5, 5), (3, 9), (0, 3)):
        root = random.normal(0, 1, (size, rank)) * 10.0 ** -np.arange(rank)
        a = root @ root.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (size, rank)
        assert np.allclose(factor @ factor.T, a, atol=1e-13)
        values, unit = whitening.one_sided_jacobi(factor)
        assert np.allclose(values, np.linalg.svd(root, compute_uv=False) ** 2, rtol=1e-9)
        assert np.allclose(unit.T @ unit, np.eye(rank), atol=1e-12)
        assert np.allclose(unit * values @ unit.T, a, atol=1e-13)


def test_deviation_beyond_64_bits():
    fitted = whitening.Whitening(3_000_000_000, [0], np.ones(1), np.ones((1, 1)), 1.0)
    x = np.array([[1], [5]])
    assert fitted.deviations(x) == [9 * 10**18, None]


def plain_places(text, phrase):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words, wanted = re.findall(license_scan.WORD, lowered), phrase.split()
    return len(words), [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]


MIT = next(t.text for t in license_scan.TEMPLATES if t.text.startswith("Permission is hereby"))
LICENSED = [
    (20, "CC BY cc-by, CC\nBY!"), (21, "ALL rights\treserved all rights all rights reserved"), (22, "cc by " * 5_000),
    (23, "General Public Licence"), (24, "general public license " * 3 + "cc by"), (25, "x " * 700 + MIT + " y" * 9),
    (26, MIT.replace("without restriction", "with no restriction at all").replace("merge, ", "")), (27, MIT[: len(MIT) // 2]),
    (28, "Kc by, ĸ, İcc by"), (29, "GNU General Public License, version 2"), (29, "GNU General Public License, version 2"),
    (None, "all rights reserved"), (None, None), (30, "released under the mit licence"), (31, "cc"), (32, "by"),
]


def test_licenses_in_awkward_documents(spark, documents):
    rows = AWKWARD + LICENSED
    found = license_scan.license_digest(documents(rows)).collect()
    expected = []
    for doc, text in rows:
        places = {t.label: plain_places(text, t.text)[1] for t in license_scan.PHRASES}
        every = sorted(place for found in places.values() for place in found)
        expected.append((
            doc, plain_places(text, "")[0], len(every), every[0] if every else None, every[-1] if every else None,
            ",".join(sorted(label for label, found in places.items() if found)),
        ))
    assert sorted((tuple(row)[:6] for row in found), key=str) == sorted(expected, key=str)
    labels = {row.doc_id: row.labels for row in found}
    scores = {row.doc_id: row.score for row in found}
    assert labels[25] == "mit" and scores[25] == 1
    assert labels[26] == "mit" and 0.9 <= scores[26] < 1
    assert labels[27] == "" and 0.3 < scores[27] < 0.6
    assert labels[29] == "gpl,gpl-2.0" and labels[30] == "" and scores[31] == 0
    assert license_scan.license_digest(documents([])).collect() == []


def test_spans_of_a_changed_license(spark, documents):
    spans = license_scan.license_spans(documents(LICENSED)).filter("verified and label = 'mit'").collect()
    placed = {row.doc_id: (row.first, row["last"]) for row in spans}
    count = len(re.findall(license_scan.WORD, MIT.lower()))
    assert placed[25] == (700, 700 + count)
    assert placed[26][0] == 0 and abs(placed[26][1] - count) <= 3


def test_scan_runs_without_python(spark, documents):
    plan = license_scan.license_digest(documents([(1, "cc by")])).drop("lang")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op13_license_scan"])
def test_equals_sql(spark, medium, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    rows = QUERIES[name](spark, medium).select(*columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(cursor.fetchall(), key=str)


def test_whitening_of_the_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in table.collect()]
    plain = plain_whitening(rows)
    found = QUERIES["op12_embedding_whitening"](spark, small).collect()
    assert len(found) == len(plain) == 16 * len(rows)
    for row in found:
        n, deviation, white, explained = plain[row.vec_id, row.component][0]
        assert (row.n, row.deviation) == (n, deviation) and row.identity_error < 1e-9
        assert row.explained == pytest.approx(explained, rel=1e-9)
        assert abs(row.whitened) == pytest.approx(abs(white), abs=1e-8)
