"""BPE, packing, WARC, vector search and the pipeline."""

import base64
import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from awkward_rows import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st

from tillsight.llm import byte_bpe, packing, vector_search, warc
from tillsight.llm.queries import QUERIES
from tillsight.workspace import fresh_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LINES = open(RANKS, "rb").read()
ENCODER, DECODER, DECIMALS = byte_bpe.compiled(LINES, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.parse_ranks(LINES), special_tokens={}
)
PIECES = ["'s", "'ll", "'", "’s", " the", "ing", "\n\n", "  ", "\t", "\x1c", "\x85", "é", "日本", "🙂", "12", "³", "__", "…", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(PIECES)).map("".join)))
def test_ids_are_those_of_the_merges(text):
    ids = ENCODER.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert DECODER.decode(ids) == text
    assert DECIMALS.join(np.array(ids, np.uint32)) == " ".join(map(str, ids)).encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_any_bytes_decode_like_utf8(data):
    assert DECODER.decode(ENCODER.transducer.encode(data)) == data.decode("utf-8", "replace")


def test_few_states_for_much_text():
    """A state is the open walks alone: no more of them than nodes in the trie of tokens."""
    random.seed(12)
    words = ["".join(random.choices("etaoinshrdlucmfwyp", k=random.randint(2, 12))) for _ in range(120_000)]
    text = " ".join(words)[: 1 << 20]
    encoder = byte_bpe.Encoder(byte_bpe.parse_ranks(LINES), public_tokenizers.PATTERN)
    assert encoder.encode(text) == REFERENCE.encode_ordinary(text)
    assert encoder.transducer.states < 10_000


def test_tokens_come_once_they_are_settled():
    text = "".join(random.Random(13).choices("abcdefgh", k=3_000))
    parts = list(ENCODER.transducer.stream(text.encode(), settle_bytes=40))
    assert [token for ids in parts for token in ids] == REFERENCE.encode_ordinary(text)
    assert max(map(len, parts)) <= 100 and sum(1 for ids in parts if ids) > 50


def test_pieces_that_no_merge_makes():
    """``abc`` is a token, but neither ``ab`` nor ``bc``: it counts where it is the whole piece."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"xy": 257, b"xyx": 258}
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    expected = tiktoken.Encoding("o", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", " abc", "xyxyx", "xyx abc xy", "x" * 700 + "yx"):
        assert encoder.encode(text) == expected.encode_ordinary(text)


def test_more_pairs_than_are_remembered():
    pairs = byte_bpe._Pairs(8, lambda pair: pair % 3 == 0)
    for low in (0, 5, 400, 0):
        asked = np.arange(low, low + 200, dtype=np.int64)
        assert pairs(asked).tolist() == [pair % 3 == 0 for pair in asked.tolist()]
        assert pairs(asked[:5]).tolist() == [pair % 3 == 0 for pair in asked[:5].tolist()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2_000), max_size=12), max_size=5))
def test_texts_decode_together_as_one_by_one(texts):
    bounds = np.cumsum([0, *map(len, texts)])
    ids = np.array([token for text in texts for token in text], dtype=np.int64)
    assert DECODER.decode_batch(ids, bounds) == [DECODER.decode(text).encode() for text in texts]


def test_streams_across_tokens():
    ids = [token for byte in "日🙂é".encode() for token in ENCODER.transducer.encode(bytes([byte]))]
    assert [text for text in DECODER.stream(ids) if text] == ["日", "🙂", "é"]


def test_splitting_in_arrays_equals_the_pattern():
    random.seed(4)
    findall = byte_bpe.splitter(public_tokenizers.PATTERN).findall
    for _ in range(2000):
        texts = ["".join(random.choices(PIECES + ["a", "m", " ", "d"], k=random.randint(0, 15))) for _ in range(3)]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        bounds = np.cumsum([0, *map(len, texts)])
        starts = byte_bpe.split_points(points, bounds).tolist()
        whole = "".join(texts)
        pieces = [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)])]
        assert pieces == [piece for text in texts for piece in findall(text)]


def test_another_pattern_and_little_memory():
    ranks = byte_bpe.parse_ranks(LINES)
    encoder = byte_bpe.Encoder(ranks, r"\w+|\W", memory=3)
    for text in ("some words, and more words", "", "éé 12"):
        expected = tiktoken.Encoding("o", pat_str=r"\w+|\W", mergeable_ranks=ranks, special_tokens={})
        assert encoder.encode(text) == expected.encode_ordinary(text)


def test_a_long_piece(spark):
    text = "".join(random.Random(5).choices("abcde", k=20_000))
    assert ENCODER.encode(text) == REFERENCE.encode_ordinary(text)


def test_documents_encode_and_decode(documents):
    table = documents(AWKWARD)
    coded = byte_bpe.encode_documents(table, RANKS, public_tokenizers.PATTERN)
    again = byte_bpe.decode_documents(coded, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.text) for r in again.collect() if r.doc_id is not None) == sorted(
        (doc, text or "") for doc, text in AWKWARD if doc is not None
    )
    digests = byte_bpe.bpe_digest(table, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for doc, text in AWKWARD:
        ids = REFERENCE.encode_ordinary(text or "")
        sha = lambda data: hashlib.sha256(data.encode()).hexdigest()
        expected.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert sorted(map(tuple, digests), key=str) == sorted(expected, key=str)
    assert byte_bpe.bpe_digest(documents([]), RANKS, public_tokenizers.PATTERN).collect() == []


def padding(histogram, limits):
    return sum(
        min(limit for limit in limits if limit >= longest) * documents - tokens
        for longest, documents, tokens in histogram.tolist()
    )


def test_limits_need_the_least_padding():
    random = np.random.default_rng(6)
    for _ in range(30):
        lengths = np.unique(random.integers(0, 60, random.integers(1, 9)))
        counts = random.integers(1, 20, len(lengths))
        histogram = np.stack([lengths, counts, lengths * counts], axis=1)
        for buckets in (1, 2, 3, 20):
            limits = packing.best_limits(histogram, buckets)
            assert len(limits) <= buckets and limits == sorted(set(limits))
            best = min(
                padding(histogram, [*chosen, lengths[-1]])
                for n in range(min(buckets, len(lengths)))
                for chosen in combinations(lengths[:-1].tolist(), n)
            )
            assert padding(histogram, limits) == best
    assert packing.best_limits(np.empty((0, 3), np.int64)) == []


def test_batches_keep_to_the_budget(spark):
    random = np.random.default_rng(7)
    lengths = [(i, int(n)) for i, n in enumerate(random.integers(0, 9000, 3000))] + [(3000, 100_000), (None, None), (5, 17)]
    table = spark.createDataFrame(lengths, "doc_id bigint, n_tokens bigint")
    rows = packing.pack(table, buckets=6, budget=10_000, rows_per_shard=200).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows if r.doc_id is not None) == sorted(
        (d, n) for d, n in lengths if d is not None
    )
    batches = {}
    for row in rows:
        assert row.n_tokens <= row.bucket_tokens
        batches.setdefault((row.bucket, row.shard, row.batch), []).append(row)
    short = {}
    for (bucket, shard, _), members in batches.items():
        assert len(members) == 1 or len(members) * members[0].bucket_tokens <= 10_000
        assert sorted(m.place for m in members) == list(range(len(members)))
        full = max(1, 10_000 // max(1, members[0].bucket_tokens))
        short[bucket, shard] = short.get((bucket, shard), 0) + (len(members) < full)
    assert max(short.values()) <= 1
    empty = packing.pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"))
    assert empty.collect() == []


def test_packing_of_documents(awkward):
    rows = packing.pack_documents(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id: r.n_tokens for r in rows}[10] == 30_000


PAGES = [
    (1, "http://a.com/x", "p" * 1000), (2, "http://a.com/x", "p" * 1000), (9, "http://B.com:80/ y?q=1#f", "p" * 1000),
    (3, "https://sub.a.com/", "q" * 999), (4, "https://sub.a.com/", "q" * 999), (5, None, None), (6, "", ""),
    (7, "not a url", "é" * 600), (8, "http://[bad/", "é" * 600), (None, "http://a.com/x", "p" * 1000),
    (10, "http://a.com/x\r\nEvil: 1", "two\r\n\r\nparts"), (9, "http://B.com:80/ y?q=1#f", "p" * 1000),
]


def plain_pages(pages):
    largest = {}
    for page, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            largest[data] = max(largest.get(data, page), page)
    result = []
    for page, _, html in pages:
        data = (html or "").encode()
        first = largest.get(data)
        again = page is not None and first is not None and first > page
        result.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(result, key=str)


def test_pages_come_back(spark):
    pages = spark.createDataFrame(
        [(*page, 1, "x") for page in PAGES], "page_id bigint, url string, html string, digest int, salt string"
    ).repartition(3)
    assert sorted(map(tuple, warc.archived_and_read_back(pages).collect()), key=str) == plain_pages(PAGES)
    assert warc.archived_and_read_back(pages.limit(0)).collect() == []


def test_look_up_reads_single_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "CAPTURES_PER_INDEX_FILE", 40)
    rows = [(i, f"http://h{i % 5}.net/{i // 3}", f"page {i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = fresh_folder(spark, "warc-test")
    captures = warc.write_archives(pages, f"{folder}/archives", archive_bytes=2_000)
    assert captures.select("archive").distinct().count() > 3
    directory = warc.build_index(captures, f"{folder}/index")
    assert directory.count() >= 200 // 7 and directory.select("index_file").distinct().count() > 1
    wanted = pages.filter("page_id % 11 = 0").union(spark.createDataFrame([(999, "http://zz.net/", "")], pages.schema))
    located = warc.look_up(warc.wanted_keys(wanted), directory)
    found = warc.read_records(located).collect()
    assert sorted(r.page_id for r in found) == list(range(0, 200, 11))
    assert all(r.payload_digest == hashlib.sha1(f"page {r.page_id}".encode()).hexdigest() for r in found)


def test_archives_are_warc(spark):
    import gzip

    pages = spark.createDataFrame([(1, "http://a.com/x", "hello")], "page_id bigint, url string, html string")
    captures = warc.write_archives(pages, fresh_folder(spark, "warc-file")).collect()
    path = captures[0].archive.removeprefix("file://")
    record = gzip.open(path, "rb").read().decode()
    head, block = record.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\nWARC-Type: response") and block.endswith("hello\r\n\r\n")
    sha = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    assert f"WARC-Payload-Digest: sha1:{sha}" in head


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com/a?b=1#c", "com,example,www)/a?b=1"), ("https://x.org:8080", "org,x:8080)/"),
    (None, ""), ("plain", "plain"), ("http://[bad/", "http://[bad/"),
])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def plain_nearest(rows, queries, k=5):
    usable = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    width = max(len(v) for _, v in usable)
    unit = {i: np.pad(v, (0, width - len(v))) / np.linalg.norm(v) for i, v in usable}
    result = {}
    for q in queries:
        if q in unit:
            near = sorted((-round(float(unit[q] @ unit[i]), 9), i) for i in unit if i != q)
            result[q] = [(i, -s) for s, i in near[:k]]
    return result


def by_query(df):
    result = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        result.setdefault(row.query_id, []).append((row.vec_id, round(row.score, 9)))
    return result


def test_nearest_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [2.0, 0.0]), (10, [1.0, 1.0, 1.0]), (11, [-1.0, 0.0]), (12, []),
        (None, [1.0, 0.0]), *[(i, [1.0, 0.0]) for i in range(20, 40)],
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, key int").repartition(3)
    found = by_query(vector_search.nearest(table, table))
    assert found == plain_nearest(rows, [i for i, _ in rows if i is not None])
    assert vector_search.nearest(table.limit(0), table).collect() == []
    assert vector_search.nearest(table, table.limit(0)).collect() == []


def test_vectors_whose_squares_are_out_of_range(spark):
    plain = [(i, np.random.default_rng(i).normal(0, 1, 6).tolist()) for i in range(30)]
    sizes = (1e200, 1e-200, 1.0, 2.0**-900)
    rows = [(i, [c * sizes[i % 4] for c in v]) for i, v in plain]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = by_query(vector_search.nearest(table, table))
    assert found == plain_nearest(plain, range(30))


def test_recall(spark):
    random = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(random.standard_normal((6000, 48)))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = by_query(vector_search.nearest(table, table.filter("vec_id % 50 = 0"), leaf_rows=32))
    truth = plain_nearest(rows, range(0, 6000, 50))
    hits = [len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) / 5 for q in truth]
    assert np.mean(hits) >= 0.9
    assert all(len(answers) == 5 for answers in found.values())


@pytest.mark.parametrize("spread", [0.3, None])
def test_recall_beyond_the_sample(spark, monkeypatch, spread):
    # parts of a leaf's rows, and chunks of its queries
    monkeypatch.setattr(vector_search, "GROUP_ROWS", 400)
    monkeypatch.setattr(vector_search, "GROUP_QUERIES", 100)
    monkeypatch.setattr(vector_search, "LEAST_CANDIDATES", 400)
    random = np.random.default_rng(12)
    vectors = random.standard_normal((6000, 24))
    if spread:
        vectors = vectors[random.integers(0, 60, 6000)] + spread * vectors
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = table.filter("vec_id % 50 = 0")
    found = by_query(vector_search.nearest(table, queries, leaf_rows=32, sample_values=600 * 24))
    truth = plain_nearest(rows, range(0, 6000, 50))
    assert all(len(answers) == 5 for answers in found.values()) and found.keys() == truth.keys()
    assert np.mean([len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) / 5 for q in truth]) >= 0.9


def test_a_bound_opens_what_the_queue_opens():
    random = np.random.default_rng(3)
    rows = random.standard_normal((3000, 12))
    forest = vector_search.Forest.fit(rows, 1, 20)
    tree, unit = forest.trees[0], vector_search._unit(rows[:50])
    opened = forest.search(rows[:50], 400)
    bounds = np.array([bound for _, bound in opened])
    within = {i: set() for i in range(50)}
    for leaf, asked in tree.within(unit, np.zeros(50), bounds):
        for i in asked.tolist():
            assert leaf not in within[i]
            within[i].add(leaf)
    assert [within[i] for i in range(50)] == [{leaf for _, leaf, _ in leaves} for leaves, _ in opened]
    assert 0 < np.mean([len(x) for x in within.values()]) < len(tree.leaves) / 2


def test_all_leaves_can_be_opened():
    rows = np.random.default_rng(4).standard_normal((500, 200))
    forest = vector_search.Forest.fit(rows, 4, 20)
    assert len(rows) < forest.needed(rows, 5) <= 4 * len(rows)
    leaves, bound = forest.search(rows[:1], np.inf)[0]
    assert len(leaves) == forest.first_leaf[-1] and bound == np.inf


def test_no_cell_grows_with_the_table():
    random = np.random.default_rng(6)
    rows, queries = random.integers(0, 90_000, 40), random.integers(0, 90_000, 40)
    layout = vector_search.Layout(rows, queries)
    ids, leaves = np.arange(rows.sum()), np.repeat(np.arange(40), rows)
    row, cell = layout.of_rows(leaves, ids)
    assert np.bincount(cell).max() < 1.2 * vector_search.GROUP_ROWS and cell.max() < layout.cells
    keys, asked = np.arange(queries.sum()), np.repeat(np.arange(40), queries)
    query, asked_cell = layout.of_queries(asked, keys)
    assert np.bincount(asked_cell).max() < 1.2 * vector_search.GROUP_QUERIES
    # a query meets each row of its leaf once
    for leaf in (3, 17):
        of_leaf = cell[leaves[row] == leaf]
        for q in np.flatnonzero(asked == leaf)[:5]:
            met = np.isin(of_leaf, asked_cell[query == q]).sum()
            assert met == rows[leaf]


def test_crowded_leaves_are_cut(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "GROUP_ROWS", 50)
    random = np.random.default_rng(9)
    rows = [(i, (np.ones(8) + random.normal(0, 1e-9, 8)).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = by_query(vector_search.nearest(table, table.filter("vec_id < 3")))
    assert all(len(answers) == 5 for answers in found.values()) and len(found) == 3


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small).persist()
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= docs.count(), name
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert packed.count() == docs.count() < before
    whole = corpus_pipeline.run(spark, small)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in packed.collect())


@pytest.mark.parametrize("name", ["op2_ngram_join", "op3_substring_dedup", "op9_warc", "op10_line_dedup"])
def test_equals_sql(spark, medium, name):
    import duckdb

    from tillsight.llm.queries import ORACLE

    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    rows = QUERIES[name](spark, medium).select(*columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(cursor.fetchall(), key=str)
