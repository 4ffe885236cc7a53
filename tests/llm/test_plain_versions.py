"""Toxicity, quality, packing and the pipeline against plain versions, whole results."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward_rows import AWKWARD
from pyspark.sql import functions as F
from test_models import edits, plain_counts
from test_ngram_join import plain as plain_components

from tillsight.llm import packing, pii, quality, toxicity
from tillsight.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(WORD, text or "")


# ---- quality ----


def plain_quality(rows, labels, fold_of, buckets):
    """(doc_id, score, kept) by counts of whole n-grams and every possible cut."""
    grams = [Counter(w) + Counter(zip(w, w[1:])) for w in (words_of(text) for _, text in rows)]
    raw = sum(grams, Counter())
    trusted = {}
    for (doc, _), found in zip(rows, grams):
        if labels.get(doc) == 1:
            trusted[fold_of[doc]] = trusted.get(fold_of[doc], Counter()) + found

    def score(found, left_out=None):
        counts = sum((c for fold, c in trusted.items() if fold != left_out), Counter())
        size, all_raw = sum(counts.values()) + buckets, sum(raw.values()) + buckets
        ratio = {g: math.log((counts[g] + 1) / size) - math.log((raw[g] + 1) / all_raw) for g in found}
        return sum(ratio[g] * n for g, n in found.items()) / max(1, sum(found.values()))

    def fails(text):
        counts = plain_counts(text)
        return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]

    judged = [
        (score(found, fold_of[doc]), labels[doc])
        for (doc, text), found in zip(rows, grams) if doc in labels and not fails(text)
    ]
    good, bad = ([s for s, label in judged if label == wanted] for wanted in (1, 0))
    threshold = -math.inf
    if good and bad:
        cuts = sorted({s for s, _ in judged})
        gains = [sum(s >= cut for s in good) / len(good) + sum(s < cut for s in bad) / len(bad) for cut in cuts]
        best = max(range(len(cuts)), key=lambda i: (round(gains[i], 12), -i))
        threshold = cuts[best] if best == 0 else (cuts[best] + cuts[best - 1]) / 2
    return {
        doc: (score(found), not fails(text) and score(found) >= threshold) for (doc, text), found in zip(rows, grams)
    }


def test_quality_equals_a_plain_version(spark, documents, monkeypatch):
    random.seed(5)
    good, bad = "abcdefgh", "efghijkl"
    rows, labels = [], {}
    for doc in range(120):
        junk = random.random() < 0.4
        size = random.choice([30, 55, 60, 90])
        letters = "".join(random.choices(bad if junk else good, k=4)) if random.random() < 0.2 else bad if junk else good
        rows.append((doc, " ".join(letter + random.choice("xyz") for letter in random.choices(letters, k=size))))
        if random.random() < 0.7:
            labels[doc] = int(not junk) if random.random() < 0.9 else int(junk)
    rows += [(200, None), (201, ""), (202, "one two")]
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(quality.FOLDS))
    fold_of = {r.doc_id: r.fold for r in table.select("doc_id", fold.alias("fold")).collect()}
    monkeypatch.setattr(quality, "FAN_IN", 2)
    buckets = 1 << 20
    scored, threshold = quality.scored_documents(documents(rows, 7), table, buckets)
    expected = plain_quality(rows, labels, fold_of, buckets)
    found = scored.withColumn("failed", quality.base_failed()).collect()
    assert len(found) == len(rows)
    for row in found:
        score, kept = expected[row.doc_id]
        assert abs(row.score - score) < 1e-9, row.doc_id
        assert (not row.failed and row.score >= threshold) == kept, row.doc_id
    assert 10 < sum(kept for _, kept in expected.values()) < 100


# ---- toxicity ----


def plain_lexicon(sample):
    plain = lambda word: re.sub(r"^[\W_]+|[\W_]+$", "", word.lower())
    counts, sizes = {0: Counter(), 1: Counter()}, Counter(toxic for _, toxic in sample)
    for text, toxic in sample:
        words = {plain(word) for word in (text or "").split()}
        terms = {word for word in words if len(word) >= 3}
        terms |= {word[:n] + "*" for word in words for n in range(3, 9) if len(word) > n}
        counts[toxic].update(terms)
    strong = {}
    for term, found in counts[1].items():
        t, c = found + 0.5, counts[0][term] + 0.5
        t_not, c_not = sizes[1] + 1 - t, sizes[0] + 1 - c
        z = (math.log(t / t_not) - math.log(c / c_not)) / math.sqrt(1 / t + 1 / t_not + 1 / c + 1 / c_not)
        share = t / sizes[1] / (t / sizes[1] + c / sizes[0])
        if found >= 3 and z >= toxicity.LEAST_Z and share >= toxicity.LEAST_PRECISION:
            strong[term] = found
    kept = set()
    for term in strong:
        if term.endswith("*"):
            stem = term[:-1]
            shorter = any(stem[:n] + "*" in strong for n in range(3, len(stem)))
            whole = any(
                not t.endswith("*") and t.startswith(stem) and 10 * n >= 9 * strong[term] for t, n in strong.items()
            )
            if shorter or whole:
                continue
        kept.add(term)
    return kept


def plain_features(text, lexicon):
    plain = lambda word: re.sub(r"^[\W_]+|[\W_]+$", "", word.lower())
    whole = {t for t in lexicon if not t.endswith("*")}
    stems = tuple(t[:-1] for t in lexicon if t.endswith("*"))
    words, counts = (text or "").split(), Counter()
    for at, word in enumerate(words):
        term = plain(word)
        if term in whole:
            kind = "words"
        elif stems and term.startswith(stems):
            kind = "stems"
        elif any(edits(term, t) <= toxicity.allowed_edits(t) for t in whole):
            kind = "misspelled"
        else:
            continue
        before, after = words[max(0, at - toxicity.WINDOW) : at], words[at + 1 : at + 1 + toxicity.WINDOW]
        signs = lambda parts: any(set(part) & toxicity.QUOTES for part in parts)
        quoted = (signs(before) or signs([word[:1]])) and (signs(after) or signs([word[1:]]))
        quoted = quoted or any(plain(other) in toxicity.REPORTING for other in before)
        counts["quoted" if quoted else kind] += 1
    return [counts[name] for name in ("words", "stems", "misspelled", "quoted")], len(words)


def test_toxicity_equals_a_plain_version(spark, documents):
    random.seed(6)
    nasty = ["scumbag", "pathetic", "moron", "loathing", "loather", "loathed", "vile"]
    calm = ["table", "river", "window", "garden", "petal", "motor", "while", "said", '"so', 'well"', "loam"]
    rows, labels = [], []
    for doc in range(240):
        toxic = int(doc % 3 == 0)
        words = random.choices(calm, k=random.randint(4, 25))
        for _ in range(random.randint(1, 4) if toxic else random.random() < 0.05):
            term = random.choice(nasty)
            if random.random() < 0.3:
                at = random.randrange(len(term))
                term = term[:at] + random.choice(["", "x"]) + term[at + 1 :]
            words.insert(random.randrange(len(words)), random.choice(["", "", "'"]) + term + random.choice(["", ",", "!"]))
        rows.append((doc, " ".join(words)))
        labels.append((doc, toxic))
    rows += [(900, None), (901, "")]
    held_out = {doc for doc, _ in rows if zlib.crc32(str(doc).encode()) % 5 == 0}
    label = dict(labels)
    sample = [(text, label[doc]) for doc, text in rows if doc in label and doc not in held_out]
    lexicon = plain_lexicon(sample)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    stored = spark.createDataFrame(sample, "text string, toxic int")
    assert set(toxicity.learn_lexicon(stored)) == lexicon and len(lexicon) > 4

    def numbers(text):
        counts, size = plain_features(text, lexicon)
        hits = sum(counts[:3])
        return [*map(math.log1p, counts), math.log1p(100 * hits / max(1, size)), float(hits > 0)]

    weights = toxicity.fit_weights(np.array([numbers(text) for text, _ in sample]), np.array([t for _, t in sample], float))
    texts = dict(rows)
    found = toxicity.toxicity_scores(documents(rows), table).collect()
    assert len(found) == len(rows)
    for row in found:
        score = 1 / (1 + math.exp(-float(np.dot([*numbers(texts[row.doc_id]), 1.0], weights))))
        counts = plain_features(texts[row.doc_id], lexicon)[0]
        assert [row.n_words, row.n_stems, row.n_misspelled, row.n_quoted] == counts, texts[row.doc_id]
        assert abs(row.score - score) < 1e-6 and row.predicted == int(score >= 0.5)
        assert row.held_out == (row.doc_id in held_out)


# ---- packing ----


def plain_limits(lengths, buckets):
    """Least padding by dynamic programming over every different length, and its limits."""
    counts = sorted(Counter(lengths).items())
    sizes = np.array([n for n, _ in counts], float)
    docs = np.concatenate([[0], np.cumsum([c for _, c in counts])]).astype(float)
    tokens = np.concatenate([[0], np.cumsum([n * c for n, c in counts])]).astype(float)
    least = {0: (0.0, ())}
    best = (math.inf, ())
    for _ in range(min(buckets, len(counts))):
        following = {}
        for end in range(1, len(counts) + 1):
            ways = [
                (cost + sizes[end - 1] * (docs[end] - docs[at]) - (tokens[end] - tokens[at]), at)
                for at, (cost, _) in least.items() if at < end
            ]
            if ways:
                cost, at = min(ways)
                following[end] = cost, (*least[at][1], counts[end - 1][0])
        least = following
        best = min(best, least.get(len(counts), best))
    return best


def padding(lengths, limits):
    return sum(min(limit for limit in limits if limit >= n) - n for n in lengths)


@pytest.mark.parametrize("buckets", [1, 3, 7])
def test_limits_are_the_best_of_long_texts_too(spark, buckets):
    random.seed(buckets)
    lengths = [int(random.paretovariate(0.6) * 300) % 120_000 for _ in range(260)] + [5_000, 5_001, 5_001, 90_000] * 9
    table = spark.createDataFrame([(n,) for n in lengths], "n_tokens bigint")
    limits, totals = packing.optimal_limits(packing.length_counts(table), buckets)
    assert len(limits) <= buckets and padding(lengths, limits) == plain_limits(lengths, buckets)[0]
    assert totals == [sum(low < n <= high for n in lengths) for low, high in zip([-1, *limits], limits)]


def check_batches(rows, lengths, buckets=packing.BUCKETS, budget=packing.TOKEN_BUDGET):
    """Whole result of packing: each document once, limits of least padding, full batches."""
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == sorted(lengths, key=str)
    limits = sorted({r.bucket_tokens for r in rows})
    sizes = [n for _, n in lengths]
    assert padding(sizes, limits) == plain_limits(sizes, buckets)[0]
    batches = {}
    for row in rows:
        assert row.bucket_tokens == min(limit for limit in limits if limit >= row.n_tokens)
        assert limits[row.bucket] == row.bucket_tokens
        batches.setdefault((row.bucket, row.shard, row.batch), []).append(row)
    for (bucket, shard, batch), members in batches.items():
        full = max(1, budget // max(1, limits[bucket]))
        assert sorted(m.place for m in members) == list(range(len(members))) and len(members) <= full
        assert len(members) == full or (bucket, shard, batch + 1) not in batches


def test_packing_query_equals_a_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    lengths = [(d.doc_id, len(words_of(d.text))) for d in docs]
    check_batches(QUERIES["op8_packing"](spark, small).collect(), lengths)


def test_rows_without_an_id_are_spread(spark):
    table = spark.createDataFrame([(None, 7)] * 400, "doc_id bigint, n_tokens bigint")
    rows = packing.pack(table, rows_per_shard=50).collect()
    assert len(rows) == 400 and len({r.shard for r in rows}) == 8


# ---- pipeline ----


def plain_line_texts(rows):
    blanks = " \t\n\x0b\x0c\r"
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    key = lambda line: line.strip(blanks).translate(lower)
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None:
                first[key(line)] = min(first.get(key(line), doc), doc)
    return [
        (doc, None if text is None else "\n".join(
            line for line in text.split("\n") if doc is None or len(key(line)) < 10 or first[key(line)] == doc
        ))
        for doc, text in rows
    ]


def pipeline_rows():
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefghij", k=4))
    shared = "this line is in many documents"
    rows = [row for row in AWKWARD if row[0] is not None]
    for doc in range(20, 70):
        words = [word() for _ in range(random.randint(40, 160))]
        if doc % 5 == 0:
            words = rows[-1][1].split("\n")[0].split()
            words[random.randrange(len(words))] = word()
        if doc % 7 == 0:
            words.insert(5, "write to joe.doe@mail.example.com or call (415) 555-2671 please")
        rows.append((doc, " ".join(words) + (f"\n{shared}\n" + word() if doc % 3 == 0 else "")))
    return rows


def plain_pipeline(rows, verdicts):
    kept = [(doc, text) for doc, text in rows if verdicts[doc]]
    kept = plain_line_texts(kept)
    first = {doc for doc, _, component in plain_components(kept) if doc == component}
    kept = [row for row in dict.fromkeys(kept) if row[0] in first]
    finder = pii.Finder(pii.fitted_field())
    spans = finder.spans(pa.array([text for _, text in kept], pa.string()))
    masked = []
    for (doc, text), (_, every) in zip(kept, spans):
        for start, kind, end in sorted(every, reverse=True):
            text = f"{text[:start]}<{pii.KINDS[kind].upper()}>{text[end:]}"
        masked.append((doc, text))
    return masked


def test_pipeline_equals_a_plain_version(spark, documents, tmp_path):
    import corpus_pipeline

    rows = pipeline_rows()
    labels = [(doc, int(doc % 4 != 0), 0) for doc in range(20, 70, 2)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    table.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = quality.quality_verdicts(docs, table).collect()
    assert {r.doc_id: r.n_words for r in found} == {doc: len(words_of(text)) for doc, text in rows}
    expected = plain_pipeline(rows, {r.doc_id: r.kept for r in found})
    assert 10 < len(expected) < len(rows)
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_batches(last, [(doc, len(words_of(text))) for doc, text in expected])
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(expected)


def test_pipeline_stages_on_awkward_and_empty_tables(spark, documents, tmp_path):
    """Every stage takes null ids, empty, long and repeated rows, clashing columns, and no rows."""
    import corpus_pipeline

    table = spark.createDataFrame([(6, 1, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    table.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (AWKWARD, []):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, str(tmp_path))
            count = result.count()
            assert count == len(rows) if name in ("line_dedup", "personal_data", "packing") else count <= len(rows)
            if name != "packing":
                assert result.columns == docs.columns, name
