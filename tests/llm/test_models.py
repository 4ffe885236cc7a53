"""Quality rules, toxicity and personal data."""

import hashlib
import random
import re

import numpy as np
import pytest
from awkward_rows import AWKWARD

from tillsight.llm import pii, quality, toxicity
from tillsight.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else set(windows)
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    repeats = sum(line in lines[:i] for i, line in enumerate(lines))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)
    )


def test_base_counts_of_awkward_texts():
    texts = [text for _, text in AWKWARD] + ["a b c a b c", "x\ny\nx\n \n ", "é# é# é# é#", "# | <a> $"]
    for text in texts:
        assert quality.base_counts((text or "").encode()) == plain_counts(text)


def test_base_counts_of_random_texts():
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choices(["a ", "b ", "é ", "\n", "# ", " ", "\x1c"], k=random.randint(0, 40)))
        assert quality.base_counts(text.encode()) == plain_counts(text)


def test_threshold_parts_labels():
    scores, good = np.array([0.1, 0.2, 0.3, 0.9]), np.array([False, False, True, True])
    assert 0.2 < quality.best_threshold(scores, good) <= 0.3
    assert quality.best_threshold(scores, np.array([True] * 4)) == float("-inf")
    assert quality.best_threshold(np.array([]), np.array([], bool)) == float("-inf")
    assert quality.best_threshold(np.array([1.0, 1.0]), np.array([True, False])) <= 1.0


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(6, 1), (10, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    found = quality.quality_verdicts(awkward, labels).collect()
    assert len(found) == len(AWKWARD)
    for row in found:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed and (not failed or not row.kept)
    kept = quality.keep_quality(awkward, labels)
    assert kept.columns == awkward.columns


def test_quality_of_nothing(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.quality_verdicts(documents([]), labels).collect() == []


def test_quality_agrees_with_labels(spark, medium):
    found = QUERIES["op5_quality_rules"](spark, medium).filter("not base_failed")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    pairs = [(r.kept, r.quality) for r in found.join(labels, "doc_id").collect()]
    assert sum(kept == bool(label) for kept, label in pairs) >= 0.97 * len(pairs)


def test_clean_documents_without_a_label_are_kept(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    kept = []
    for half in (0, 1):
        some = labels.filter(f"pmod(xxhash64(doc_id, 5), 2) = {half}")
        hidden = labels.join(some, "doc_id", "left_anti").filter("quality = 1")
        found = quality.quality_verdicts(docs, some).filter("not base_failed").join(hidden, "doc_id")
        kept += [row.kept for row in found.collect()]
    assert sum(kept) >= 0.95 * len(kept) > 200


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_agrees_with_edit_distance():
    words = ["scum", "trash", "moron", "pathetic", "disgusting", "worthless"]
    automaton = toxicity.LexiconAutomaton([*words, "lowe*"])
    random.seed(2)
    for _ in range(4000):
        word = list(random.choice([*words, "lowering", "low"]))
        for _ in range(random.randint(0, 3)):
            at = random.randint(0, len(word))
            word[at : at + random.randint(0, 1)] = random.choice(["", "a", "s", "t"])
        word = "".join(word)
        exact, stem = word in words, word.startswith("lowe")
        near = any(edits(word, w) <= toxicity.allowed_edits(w) for w in words)
        expected = "word" if exact else "stem" if stem else "misspelled" if near else None
        assert automaton.match(word) == expected, word


def test_quotation_is_told_apart():
    reader = toxicity.Reader(["trash"])
    abuse = dict(zip(toxicity.FEATURES, reader.features("you are trash and more trassh")))
    quoted = dict(zip(toxicity.FEATURES, reader.features('the word "trash" was on a sign')))
    assert abuse["words"] > 0 and abuse["misspelled"] > 0 and abuse["quoted"] == 0
    assert quoted["words"] == 0 and quoted["quoted"] > 0 and quoted["any_plain"] == 0


def test_toxicity_of_held_out_documents(spark, medium):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    found = QUERIES["op4_toxicity"](spark, medium).filter("held_out").join(labels, "doc_id").collect()
    right = sum(row.predicted == row.toxic for row in found)
    assert len(found) > 50 and right >= 0.95 * len(found)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in found)


def test_toxicity_does_not_look_at_held_out_labels(spark, documents):
    import zlib

    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, f"word{i % 7} some text " + ("vile " if i % 2 else "")) for i in range(400)]
    real = [(i, i % 2) for i in range(400)]
    turned = [(i, 1 - t if i in set(out) else t) for i, t in real]
    results = [
        sorted(map(tuple, toxicity.toxicity_scores(
            documents(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
        ).collect()))
        for labels in (real, turned)
    ]
    assert results[0] == results[1]
    assert {row[0] for row in results[0] if row[1]} == set(out)
    assert all(row[3] == row[0] % 2 for row in results[0])


def test_toxicity_of_awkward_rows(spark, awkward, documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {row.score for row in toxicity.toxicity_scores(awkward, none).collect()} == {0.0}
    assert toxicity.toxicity_scores(documents([]), none).collect() == []


def plain_spans(text):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    spans = []
    for kind, pattern in enumerate(patterns):
        for found in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", found[0])
            good = [
                True, all(int(p) <= 255 for p in found[0].split(".")) if kind == 1 else False,
                12 <= len(digits) <= 19 and pii.passes_luhn(digits), 9 <= len(digits) <= 15,
            ][kind]
            if good:
                spans.append((found.start(), kind, found.end()))
    return sorted(spans)


def test_base_spans_equal_the_patterns():
    random.seed(3)
    for _ in range(20_000):
        text = "".join(random.choices("aB.@@-+_ 0123 4() é.5,", k=random.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "+1" * 100_000, "1." * 100_000, "@" * 100_000])
def test_long_runs_are_read_in_one_go(text):
    pii.base_spans(text)


def test_field_is_right_on_held_out_examples():
    rows = pii.labelled_table(copies=4, seed=99)
    paths = pii.fitted_field().decode([words for words, _ in rows])
    right = sum(path.tolist() == labels for path, (_, labels) in zip(paths, rows))
    assert right >= 0.95 * len(rows)


def test_viterbi_finds_the_best_path():
    from itertools import product

    field = pii.fitted_field()
    words = "call (415) 555-2671 now or".split()
    scores = field._scores(words)

    def total(path):
        return sum(scores[t, y] for t, y in enumerate(path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

    best = max(product(range(len(pii.LABELS)), repeat=len(words)), key=total)
    assert field.decode([words])[0].tolist() == list(best)


def test_field_adds_to_the_patterns(documents):
    rows = [
        *AWKWARD, (20, "é call (415) 555-2671 now"), (21, "joe (at) mail.org writes"), (22, "in 1987 at 10:30, 42 of 100"),
        (23, "ip 10.0.0.1 card 4111 1111 1111 1111"),
    ]
    found = {row.doc_id: row for row in pii.find_personal_data(documents(rows)).collect()}
    assert found[20].spans == "phone:7:21" and found[20].base_spans == "" and found[20].n_phone == 0
    assert found[21].spans.startswith("email:0:")
    assert found[22].spans == ""
    assert found[23].base_spans == found[23].spans == "ip:3:11,card:17:36"
    masked = {row.doc_id: row.text for row in pii.mask_personal_data(documents(rows)).collect()}
    assert masked[20] == "é call <PHONE> now" and masked[1] is None and masked[2] == ""
    assert masked[23] == "ip <IP> card <CARD>"


def test_personal_data_digests(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in QUERIES["op7_pii"](spark, small).collect():
        base = plain_spans(texts[row.doc_id])
        written = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in base)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]


def test_features_are_of_the_whole_word():
    """Digits behind any number of letters count, and so does each run of them."""
    late = "x" * 300 + "5551234567"
    assert pii.word_features(late) != ("plain",)
    assert "digits=10" in pii.word_features(late) and "letters=True" in pii.word_features(late)
    assert pii.word_features("1a" * 9) != pii.word_features("1a" * 8)
