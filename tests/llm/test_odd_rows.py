"""Repeated rows, clashing columns and extreme values in the stages and operators that join rows back."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import additive_search, minhash, mixing, secrets, toxicity, trie_counts

CLASH = "doc_id long, text string, lang string, source string, n_chars long, _size long, _words string, _cut string, _taken long, _key string, row string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def clash(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else None, 7, "keep", "keep", 9, "k", "r") for i, t, s in rows], CLASH)


def test_mixed_rows_against_what_was_taken(spark):
    rnd = random.Random(3)
    rows = [(1, "four words are here", "a")] * 4 + [(None, "null id text", None)] * 3 + [(None, None, "b"), (2, "", "b"), (2, "another text of id two", "b")]
    rows += [(i, " ".join(f"w{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 30))), rnd.choice(["a", "b", "c", None])) for i in range(10, 60)]
    docs = clash(spark, rows)
    out = mixing.apply_mix(docs)
    got = out.collect()
    taken = mixing.mix(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).collect()
    by = {}
    for r in got:
        by[(r.doc_id, r.source)] = by.get((r.doc_id, r.source), 0) + words(r.text)
    assert {k: n for k, n in by.items() if n} == {(r.doc_id, r.source): r.n for r in taken if r.n}
    assert out.columns == docs.columns and {(r._size, r._words, r._cut, r._taken, r._key, r.row) for r in got} == {(7, "keep", "keep", 9, "k", "r")}
    assert all(r.n_chars == len(r.text) for r in got if r.text) and sum(r.text is None for r in got) == 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.apply_mix(docs.repartition(5)).collect()))
    assert mixing.apply_mix(docs.limit(0)).count() == 0
    # every text is a whole one or a head of one
    texts = {(r[0], r[2], r[1]) for r in rows}
    assert all((r.doc_id, r.source, r.text) in texts or any(t and t.startswith(r.text) for i, s, t in texts if (i, s) == (r.doc_id, r.source)) for r in got)


def test_one_of_rows_that_repeat_id_and_text_stays(spark):
    long = "one two three four five six seven eight nine ten"
    docs = clash(spark, [(1, long, "a")] * 4 + [(2, long, "b"), (3, "other words that stand alone in here", "a"), (4, None, "a"), (4, None, "a"), (None, long, "a"), (5, "x y", "a"), (5, "another text of one id", "a")])
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, long), (1, long), (3, "other words that stand alone in here"), (4, ""), (4, ""), (5, "another text of one id"), (5, "x y")]


def test_redaction_and_rejection_keep_clashing_columns(spark):
    docs = clash(spark, [(1, "token=abcdefgh and more", "a"), (None, None, None), (1, "", "a")])
    out = secrets.redact(docs)
    assert out.columns == docs.columns and {(r.text, r.n_chars, r._words) for r in out.collect()} == {("<secret> and more", 17, "keep"), (None, None, "keep"), ("", None, "keep")}
    kept = toxicity.reject_toxic(docs, toxicity.OrdinalModel({"more": 9.0}, (3.0,)))
    assert kept.columns == docs.columns and [r.text for r in kept.collect()] == [None, ""]


def test_many_rules_need_wider_marks():
    rules = tuple(secrets.Rule(f"k{i}", f"{chr(97 + i % 26)}{chr(97 + i // 26)}[0-9]+", 3) for i in range(300))
    wide, narrow = secrets.Scanner(rules), secrets.Scanner(rules[:20])
    assert wide._ready() is not None and wide._hit is None and narrow._ready() is not None and narrow._hit is not None
    text = "aa12 za1 bl555 é ab9"
    want = sorted((m.start(), f"k{i}", m.end()) for i in range(300) for m in re.finditer(rules[i].pattern, text) if len(m[0]) >= 3)
    assert sorted(wide.spans(text)) == want and len(want) == 4


def test_all_kinds_against_regular_expressions():
    scanner, rnd = secrets.Scanner(), random.Random(8)
    parts = ["ghp_", "gho_", "A" * 36, "xoxb-", "1234567890-", "AIza", "b" * 35, "eyJ", "abc", ".", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", " ", "\n", "é"]
    for _ in range(3000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 12)))
        want = sorted((m.start(), k, m.end()) for k, r in enumerate(secrets.MORE) for m in re.finditer(r.pattern, text) if len(m[0]) >= r.least)
        kinds = [r.kind for r in secrets.MORE]
        assert [(s, kinds.index(k), e) for s, k, e in scanner.spans(text) if k in kinds] == want, text


def test_grades_come_from_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (2, 0, 1), (3, None, 1), (4, 1, 3), (5, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    texts, grades = toxicity.sample(docs, labels, 100)
    assert dict(zip(texts, grades, strict=True)) == {"text 0": 0, "text 1": 1, "text 2": 2, "text 3": 1, "text 4": 3, "text 5": 1}


def test_extreme_vectors_take_part(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 2e200]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [-5e-324, 1e-310])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 9)) for r in sorted(additive_search.search(table, F.col("vec_id") == 0).collect(), key=lambda r: r["rank"])]
    assert got[:3] == [(2, 1.0), (3, 1.0), (1, round(3 / np.sqrt(10), 9))] and len(got) == 4


def test_a_long_unbroken_word_is_counted(spark):
    from presslake.llm import pieces
    from presslake.llm.queries import PIECE_MODEL

    vocabulary = pieces.load(PIECE_MODEL)
    import sentencepiece

    word = "abcdefghij" * 5000
    counts = trie_counts.TrieCounter(vocabulary).count([word, word[:-3], None])[1]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert counts.tolist() == [len(library.encode(word)), len(library.encode(word[:-3])), 0]


@pytest.mark.parametrize("threshold", [0.0, 1.1])
def test_severity_sums_over_thresholds(threshold):
    model = toxicity.OrdinalModel({"bad": 2.0, "bad*": 0.5, "wors*": 1.5}, (0.5, 2.0))
    severity, p, grade, toxic = toxicity._judged(model, ["bad worse", "good", None], threshold)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    x = [3.5, 0.0, 0.0]
    assert np.allclose(severity, [sigmoid(v - 0.5) + sigmoid(v - 2.0) for v in x]) and np.allclose(p, [sigmoid(v - 0.5) for v in x]) and toxic.all() == (threshold == 0)
