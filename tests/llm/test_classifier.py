import math
import random
import zlib

import pytest

from clickloom.llm import classifier
from clickloom.llm.frames import read

QUICK = classifier.Machine(rounds=30, buckets=256, rows=500)


def test_scores_equal_all_pairs(spark):
    """The model's score is the sum over single entries and over all pairs of entries."""
    draw = random.Random(1)
    words = [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(draw.choices(words[: 30 if i % 2 else 40], k=25)) + ("" if i % 2 else " ###"), i * 3) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    machine = classifier.Machine(rounds=10, buckets=64)
    scorer = classifier.learn(docs, labels, machine)
    got = {r.doc_id: r.score for r in classifier.score(docs, scorer).collect()}
    bias, linear, factors = scorer.model.intercept, scorer.model.linear.toArray(), scorer.model.factors.toArray()
    entries = classifier.features(classifier._inputs(docs, machine.metadata), machine, ["doc_id"]).limit(20).collect()
    for r in entries:
        x = r.features.toArray()
        at = [i for i in range(len(x)) if x[i]]
        pairs = sum(float(factors[i] @ factors[j]) * x[i] * x[j] for k, i in enumerate(at) for j in at[:k])
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-(bias + linear @ x + pairs))), abs=1e-9)


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    rows = classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500
    right = {q: sum(r.predicted == q for r in rows if r.quality == q) / sum(r.quality == q for r in rows) for q in (0, 1)}
    assert right[0] >= 0.95 and right[1] >= 0.99


def test_messy_rows_have_scores(docs, spark, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (7, 0, 0), (8, 0, 0), (8, 1, 0), (6, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, TEXT int")
    got = classifier.classify(docs, labels, QUICK).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len({r.score for r in got if r.doc_id == 8}) == 1
    assert classifier.classify(empty, labels, QUICK).count() == 0


def test_without_both_labels_the_score_is_their_share(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.classify(docs, none, QUICK).collect()} == {0.5}
    good = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    assert {r.score for r in classifier.classify(docs, good, QUICK).collect()} == {2 / 3}


def test_held_out_labels_and_excluded_columns_change_nothing(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices("the of and to in".split(), k=20)) + (" $$$" * 9 if i % 3 == 0 else ""), "en", "s1") for i in range(120)]
    labels = [(i, int(i % 3 > 0)) for i in range(120)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    schema = "doc_id long, text string, lang string, source string"
    frames = [
        (spark.createDataFrame(rows, schema).coalesce(1), labels),
        (spark.createDataFrame([(i, t, "xx", f"z{i}") for i, t, _, _ in rows], schema).coalesce(1), turned),
    ]
    a, b = (
        {r.doc_id: r.score for r in classifier.classify(d, spark.createDataFrame(l, "doc_id long, quality int").coalesce(1), QUICK).collect()}
        for d, l in frames
    )
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_one_row_of_a_repeated_id_is_learnt(spark):
    docs = spark.range(3000).selectExpr("IF(id < 2900, 1, id) AS doc_id", "concat('text ', id % 7, IF(id % 2 = 0, ' ###', '')) AS text")
    labels = spark.range(1, 3000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    scorer = classifier.learn(docs, labels, classifier.Machine(rounds=2, buckets=16, rows=50))
    assert scorer.model is not None and classifier.score(docs, scorer).count() == 3000
