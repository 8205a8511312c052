"""The pipeline against brute force, stage by stage."""

from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm.frames import read
from clickloom.session import stage
from samples import SCHEMA, TOKENIZER
from test_quality import counts
from test_simhash import expected, near_copies


def corpus():
    rows = [(i, text, "en", "hot") for i, text in near_copies(30, 3, 8)]
    rows += [(i, f"document {i} " + " ".join(f"word{i * k % 9973}" for k in range(12, 12 + i % 90)), "de", "hot") for i in range(200)]
    rows += [(300 + i, f"small source {i} " + " ".join(f"s{i}x{k}" for k in range(40)), "fr", ("a", "b", None)[i % 3]) for i in range(40)]
    rows += [(400 + i, "spam spam spam spam " * 20, "en", "a") for i in range(5)]
    rows += [(500, None, "en", "a"), (501, "", None, None), (502, "far too short", "en", "b"), (None, "a text without an id but with more than ten words in all", "en", "a")]
    rows += [(303, rows[233][1], "fr", rows[233][3])] * 2
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus(), SCHEMA).selectExpr("*", "cast(length(text) as bigint) AS n_chars").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 9 > 0), 0) for i in range(0, 300, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_equal_brute_force(spark, sf_dir):
    names = ["quality_rules", "simhash", "mixing", "packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    docs, results = read(spark, sf_dir, "documents"), {}
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        docs = results[name] = stage(function(spark, docs, sf_dir), name)
        assert name == "packing" or docs.columns == columns

    good = [(r[0], r[1]) for r in corpus() if not counts(r[1])[-1]]
    assert Counter((r.doc_id, r.text) for r in results["quality_rules"].collect()) == Counter(good)

    groups = {(i, c) for i, _, c in expected(good)}
    one = [(r.doc_id, r.text) for r in results["simhash"].collect()]
    assert len(one) == len(set(one)) and {i for i, _ in one} == {c for _, c in groups} and set(one) <= set(good)

    mixed = Counter((r.doc_id, r.text) for r in results["mixing"].collect())
    assert set(mixed) == set(one) and set(mixed.values()) == {1, 2}
    sources = Counter()
    for r in results["mixing"].collect():
        sources[r.source] += len(r.text.split()) + 1
    held = Counter()
    for r in results["simhash"].collect():
        held[r.source] += len(r.text.split()) + 1
    repeats = {s: sources[s] / held[s] for s in held}
    assert repeats["hot"] == 1 and max(repeats.values()) <= 2.1

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokens = Counter()
    for (doc_id, text), n in mixed.items():
        tokens[doc_id] += n * (len(tokenizer.encode(text, add_special_tokens=False).ids) + 1)
    packed = Counter()
    for r in results["packing"].collect():
        packed[r.doc_id] += r.length
    assert packed == tokens


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert corpus_pipeline.ORACLE_SQL is None and len({r.sequence_id for r in rows}) > 1
    assert {r.doc_id for r in rows} <= {r[0] for r in corpus()}


def test_empty_documents_pass_all_stages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    assert docs.count() == 0
