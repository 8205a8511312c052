import math

import pytest
from pyspark.sql import functions as F

from clickloom.llm import mixing
from clickloom.llm.mixing import MixTarget, mix, mix_plan, schedule
from samples import SCHEMA


@pytest.fixture(scope="module")
def corpus(spark):
    """One hot source with two thirds of the rows, three small ones."""
    sizes = {"hot": 400, "a": 100, "b": 60, None: 40}
    rows = [(f"{source}", i, "w " * (5 + (i * 7) % 40), source) for source, n in sizes.items() for i in range(n)]
    rows = [(1000 * k + i, text, "en", source) for k, (_, i, text, source) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA)


def totals(plan):
    return {r.source: r for r in plan.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.countDistinct("doc_id").alias("u"), F.first("weight").alias("w")).collect()}


def test_repetitions_meet_the_limit_and_every_document_stays(corpus):
    plan = mix_plan(corpus, MixTarget(repetitions=2.0, block_tokens=2000, cell_tokens=500))
    found = totals(plan)
    whole = {r.source: r["count"] for r in corpus.groupBy("source").count().collect()}
    assert {s: r.u for s, r in found.items()} == whole
    tokens = sum(r.t for r in found.values())
    assert all(abs(r.t - r.w * tokens) < 100 for r in found.values())
    assert abs(found["hot"].n - whole["hot"]) <= 1 and max(r.n / whole[s] for s, r in found.items()) == pytest.approx(2.0, abs=0.06)


def test_entropy_and_budget(corpus):
    plan = mix_plan(corpus, MixTarget(entropy=1.2, budget=6000, block_tokens=1000, cell_tokens=500))
    found = totals(plan)
    assert -sum(r.w * math.log(r.w) for r in found.values()) == pytest.approx(1.2, abs=1e-6)
    assert sum(r.t for r in found.values()) == pytest.approx(6000, abs=200)


def test_blocks_hold_the_weights_and_are_permuted(corpus):
    plan = mix_plan(corpus, MixTarget(repetitions=1.5, block_tokens=4000, cell_tokens=300)).cache()
    weights = {r.source: r.w for r in totals(plan).values()}
    blocks = plan.groupBy("block", "source").agg(F.sum("n_tokens").alias("t")).collect()
    size = {b: sum(r.t for r in blocks if r.block == b) for b in {r.block for r in blocks}}
    assert all(abs(r.t - weights[r.source] * size[r.block]) < 150 for r in blocks)
    rows = plan.filter("block = 0").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows)))
    runs = sum(a.source != b.source for a, b in zip(rows, rows[1:]))
    assert runs > 2 * len(weights)
    again = mix_plan(corpus.repartition(5), MixTarget(repetitions=1.5, block_tokens=4000, cell_tokens=300))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, plan.collect()), key=str)


def test_messy_rows(docs, empty):
    target = MixTarget(repetitions=1.0)
    got = sorted([(r.doc_id, r.source) for r in mix_plan(docs, target).collect()], key=str)
    assert got == sorted([(r[0], r["source"]) for r in docs.collect()], key=str)
    mixed = mix(docs, target)
    assert mixed.columns == docs.columns
    assert sorted(map(tuple, mixed.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert mix_plan(empty, target).count() == 0 and mix(empty, target).count() == 0


def test_one_target_is_needed(docs):
    with pytest.raises(ValueError, match="one of"):
        mix_plan(docs, MixTarget())


@pytest.mark.parametrize("doc_id", ["CAST(NULL AS long)", "CAST(7 AS long)"])
def test_many_rows_without_an_id_of_their_own_spread_over_all_cells(spark, doc_id):
    rows = spark.range(100_000).selectExpr(f"{doc_id} AS doc_id", "concat('text of row ', id) AS text", "'one' AS source")
    target = MixTarget(repetitions=1.0, cell_tokens=20_000, block_tokens=50_000)
    plan = schedule(rows, target)
    blocks = [r["count"] for r in plan.groupBy("block").count().collect()]
    assert sum(blocks) == 100_000 and max(blocks) < 1.1 * sum(blocks) / len(blocks) + 10 and len(blocks) == 10
    assert plan.select("order").distinct().count() == 100_000
    # the permuting hash tells all rows apart, so a cell holds its share of them
    assert mixing._items(rows, "source").select("text_hash").distinct().count() == 100_000


def test_targets_out_of_reach_are_refused(corpus):
    with pytest.raises(ValueError, match="repetitions"):
        mix_plan(corpus, MixTarget(repetitions=2.0, budget=10**7))
    with pytest.raises(ValueError, match="entropy"):
        mix_plan(corpus, MixTarget(entropy=2.0))
    even = mix_plan(corpus, MixTarget(entropy=math.log(4)))
    assert {round(r.w, 3) for r in totals(even).values()} == {0.25}
    assert mix_plan(corpus, MixTarget(repetitions=50.0, budget=100_000)).count() > 600
