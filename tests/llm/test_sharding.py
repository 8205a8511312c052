from collections import defaultdict

import pytest

from clickloom.llm import sharding


def check(rows, limit):
    size, number = defaultdict(int), defaultdict(int)
    for r in rows:
        for d in range(len(r.shard) + 1):
            size[r.shard[:d]] += r.n_bytes
            number[r.shard[:d]] += 1
    leaves = {r.shard for r in rows}
    for r in rows:
        assert r.depth == len(r.shard) and (r.shard_bytes, r.shard_rows) == (size[r.shard], number[r.shard])
        assert size[r.shard] <= limit or number[r.shard] == 1
    for leaf in leaves:
        # only oversized buckets are split, and no shard holds another
        assert all(size[leaf[:d]] > limit and leaf[:d] not in leaves for d in range(len(leaf)))


@pytest.mark.parametrize("limit", [1, 500, 5000, 10**9])
def test_shards_fit_and_only_large_buckets_split(spark, limit):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(800)] + [(5, "hot row " * 4)] * 400 + [(None, None), (7, "y" * 9000)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, shard string, Doc_Id int")
    got = sharding.shards(df, limit).collect()
    assert sorted(((r.doc_id, r.n_bytes) for r in got), key=str) == sorted(((d, len((t or "").encode())) for d, t in rows), key=str)
    check(got, limit)


def test_messy_rows_and_files(spark, docs, empty, tmp_path):
    check(sharding.shards(docs, 60).collect(), 60)
    assert sharding.shards(empty, 60).count() == 0
    path = str(tmp_path / "shards")
    plain = docs.select("doc_id", "lang", "source", "n_tokens").withColumn("text", docs["lang"])
    sharding.write_shards(plain, 4, path)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert {r.shard[1:] for r in back.collect()} == {r.shard for r in sharding.shards(plain, 4).collect()}
