"""Shards of limited size by extendible hashing.

A directory indexed by the leading bits of a hash names the shards. Where the rows
under a prefix exceed the byte limit, and only there, another bit is used, until
every shard fits. Prefix sums are made for eight bits at a time: all rows first, then
only those under prefixes that are still too large, so a pass over the rows settles
eight levels of splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from clickloom.llm.frames import numbered, position, row_key, take
from clickloom.session import stage

BITS, STEP = 60, 8


def _hashed(docs: DataFrame, limit: int) -> DataFrame:
    """(a, b, copy, doc_id, n_bytes, h) per row, written.

    h holds 60 bits of a hash of id and text. Equal rows that together exceed the
    limit are told apart by their number.
    """
    rows = take(docs, {"doc_id": "doc_id", "text": "text"})
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("-"), F.md5(F.coalesce("text", F.lit(""))))
    bits = lambda text: F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")
    keyed = stage(
        rows.select(
            row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long"),
            F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), bits(name).alias("h"),
        ).select("key.*", "doc_id", "n_bytes", "h", F.monotonically_increasing_id().alias("row")),
        "shard-rows",
    )
    crowded = keyed.groupBy("h").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("s")).filter(F.expr(f"n > 1 and s > {limit}")).select("h", F.lit(True).alias("crowded"))
    own = bits(F.concat_ws("-", F.col("h").cast("string"), F.col("row").cast("string")))
    return stage(keyed.join(crowded, "h", "left").withColumn("h", F.when(F.col("crowded"), own).otherwise(F.col("h"))).drop("crowded"), "shard-rows")


def _prefix(depth: int):
    return F.shiftright("h", BITS - depth)


def _cells(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """Per prefix of ``depth`` + 8 bits the shard that takes it: its depth, bytes and rows, null if none fits."""
    deep = depth + STEP
    cells = rows.groupBy(_prefix(deep).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
    levels = cells.withColumn("parent", F.shiftright("cell", STEP)).repartition("parent")
    shard = F.lit(None).cast("struct<depth:int,shard_bytes:bigint,shard_rows:bigint>")
    for level in range(STEP, 0, -1):
        over = Window.partitionBy("parent", F.shiftright("cell", STEP - level))
        size, count = F.sum("bytes").over(over), F.sum("n").over(over)
        here = F.struct(F.lit(depth + level).alias("depth"), size.alias("shard_bytes"), count.alias("shard_rows"))
        fits = (size <= limit) | (count == 1)
        if depth + level == BITS:
            fits = F.lit(True)  # no bit is left
        shard = F.when(fits, here).otherwise(shard)
    return stage(levels.select("cell", shard.alias("shard")), "shard-cells")


def assign(docs: DataFrame, limit: int) -> DataFrame:
    """The shard of every row of ``docs`` (doc_id, text).

    Returns a, b (the row's key), row, doc_id, n_bytes, shard (the bits of its prefix),
    depth, shard_bytes and shard_rows.
    """
    rows = _hashed(docs, limit)
    whole = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("s"), F.count("*").alias("n")).first()
    settled = rows.withColumn(
        "shard",
        F.when(F.lit(whole.s <= limit or whole.n == 1), F.struct(F.lit(0).alias("depth"), F.lit(whole.s).alias("shard_bytes"), F.lit(whole.n).alias("shard_rows"))),
    )
    depth, open_ = 0, rows
    if whole.s > limit and whole.n > 1:
        while True:
            cells = _cells(open_, depth, limit)
            deep = depth + STEP
            mine = cells.filter("shard is not null").select(F.col("cell").alias("_cell"), F.col("shard").alias("_shard"))
            settled = settled.withColumn("_at", _prefix(deep)).join(mine, F.col("_at") == F.col("_cell"), "left")
            settled = settled.withColumn("shard", F.coalesce("shard", "_shard")).drop("_at", "_cell", "_shard")
            too_large = cells.filter("shard is null").select("cell")
            if too_large.isEmpty():
                break
            open_ = open_.withColumn("cell", _prefix(deep)).join(too_large, "cell", "left_semi").drop("cell")
            depth = min(deep, BITS - STEP)
    bits = F.when(F.col("shard.depth") == 0, "").otherwise(
        F.expr(f"lpad(bin(shiftright(h, {BITS} - shard.depth)), shard.depth, '0')")
    )
    return settled.select("a", "b", "row", "doc_id", "n_bytes", bits.alias("prefix"), "shard.*").withColumnRenamed("prefix", "shard")


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, shard, depth, shard_bytes, shard_rows of every row of ``docs``.

    n_bytes is the length of the UTF-8 text, 0 for a null one. A shard exceeds the
    limit only if it holds a single row that does. Repeated rows share a shard
    unless they exceed the limit together. Rows without a doc_id are sharded by
    their text. Other columns are ignored, an empty table gives no rows.
    """
    return assign(docs, limit).drop("a", "b", "row")


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Write ``docs`` as Parquet, one folder ``shard=<bits>`` per shard, one file each."""
    numbers = Window.partitionBy("a", "b").orderBy("row")
    plan = assign(docs, limit).select("a", "b", F.row_number().over(numbers).alias("_copy"), F.concat(F.lit("b"), "shard").alias("shard"))
    columns = (f"_{position(docs, c)}" for c in ("doc_id", "text"))
    rows = numbered(docs).select("*", row_key(*columns).alias("_key")).select("*", "_key.*").drop("_key")
    # numbered by all they hold, so that a task that runs again numbers them alike
    content = F.xxhash64(*[f"_{i}" for i, f in enumerate(docs.schema.fields) if not isinstance(f.dataType, MapType)])
    rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("a", "b").orderBy(content)))
    joined = rows.join(plan, ["a", "b", "_copy"]).drop("a", "b", "_copy")
    names = [c if c.lower() != "shard" else "shard_" for c in docs.columns]
    joined.toDF(*names, "shard").repartition("shard").write.partitionBy("shard").parquet(path)
