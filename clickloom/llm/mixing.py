"""Mixing sources to target weights by temperature, as permuted blocks.

The weight of a source is its share of all tokens to the power of an exponent,
normalised: 1 keeps the shares, 0 makes all sources equal. The exponent is bisected
until the weights reach a target entropy, or until no source is repeated more than
a limit. The weights are then realised exactly: every source is a stream of its
documents, in another order in each epoch, cut at its token target. A block takes
the same number of tokens, up to one document, from each source at every turn, and
its rows are permuted.

Running token counts are built from cells of bounded size: the leading bits of the
permuting hash cut each epoch of a source into cells, the cells are summed first,
and no task orders more than a cell, however large a source is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.frames import before, numbered, position, row_key, take
from clickloom.session import stage

TRIMMED = " \t\n\x0b\x0c\r"
HALVINGS_PER_PASS, PASSES = 6, 6


@dataclass(frozen=True)
class MixTarget:
    """One of ``entropy`` (nats) and ``repetitions`` (of the most repeated source).

    Without ``budget`` (tokens of the mix) it is the smallest with which every
    document appears at least once. A source that would then be repeated sets the
    ratio: with ``repetitions`` r no source appears more than r times as often as
    another.
    """

    entropy: float | None = None
    repetitions: float | None = None
    budget: int | None = None
    block_tokens: int = 1_000_000
    cell_tokens: int = 4_000_000
    seed: int = 17


def _items(docs: DataFrame, source: str) -> DataFrame:
    """One row per distinct row of ``docs``: keys, source, tokens and how often it occurs.

    Tokens are words and one end mark, so that no document is without any.
    """
    rows = take(docs, {"doc_id": "doc_id", "source": source, "text": "text"})
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(TRIMMED))
    words = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+")))
    return rows.select(
        row_key("doc_id", "source", "text").alias("key"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
        (words + 1).cast("long").alias("n_tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("text_hash"),
    ).groupBy("key.a", "key.b", "doc_id", "source", "text_hash").agg(F.max("n_tokens").alias("n_tokens"), F.count("*").alias("times"))


def exponent(sources: DataFrame, target: MixTarget) -> float:
    """The exponent in [0, 1] for ``sources`` (tokens), 1 where it already meets the target.

    A target that no exponent meets is refused: an entropy above that of equal weights, or
    a budget for which even the natural shares repeat a source too often.

    A pass evaluates all the midpoints that the next six halvings can ask for, as
    one aggregation, and follows the halvings on its 63 rows.
    """
    total = sources.agg(F.sum("tokens").cast("double")).scalar()
    share = F.col("tokens") / total
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        steps = 1 << HALVINGS_PER_PASS
        grid = [low + (high - low) * i / steps for i in range(steps + 1)]
        powers = sources.select(
            share.alias("p"), F.posexplode(F.array(*[F.lit(a) for a in grid])).alias("i", "alpha")
        ).withColumn("power", F.pow("p", "alpha"))
        rows = powers.groupBy("i", "alpha").agg(
            F.sum("power").alias("s"), F.sum(F.col("power") * F.log("p")).alias("l"),
            (F.max(F.col("power") / F.col("p")) / F.min(F.col("power") / F.col("p"))).alias("spread"),
            F.max(F.col("power") / F.col("p")).alias("most"),
        ).withColumns({"total": total}).collect()  # 65 rows, whatever the number of sources
        if not rows:
            return 1.0
        at = {r.i: r for r in rows}

        def flat(i: int) -> bool:
            """Whether the weights at this exponent are at least as even as the target."""
            r = at[i]
            if target.entropy is not None:
                return math.log(r.s) - r.alpha * r.l / r.s >= target.entropy - 1e-12
            repeated = r.spread if target.budget is None else r.most / r.s * target.budget / r.total
            return repeated > target.repetitions

        if high - low == 1.0:
            if target.entropy is not None and not flat(0):
                raise ValueError(f"an entropy of {target.entropy} is above that of equal weights")
            if target.repetitions is not None and flat(steps):
                raise ValueError(f"no weights keep to {target.repetitions} repetitions in a budget of {target.budget}")
            if flat(steps) or not flat(0):
                return 1.0 if flat(steps) else 0.0
        first, last = 0, steps
        while last - first > 1:
            middle = (first + last) // 2
            first, last = (middle, last) if flat(middle) else (first, middle)
        low, high = grid[first], grid[last]
    return low if target.entropy is not None else high


def weights(sources: DataFrame, target: MixTarget) -> DataFrame:
    """Add weight, goal (tokens of the source in the mix) and quota (its tokens per block)."""
    if (target.entropy is None) == (target.repetitions is None):
        raise ValueError("give one of entropy and repetitions")
    alpha = exponent(sources, target)
    total = sources.agg(F.sum("tokens").cast("double")).scalar()
    powered = sources.withColumn("power", F.pow(F.col("tokens") / total, F.lit(alpha)))
    norm = powered.agg(F.sum("power")).scalar()
    weighted = powered.withColumn("weight", F.col("power") / norm)
    if target.budget is None:
        budget: Column = weighted.agg(F.max(F.col("tokens") / F.col("weight"))).scalar()
        goal = F.greatest(F.col("tokens"), F.round(F.col("weight") * budget).cast("long"))
    else:
        goal = F.round(F.col("weight") * target.budget).cast("long")
    aimed = stage(weighted.withColumn("goal", goal).drop("power"), "mix-sources")
    blocks = aimed.agg(F.greatest(F.lit(1), F.ceil(F.sum("goal") / target.block_tokens))).scalar()
    return aimed.withColumn("quota", F.greatest(F.lit(1), F.ceil(F.col("goal") / blocks)).cast("long"))


def schedule(docs: DataFrame, target: MixTarget, source: str = "source") -> DataFrame:
    """Which rows appear in which epoch, block and place.

    Returns a, b (the row's key), doc_id, source, n_tokens, times (equal rows, which
    go together), weight, epoch, block, order (the permuting hash inside a block).
    """
    items = stage(_items(docs, source), "mix-items").withColumn("of", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    totals = stage(items.groupBy("of").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("tokens")), "mix-totals")
    aimed = weights(totals, target)
    epochs = F.ceil(F.col("goal") / F.col("tokens")).cast("int")
    bits = F.least(F.lit(32), F.greatest(F.lit(0), F.ceil(F.log2(F.col("tokens") / target.cell_tokens)))).cast("int")
    # the text, too, so that rows without an id, or of one id, spread over all cells
    known = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_hash"))
    copies = (
        items.join(aimed, "of")
        .filter("goal > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
        .withColumn("hash", F.md5(F.concat_ws("-", F.lit(str(target.seed)), "epoch", known)))
        .withColumn("cell", F.floor(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long") / F.pow(F.lit(2.0), 32 - bits)))
    )
    cells = copies.groupBy("of", "epoch", "cell").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("in_cell"))
    offsets = before(cells, ["of", "epoch"], ["cell"], "in_cell", "cell_start").drop("in_cell")
    inside = Window.partitionBy("of", "epoch", "cell").orderBy("hash", "a", "b").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("n_tokens") * F.col("times")).over(inside), F.lit(0).cast("long"))
    placed = (
        copies.join(offsets, ["of", "epoch", "cell"])
        .withColumn("start", F.col("epoch") * F.col("tokens") + F.col("cell_start") + earlier)
        .filter("start < goal")
    )
    return placed.select(
        "a", "b", "doc_id", "source", "n_tokens", "times", "weight", "epoch",
        F.floor(F.col("start") / F.col("quota")).cast("long").alias("block"),
        F.md5(F.concat_ws("-", F.lit("block"), F.lit(str(target.seed)), "epoch", known)).alias("order"),
    )


def mix_plan(docs: DataFrame, target: MixTarget, source: str = "source") -> DataFrame:
    """One row per document in the mix: doc_id, source, n_tokens, weight, epoch, block, position.

    Reads doc_id, text and the source column. A null text has one token, its end
    mark; rows with a null source are a source of their own. Repeated rows appear
    together, as often as they occur. Other columns are ignored, an empty table
    gives no rows. position counts from 0 inside a block.
    """
    rows = schedule(docs, target, source).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    in_block = Window.partitionBy("block").orderBy("order", "a", "b", "epoch", "copy")
    return rows.select(
        "doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "epoch", "block",
        (F.row_number().over(in_block) - 1).cast("long").alias("position")
    )


def mix(docs: DataFrame, target: MixTarget, source: str = "source") -> DataFrame:
    """The rows of ``docs`` as the mix has them, with all their columns.

    A block lies in one partition, its rows in their permuted order.
    """
    plan = schedule(docs, target, source).select("a", "b", "epoch", "block", "order")
    columns = (f"_{position(docs, c)}" for c in ("doc_id", source, "text"))
    rows = numbered(docs).select("*", row_key(*columns).alias("_key")).select("*", "_key.*").drop("_key")
    names = [f"_{i}" for i in range(len(docs.columns))]
    mixed = rows.join(plan, ["a", "b"]).repartition("block").sortWithinPartitions("block", "order", "a", "b", "epoch")
    return mixed.select(*names).toDF(*docs.columns)
