"""Order-dependent operators that do not gather a whole group in one task.

A plain window over a group sorts that group in a single task, which breaks when
one key holds a large share of the rows. The operators here cut the common order
of all rows into slices of similar size, reduce every (group, slice) to one
summary row, run the window over the summaries and add the result back to the
rows. No task then sorts more than one slice, whatever the keys look like.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

ROWS_PER_SLICE = 1_000_000
SAMPLE_PER_SLICE = 100
SAMPLE_ROWS = 1_000_000
SLICE_SECONDS = 3600
LAST_ROWS = 10_000  # rows of a bucket that are sorted at the end of a selection


def sample_quantiles(df: DataFrame, value: str, at: list[float], rows: int) -> list[float]:
    """Approximate quantiles as increasing numbers, at most one per entry of ``at``.

    Only used to cut the order into slices. Results do not depend on where the
    cuts fall, so a sample that grows with the number of cuts is enough, as it is
    for Spark's own range partitioning. The numbers are read once, so that every
    use sees the same cuts.
    """
    if not at:
        return []
    wanted = SAMPLE_ROWS + SAMPLE_PER_SLICE * len(at)
    sampled = df.sample(min(1.0, wanted / max(1, rows)), seed=1)
    accuracy = SAMPLE_PER_SLICE * (len(at) + 1)
    quantiles = sampled.agg(F.percentile_approx(value, F.array(*[F.lit(q) for q in at]), accuracy)).first()[0]
    return sorted({float(q) for q in quantiles or []})


def even_cuts(df: DataFrame, value: str, rows_per_slice: int) -> list[float]:
    """Cuts that split the rows into slices of about ``rows_per_slice``."""
    rows = df.count()
    slices = math.ceil(rows / rows_per_slice)
    return sample_quantiles(df, value, [i / slices for i in range(1, slices)], rows)


def with_slices(df: DataFrame, value: str, cuts: list[float]) -> DataFrame:
    """Add ``_slice``, the number of cuts at or below the value; -1 for NULL."""
    if not cuts:
        return df.withColumn("_slice", F.when(F.col(value).isNull(), -1).otherwise(0))
    splits = [-math.inf, *cuts, math.inf]
    found = Bucketizer(splits=splits, inputCol=value, outputCol="_found", handleInvalid="keep").transform(df)
    return found.withColumn("_slice", F.when(F.col(value).isNull(), -1).otherwise(F.col("_found").cast("int"))).drop("_found")


def sequence_in_group(
    df: DataFrame, group: str, timestamp: str, tie_break: str, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Add ``event_sequence`` (1-based) and ``prev_timestamp`` by (timestamp, tie_break).

    Slices are stretches of time, so a busy group spreads over its hours. Rows
    without a time come first, in a slice of their own.
    """
    stretch = F.floor(F.unix_micros(timestamp) / F.lit(slice_seconds * 1_000_000))
    sliced = df.withColumn("_slice", stretch)
    by_slice = Window.partitionBy("_group").orderBy("_at")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        sliced.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_at"))
        .agg(F.count("*").alias("n"), F.max(timestamp).alias("last_at"))
        .select(
            "_group", "_at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
            F.lag("last_at").over(by_slice).alias("_last_before"),
        )
    )
    inside = Window.partitionBy(group, "_slice").orderBy(timestamp, tie_break)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("_slice").eqNullSafe(F.col("_at"))
    return (
        sliced.join(summary, same)
        .withColumn("event_sequence", F.col("_before") + F.row_number().over(inside))
        .withColumn("prev_timestamp", F.coalesce(F.lag(timestamp).over(inside), F.col("_last_before")))
        .drop("_slice", "_at", "_group", "_before", "_last_before")
    )


def shuffled_rank(
    df: DataFrame, groups: list[str], key: str, seed: int, rank: str, size: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add the 1-based rank of the row's key within ``groups``, in an order drawn from a
    hash of the key, and how many keys the group has. All rows of a key share its rank
    and, if they differ, the largest values of ``groups``.

    Only the distinct keys are ranked and joined back. The leading bits of the hash cut
    a group into slices of bounded size, so a class that holds most keys is ranked by
    many tasks. The windows over whole groups see one row per slice.
    """
    ids = df.groupBy(F.col(key).alias("_key")).agg(*[F.max(g).alias(g) for g in groups], F.count("*").alias("_rows"))
    bits = max(0, math.ceil(math.log2(max(1, ids.count()) / rows_per_slice)))
    hashed = ids.withColumn("_hash", F.md5(F.concat_ws("-", "_key", F.lit(str(seed))))).withColumn(
        "_slice", F.shiftright(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"), 32 - min(32, bits))
    )
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        hashed.groupBy(*groups, "_slice")
        .agg(F.count("*").alias("n"))
        .withColumns({"_before": F.coalesce(F.sum("n").over(before), F.lit(0)), size: F.sum("n").over(whole)})
        .drop("n")
    )
    inside = Window.partitionBy(*groups, "_slice").orderBy("_hash", "_key")
    ranked = hashed.join(summary, [*groups, "_slice"]).select(
        "_key", (F.col("_before") + F.row_number().over(inside)).alias(rank), size
    )
    return df.join(ranked, F.col(f"`{key}`").eqNullSafe(F.col("_key"))).drop("_key")


def running_totals(df: DataFrame, value: str, totals: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Per distinct value, the sums of ``totals`` over that and all larger values.

    Returns ``value`` (a double), the totals of that value, one ``cum_<name>`` column per
    total and ``next_<name>``, the totals of the next smaller value (null for the last).
    """
    cuts = even_cuts(df, value, rows_per_slice)
    points = with_slices(df.groupBy(value).agg(*[F.sum(t).alias(t) for t in totals]), value, cuts)
    downwards = Window.orderBy(F.desc("_slice"))
    above = downwards.rowsBetween(Window.unboundedPreceding, -1)
    # the largest value of each slice follows the smallest of the slice above
    tops = F.max_by(F.struct(*totals), value).alias("_top")
    offsets = points.groupBy("_slice").agg(*[F.sum(t).alias(t) for t in totals], tops).select(
        "_slice", *[F.coalesce(F.sum(t).over(above), F.lit(0)).alias(f"_above_{t}") for t in totals],
        F.lead("_top").over(downwards).alias("_next_top"),
    )
    in_slice = Window.partitionBy("_slice").orderBy(F.desc(value))
    inside = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    return points.join(offsets, "_slice").select(
        value, *totals,
        *[(F.col(f"_above_{t}") + F.sum(t).over(inside)).alias(f"cum_{t}") for t in totals],
        *[F.coalesce(F.lead(t).over(in_slice), F.col("_next_top")[t]).alias(f"next_{t}") for t in totals],
    )


def order_bits(v: Column) -> Column:
    """A long that orders like the double ``v``: equal zeros, NaN last.

    Its size is the bit pattern of the absolute value, put together from exponent and
    fraction by steps that are exact in doubles.
    """
    size = F.abs(v)

    def two(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent)

    guess = F.floor(F.log2(size)).cast("double")  # may be one off beside a power of two
    exponent = F.when(two(guess) > size, guess - 1).when(two(guess + 1) <= size, guess + 1).otherwise(guess)
    exponent = F.least(F.greatest(exponent, F.lit(-1022.0)), F.lit(1023.0))
    fraction = ((size / two(exponent) - 1) * F.lit(2.0**52)).cast("long")
    finite = F.shiftleft((exponent + 1023).cast("long"), 52) + fraction
    bits = F.when(size == 0, 0).when(size == float("inf"), F.lit(2047 << 52)).otherwise(finite)
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v < 0, -bits).otherwise(bits)


def order_statistics(
    rows: DataFrame, keys: list[str], ranks: list[Column], last_rows: int = LAST_ROWS, most: int | None = None
) -> dict[tuple, tuple[int, list[float]]]:
    """Per combination of ``keys`` the number of rows and the values ``v`` of exact ranks.

    ``v`` is a double and not null; ``ranks`` are 0-based, as functions of ``n``, the rows
    of the combination. The result reaches the driver, so combinations have to be few.

    Radix selection: a histogram of the leading sixteen bits finds the bucket of every
    rank. Only those buckets are looked into, sixteen bits a pass, until each holds one
    value or at most ``last_rows`` rows, which are sorted. Nothing is sampled. If no
    combination can have more rows than that, as ``most`` says, they are sorted at once.
    """
    if most is not None and most <= last_rows:
        sorted_rows = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("v")).alias("vs"))
        picked = F.array(*[F.get("vs", r.cast("int")) for r in ranks]).alias("values")
        return {tuple(row[k] for k in keys): (row["n"], row["values"]) for row in sorted_rows.select(*keys, "n", picked).filter("n > 0").collect()}
    coded = rows.select(*keys, "v", order_bits(F.col("v")).alias("k"))
    found: dict[tuple, tuple[int, list[float]]] = {}

    def bucketed(df: DataFrame, group: list[str], shift: int, *more: Column) -> DataFrame:
        bucket = F.shiftright("k", shift).alias("bucket")
        return df.groupBy(*group, bucket).agg(F.count("*").alias("size"), F.min("v").alias("lo"), F.max("v").alias("hi"), *more)

    def located(histogram: DataFrame, group: list[str], wanted: Column) -> list[Row]:
        """The bucket of every wanted rank; ranks come back relative to it."""
        within = Window.partitionBy(*group)
        before = within.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counted = histogram.withColumns({"start": F.coalesce(F.sum("size").over(before), F.lit(0)), "n": F.sum("size").over(within)})
        hits = counted.select("*", F.inline(wanted)).filter("r >= start AND r < start + size")
        return hits.select(*keys, "bucket", "size", "n", "lo", "hi", "i", (F.col("r") - F.col("start")).alias("r")).collect()

    def key_of(row: Row) -> tuple:
        return tuple(row[k] for k in keys)

    def settled(hit: Row) -> bool:
        if hit["lo"] != hit["hi"] and not math.isnan(hit["lo"]):
            return False
        found[key_of(hit)][1][hit["i"]] = hit["lo"]
        return True

    asked = F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("r")) for i, r in enumerate(ranks)])
    hits = located(bucketed(coded, keys, 48), keys, asked)
    for hit in hits:
        found.setdefault(key_of(hit), (hit["n"], [math.nan] * len(ranks)))
    for shift in (32, 16, 0):
        hits = [hit for hit in hits if not settled(hit)]
        if not hits:
            break
        fields = [*(rows.schema[k] for k in keys), *(StructField(c, LongType()) for c in ("prefix", "i", "r"))]
        wanted = rows.sparkSession.createDataFrame([(*key_of(h), h["bucket"], h["i"], h["r"]) for h in hits], StructType(fields))
        # a row per bucket that holds a rank
        wanted = wanted.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], "prefix").agg(F.collect_list(F.struct("i", "r")).alias("wanted"))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.shiftright("k", shift + 16) == F.col("prefix"))
        inside = coded.join(F.broadcast(wanted), same)
        if max(h["size"] for h in hits) <= last_rows:
            lists = inside.groupBy(*keys, "prefix").agg(F.first("wanted").alias("wanted"), F.sort_array(F.collect_list("v")).alias("vs"))
            for row in lists.select(*keys, "vs", F.inline("wanted")).select(*keys, "i", F.get("vs", F.col("r").cast("int")).alias("v")).collect():
                found[key_of(row)][1][row["i"]] = row["v"]
            break
        parts = bucketed(inside, [*keys, "prefix"], shift, F.first("wanted").alias("wanted"))
        hits = located(parts, [*keys, "prefix"], F.col("wanted"))
    else:
        for hit in hits:  # all bits are the same
            settled(hit)
    return found


def column_percentiles(df: DataFrame, named: dict[str, tuple[str, float]], last_rows: int = LAST_ROWS) -> DataFrame:
    """One row with interpolated percentiles, equal to percentile_cont, of one or more columns.

    ``named`` gives the column and the share of each; all of them are selected together.
    NULLs are ignored, a column without values has NULL percentiles.
    """
    columns = list(dict.fromkeys(column for column, _ in named.values()))
    values = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    rows = df.select(F.inline(values)).filter("v IS NOT NULL")
    shares = sorted({share for _, share in named.values()})
    place = [F.lit(share) * (F.col("n") - 1) for share in shares]
    found = order_statistics(rows, ["column"], [*map(F.floor, place), *map(F.ceil, place)], last_rows)

    def percentile(column: str, share: float) -> float | None:
        n, values = found.get((columns.index(column),), (0, []))
        if not n:
            return None
        at, i = share * (n - 1), shares.index(share)
        low, high = values[i], values[i + len(shares)]
        return low + (high - low) * (at - math.floor(at)) if high != low else low

    picked = [F.lit(percentile(*wanted)).cast("double").alias(name) for name, wanted in named.items()]
    return df.sparkSession.range(1).select(*picked)


def exact_percentiles(df: DataFrame, value: str, named: dict[str, float], last_rows: int = LAST_ROWS) -> DataFrame:
    """As ``column_percentiles``, of one column."""
    return column_percentiles(df, {name: (value, share) for name, share in named.items()}, last_rows)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed.

    Returns bin, bin_start, bin_end and frequency, empty bins included.
    """
    present = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    span = present.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    edges = span.select(
        F.struct("lo", ((F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("width"))
    ).scalar()
    position = F.floor((F.col("v") - edges["lo"]) / edges["width"])
    counts = (
        present.select(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("frequency"))
    )
    scaffold = (
        span.filter(F.col("lo").isNotNull())
        .withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    )
    return scaffold.join(counts, "bin", "left").select(
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
        F.round(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 6).alias("bin_end"),
        F.coalesce("frequency", F.lit(0).cast("long")).alias("frequency"),
    )


def rollup_visits(
    events: DataFrame, keys: list[str], counts: dict[str, Column], sums: dict[str, Column] | None = None
) -> DataFrame:
    """Per key unique_sessions, unique_users, counted conditions and whole-number sums.

    Events are reduced to (keys, session, user) before the two distinct counts, so
    those expand one row per visit and not every event.
    """
    sums = sums or {}
    per_visit = events.groupBy(*keys, "session_id", "user_id").agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()],
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )
    return per_visit.groupBy(*keys).agg(
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        *[F.sum(name).alias(name) for name in (*counts, *sums)],
    )


def rollup_entities(
    df: DataFrame,
    keys: list[str],
    entities: dict[str, str],
    counts: dict[str, tuple[str, Column | None]],
    measures: dict[str, Column],
) -> DataFrame:
    """Per key, several conditional distinct counts and plain sums in one pass.

    ``entities`` names id columns; ``counts`` maps an output to (entity,
    condition): distinct ids with at least one row meeting the condition.
    ``measures`` are whole-number expressions that are summed over all rows.

    Each row is expanded once per entity rather than once per distinct count, and
    the first shuffle is keyed by (keys, id), so a large key spreads over its ids.
    """
    tags = list(entities)
    ids = [
        F.struct(F.lit(i).alias("tag"), F.col(c).cast("string").alias("id"))
        for i, c in enumerate(entities.values())
    ]
    flags = {f"_f{i}": cond for i, (_, cond) in enumerate(counts.values()) if cond is not None}
    sums = {f"_m{i}": expr for i, expr in enumerate(measures.values())}
    expanded = df.select(
        *keys,
        *[cond.alias(f) for f, cond in flags.items()],
        *[expr.alias(m) for m, expr in sums.items()],
        F.explode(F.array(*ids)).alias("_e"),
    ).select("*", F.col("_e.tag").alias("_tag"), F.col("_e.id").alias("_id"))
    per_id = expanded.groupBy(*keys, "_tag", "_id").agg(
        F.count("*").alias("_rows"),
        *[F.max(F.when(F.col(f), 1).otherwise(0)).alias(f) for f in flags],
        *[F.sum(F.when(F.col("_tag") == 0, F.col(m))).alias(m) for m in sums],
    )
    outputs = []
    for i, (name, (entity, cond)) in enumerate(counts.items()):
        met = (F.col("_tag") == tags.index(entity)) & F.col("_id").isNotNull()
        if cond is not None:
            met = met & (F.col(f"_f{i}") == 1)
        outputs.append(F.count_if(met).alias(name))
    outputs += [F.sum(m).alias(name) for m, name in zip(sums, measures)]
    return per_id.groupBy(*keys).agg(*outputs)
