"""Quality rules whose cutoffs limit the share of good documents they reject.

Base rules are fixed. Further rules have a grid of cutoffs each, and are used in a
stratum only if labelled documents prove that they reject few good ones there. Labelled
documents count once per text, so that copies are one trial, and are split by a hash of
the text: the tuning half chooses one combination of cutoffs per stratum, the holdout
half tests it. The test is exact: with n good holdout texts of which k are rejected, the
chance of k or fewer under the largest allowed rate must not exceed the error level,
divided by the strata that have a choice to test.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.frames import numbered, position, take
from clickloom.session import stage

SPACE = "\\x20\\x09-\\x0D"
TRIMMED = " \t\n\x0b\x0c\r"
WINDOW = 5


@dataclass(frozen=True)
class RiskLimits:
    """Rates are per 1000 words; a rule rejects at its cutoff or above (short: below)."""

    good_rejected: float = 0.02  # of the good documents of a stratum, by all rules together
    error: float = 0.05  # chance that any accepted cutoff breaks that limit
    lift: int = 3  # a cutoff must reject bad documents so many times as often as good ones
    cutoffs: dict[str, tuple[int, ...]] = field(
        default_factory=lambda: {
            "symbols": (30, 60, 120, 250, 500),
            "repeats": (40, 80, 120, 160),
            "dup_lines": (1, 2, 4, 8),
            "long_words": (8000, 10000, 12000, 15000),
            "short": (50, 30, 20, 15),
        }
    )


def _when(condition: Column, value: Column, otherwise: Column) -> Column:
    return F.when(condition, value).otherwise(otherwise)


def metrics(docs: DataFrame, stratum: str = "lang", whole: bool = False) -> DataFrame:
    """Word, symbol, line and repetition counts of every row's whole text.

    Returns doc_id, stratum, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, written to the shared folder: a filter pushed into the array
    functions would repeat them for every element. With ``whole`` a column ``row`` holds
    the columns of ``docs`` as _0, _1, .... Windows are compared by their
    64-bit hashes within a text; only texts in which some window repeats are sorted.
    """
    held = numbered(docs)
    doc_id, of, raw = (F.col(f"_{position(docs, c)}") for c in ("doc_id", stratum, "text"))
    carried = ["row"] if whole else []
    rows = held.select(
        *[F.struct(*held.columns).alias(c) for c in carried], doc_id.cast("long").alias("doc_id"),
        of.cast("string").alias("stratum"), F.coalesce(raw, F.lit("")).alias("text"),
    ).withColumn("text_hash", F.md5("text"))
    trimmed = rows.withColumn("trimmed", F.btrim("text", F.lit(TRIMMED)))
    words = trimmed.select(
        *carried, "doc_id", "stratum", "text_hash",
        _when(F.col("trimmed") == "", F.array().cast("array<string>"), F.split("trimmed", f"[{SPACE}]+")).alias("words"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
    )
    window = F.lit(WINDOW)
    hashes = words.select(
        *carried, "doc_id", "stratum", "text_hash", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _when(
            F.size("words") >= window,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - window),
                lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
            ),
            F.array().cast("array<bigint>"),
        ).alias("hashes"),
    )
    ordered = hashes.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("hashes")
    found = ordered.withColumn(
        "at",
        F.array_sort(
            F.transform(
                F.filter(
                    "ordered",
                    lambda x, j: F.coalesce(x["h"] == F.get("ordered", j - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("ordered", j + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("ordered")
    covered = F.aggregate(
        F.transform("at", lambda p, j: F.least(window, F.coalesce(F.get("at", j + 1) - p, window))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    return stage(found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("at"), "quality-metrics")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _per_mille(count: str) -> Column:
    return 1000 * F.col(count)


def rejects(rule: str, cutoff: Column) -> Column:
    """Whether the rule rejects a row at the cutoff; never for a null cutoff."""
    per_word = cutoff * F.col("n_words")
    condition = {
        "symbols": _per_mille("n_symbols") >= per_word,
        "repeats": _per_mille("n_repeat_words") >= per_word,
        "dup_lines": F.col("n_dup_lines") >= cutoff,
        "long_words": _per_mille("word_chars") >= per_word,
        "short": F.col("n_words") < cutoff,
    }[rule]
    return F.coalesce(condition, F.lit(False))


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9, carried back to n + 1."""
    x = n + 9.0
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    back = sum((F.log(n + float(k)) for k in range(2, 9)), F.log(n + 1.0))
    return (x - 0.5) * F.log(x) - x + 0.5 * F.log(F.lit(6.283185307179586)) + series - back


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """Chance of k or fewer among n at the rate; 1 where k is above the expected number.

    The terms are summed from the k-th downwards. Below the mean they fall faster
    than exp(-j*j/2k), so those further than 12 roots of k away count for nothing.
    """
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate))
    )
    far = F.least(k, F.ceil(12 * F.sqrt(k)) + 20).cast("int")
    odds = F.lit((1 - rate) / rate)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] * (k - j + 1) / (n - k + j) * odds
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(far >= 1, F.sequence(F.lit(1), far)).otherwise(F.array().cast("array<int>"))
    return F.when(k > n * rate, F.lit(1.0)).otherwise(top * F.aggregate(steps, start, step, lambda acc: acc["total"]))


def _labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct texts of a stratum with one label that pass the base rules: counts, good, holdout."""
    known = (
        take(labels, {"doc_id": "doc_id", "quality": "quality"})
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("highest"))
        .filter("quality = highest and doc_id is not null")
        .select("doc_id", (F.col("quality") == 1).alias("good"))
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    texts = measured.filter(~base_failed()).join(known, "doc_id").groupBy("stratum", "text_hash", *counts).agg(
        F.min("good").alias("good"), F.max("good").alias("highest")
    )
    return texts.filter("good = highest").drop("highest").withColumn("holdout", F.substring("text_hash", 1, 1) >= "8")


def _grid(limits: RiskLimits) -> Column:
    return F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(rank).alias("rank"), F.lit(cutoff).alias("cutoff"), rejects(rule, F.lit(cutoff)).alias("hit"))
            for rule, values in limits.cutoffs.items()
            for rank, cutoff in enumerate(values)
        ]
    )


def cutoffs(measured: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits()) -> DataFrame:
    """(stratum, rule, cutoff): the cutoffs whose combined rejection is proven in a stratum.

    The tuning half chooses per stratum and rule the useful cutoff that finds most bad
    documents, the mildest of equals, among those that spend at most half the rule's part
    of the allowed rate. It orders the rules by the bad documents they find, and takes as
    many as find most together and pass the test on the tuning half itself. The holdout
    half tests that one combination at the whole rate, so the error is divided by the
    strata with a choice only. A stratum whose test fails has no rows.

    Labels (doc_id, quality) that contradict each other are left out, for one document or
    for copies of one text, as are documents that fail the base rules.
    """
    used = stage(_labelled(measured, labels), "labelled")
    rules = list(limits.cutoffs)
    tuned = (
        used.filter(~F.col("holdout")).select("stratum", "good", F.explode(_grid(limits)).alias("g"))
        .groupBy("stratum", "g.rule", "g.rank", "g.cutoff")
        .agg(
            F.count_if("good").alias("good_n"), F.count_if(F.expr("good and g.hit")).alias("good_k"),
            F.count_if(F.expr("not good")).alias("bad_n"), F.count_if(F.expr("not good and g.hit")).alias("bad_k"),
        )
    )
    useful = (F.col("bad_k") > 0) & (F.col("bad_k") * F.col("good_n") >= limits.lift * F.col("good_k") * F.col("bad_n"))
    safe = F.col("good_k") <= F.col("good_n") * (limits.good_rejected / (2 * len(rules)))
    chosen = (
        tuned.filter(useful & safe).groupBy("stratum", "rule")
        .agg(F.max_by(F.struct("cutoff", "bad_k", "good_k"), F.struct("bad_k", "rank")).alias("c"))
        .select("stratum", "rule", "c.*")
    )
    place = F.row_number().over(Window.partitionBy("stratum").orderBy(F.desc("bad_k"), "good_k", "rule"))
    chosen = stage(chosen.select("stratum", "rule", "cutoff", place.alias("place")), "cutoff-choice")
    per_stratum = chosen.groupBy(F.col("stratum").alias("of")).agg(
        F.max("place").alias("rules"),
        *[F.max(F.when(F.col("rule") == r, F.col(c))).alias(f"{c}_{r}") for r in rules for c in ("cutoff", "place")],
    )
    # the place of the first rule that rejects the document
    first = F.least(F.lit(len(rules) + 1), *[F.when(rejects(r, F.col(f"cutoff_{r}")), F.col(f"place_{r}")) for r in rules])
    of = F.col("stratum").eqNullSafe(F.col("of"))
    counted = used.join(per_stratum, of).select("of", "rules", "good", "holdout", first.alias("first"))
    hits = lambda rows, i: F.count_if(F.expr(rows) & (F.col("first") <= i + 1))
    counted = counted.groupBy("of", "rules").agg(
        F.count_if(F.expr("not holdout and good")).alias("good_n"), F.count_if(F.expr("holdout and good")).alias("n"),
        *[
            F.array(*[hits(rows, i) for i in range(len(rules))]).alias(name)
            for name, rows in (("good_k", "not holdout and good"), ("k", "holdout and good"), ("bad_k", "not holdout and not good"))
        ],
    )
    counted = stage(counted, "cutoff-tests")
    level = F.lit(limits.error) / counted.agg(F.count("*")).scalar()
    # of the combinations that pass, the one that finds most; of equals the shortest
    tried = counted.withColumn("depth", F.explode(F.sequence(F.lit(1), F.col("rules"))))
    at = lambda name: F.element_at(name, F.col("depth"))
    best = tried.filter(binomial_tail(F.col("good_n"), at("good_k"), limits.good_rejected) <= level).groupBy("of").agg(
        F.max_by(F.struct("depth", "n", at("k").alias("k")), F.struct(at("bad_k").alias("found"), -F.col("depth"))).alias("best")
    )
    best = stage(best.select("of", "best.*"), "cutoff-tests")
    proven = best.filter(binomial_tail(F.col("n"), F.col("k"), limits.good_rejected) <= level)
    kept = of & (F.col("place") <= F.col("depth"))
    return chosen.join(proven.select("of", "depth"), kept).select("stratum", "rule", "cutoff")


def _judged(docs: DataFrame, labels: DataFrame, limits: RiskLimits, stratum: str, whole: bool = False) -> DataFrame:
    measured = metrics(docs, stratum, whole)
    per_stratum = cutoffs(measured, labels, limits).groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in limits.cutoffs]
    )
    joined = measured.join(per_stratum.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left")
    rejected = base_failed()
    for rule in limits.cutoffs:
        rejected = rejected | rejects(rule, F.col(f"cut_{rule}"))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~rejected)


def judge(docs: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits(), stratum: str = "lang") -> DataFrame:
    """Counts, base verdict and verdict per row of ``docs`` (doc_id, text and the stratum).

    A null text has no words and fails the base rules. Rows with a null stratum are
    a stratum of their own; a stratum without enough labels keeps what the base
    rules keep. Repeated rows get equal verdicts. Other columns are ignored, an
    empty table gives no rows; without labels only the base rules reject.
    """
    return _judged(docs, labels, limits, stratum).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits(), stratum: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, that neither the base rules nor the proven ``cutoffs`` reject.

    The rows are written beside their counts, so that no text is shuffled or sorted to drop some.
    """
    judged = _judged(docs, labels, limits, stratum, whole=True)
    return judged.filter("kept").select("row.*").toDF(*docs.columns)
