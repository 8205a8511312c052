"""Quality classifier: a factorisation machine over words, structure and metadata.

A text is a vector of hashed word frequencies of length one, shares and sizes that
describe its structure, and numeric metadata of its row. The machine weighs every entry
alone and every pair of entries by the product of their factor vectors. Summed over
all pairs that is half of what, factor by factor, the square of the sum exceeds the
sum of squares by, so a text is scored in a time linear in its entries and factors;
Spark ML's model does so, without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.frames import numbered, position, take
from clickloom.session import stage

SPACE = "[\\x20\\x09-\\x0D]+"
FOLDS = 5


@dataclass(frozen=True)
class Machine:
    """Size and effort of a fit. ``rows`` bounds the labelled documents it uses."""

    factors: int = 4
    buckets: int = 2048  # entries that words are hashed to
    rounds: int = 80
    step: float = 0.1
    penalty: float = 1e-3
    rows: int = 20_000
    parts: int = 8  # tasks per round; the rows are bounded, so are they
    seed: int = 7
    metadata: tuple[str, ...] = ("n_chars",)


@dataclass(frozen=True)
class Scorer:
    """A fitted machine; without one, because a class had no documents, every score is ``prior``."""

    machine: Machine
    model: FMClassificationModel | None
    prior: float


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: a fifth of the ids; never for a null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _share(text: str, others: str) -> Column:
    """Share of the code points of a text that remain without ``others``."""
    return F.length(F.regexp_replace(text, others, "")) / F.greatest(F.length(text), F.lit(1))


def structure(words: str, text: str) -> dict[str, Column]:
    """What describes a text's structure, each mostly between 0 and 1."""
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")
    return {
        "n_words": F.log1p(F.size(words)) / 10,
        "n_lines": F.log1p(F.size(lines)) / 10,
        "word_length": F.least(F.length(F.array_join(words, "")) / n_words / 10, F.lit(2.0)),
        "letters": _share(text, "\\P{L}+"),
        "capitals": _share(text, "\\P{Lu}+"),
        "digits": _share(text, "\\P{Nd}+"),
        "symbols": _share(text, "[\\p{L}\\p{Nd}\\s]+"),
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "words_again": F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))) / n_words,
        "lines_again": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
    }


def _inputs(docs: DataFrame, metadata: tuple[str, ...]) -> DataFrame:
    """doc_id, text and the metadata as _m0, _m1, ...; a metadata column the table lacks is null."""
    folded = [c.lower() for c in docs.columns]
    held = numbered(docs)
    known = [
        F.col(f"_{position(docs, c)}").try_cast("double") if c.lower() in folded else F.lit(None).cast("double") for c in metadata
    ]
    rows = take(docs, {"doc_id": "doc_id", "text": "text"}) if not metadata else held.select(
        F.col(f"_{position(docs, 'doc_id')}").alias("doc_id"), F.col(f"_{position(docs, 'text')}").alias("text"),
        *[m.alias(f"_m{i}") for i, m in enumerate(known)],
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))


def features(inputs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The kept columns and ``features`` of rows as ``_inputs`` gives them."""
    words = F.filter(F.split(F.lower("text"), SPACE), lambda w: w != "")
    held = inputs.withColumn("words", words)
    # sizes and amounts count by their logarithm; negative and unknown ones are 0
    amounts = {f"_a{i}": F.least(F.log1p(F.greatest(F.coalesce(F.nanvl(f"_m{i}", F.lit(0.0)), F.lit(0.0)), F.lit(0.0))) / 12, F.lit(2.0))
               for i in range(len(machine.metadata))}
    described = {f"_s{i}": c for i, c in enumerate(structure("words", "text").values())} | amounts
    rows = held.select(*keep, "words", *[c.cast("double").alias(name) for name, c in described.items()])
    counted = HashingTF(inputCol="words", outputCol="_counts", numFeatures=machine.buckets).transform(rows)
    scaled = Normalizer(inputCol="_counts", outputCol="_scaled", p=2.0).transform(counted)
    return VectorAssembler(inputCols=["_scaled", *described], outputCol="features").transform(scaled).select(*keep, "features")


def learn(docs: DataFrame, labels: DataFrame, machine: Machine = Machine()) -> Scorer:
    """Fit a machine to the labels (doc_id, quality) of documents that are not held out.

    Contradicting labels and others than 0 and 1 are left out. At most ``machine.rows``
    labelled ids are drawn by their hash, and of the rows of one id the one whose text has
    the smallest hash.
    """
    known = (
        take(labels, {"doc_id": "doc_id", "quality": "quality"})
        .select(F.col("doc_id").cast("long"), F.col("quality").cast("double"))
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("highest"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0) & (F.col("label") == F.col("highest")) & ~held_out())
        .select("doc_id", "label").join(take(docs, {"doc_id": "doc_id"}).select(F.col("doc_id").cast("long")), "doc_id", "left_semi")
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(machine.rows)
    )
    # bounded by the limit: ids and labels, no texts
    inputs = _inputs(docs, machine.metadata)
    found = inputs.join(F.broadcast(stage(known, "labels")), "doc_id")
    rest = [c for c in inputs.columns if c not in ("doc_id", "text")]
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", *rest)).alias("row")
    single = found.groupBy("doc_id", "label").agg(first).select("label", "row.text", *[f"row.{c}" for c in rest])
    rows = stage(features(single, machine, ["label"]), "classifier-rows")
    good, bad = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    prior = (good + 1) / (good + bad + 2)
    if not good or not bad:
        return Scorer(machine, None, prior)
    learner = FMClassifier(
        factorSize=machine.factors, maxIter=machine.rounds, stepSize=machine.step, regParam=machine.penalty, seed=machine.seed, tol=1e-5,
    )
    return Scorer(machine, learner.fit(rows.coalesce(machine.parts)), prior)


def score(docs: DataFrame, scorer: Scorer, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; predicted is 1 from ``least`` on.

    A null text is empty; empty texts have a score like any other. Rows without a doc_id
    are not held out. Repeated rows get equal scores. Columns other than doc_id, text
    and the metadata are ignored; an empty table gives no rows.
    """
    inputs = _inputs(docs, scorer.machine.metadata)
    if scorer.model is None:
        rows = inputs.select("doc_id", F.lit(scorer.prior).alias("score"))
    else:
        scored = scorer.model.transform(features(inputs, scorer.machine, ["doc_id"]))
        rows = scored.select("doc_id", vector_to_array("probability")[1].alias("score"))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, machine: Machine = Machine()) -> DataFrame:
    """Learn from the labels and score every row of ``docs``, as ``learn`` and ``score``."""
    return score(docs, learn(docs, labels, machine))
