"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import binary, chat, classifier, fim, licences, mixing, packing, quality, sharding, simhash, spelling, vectors, warc
from clickloom.llm.frames import read, take
from clickloom.session import stage

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = 50_257
SHARD_BYTES = 1 << 20
MIX = mixing.MixTarget(repetitions=2.0)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents"), MIX)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"), licences.EVERY).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.round_trip(read(spark, sf_dir, "documents"), TOKENIZER, VOCABULARY)


def conversation_records(turns: DataFrame) -> DataFrame:
    """Conversations as records of six layouts, by their shape and the parity of their id.

    A user and an assistant turn are a prompt and a response, or an instruction and its
    output; with a system turn in front a prompt with a system field; two user turns and
    an assistant turn an instruction with an input. All others are lists of messages or,
    with other role names, of conversations. Every record fits exactly one layout. Null roles
    and texts are empty; turns with equal numbers are ordered by role and text.
    """
    rows = take(turns, {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"}).select(
        F.col("conv_id").cast("long"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"),
        ).alias("m"),
    )
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    roles = F.transform("m", lambda x: x["role"])
    shape = lambda *names: roles == F.array(*map(F.lit, names))
    odd = F.coalesce(F.pmod("conv_id", F.lit(2)) == 1, F.lit(False))
    pair = shape("user", "assistant")
    plain, instruction = pair & ~odd, pair & odd
    system, with_input = shape("system", "user", "assistant"), shape("user", "user", "assistant")
    listed = ~(pair | system | with_input)
    # a list that has the other names itself keeps its own
    renamed = listed & odd & ~F.exists("m", lambda x: x["role"].isin("human", "gpt"))
    content = lambda i: F.get("m", F.lit(i))["content"]
    messages = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    other = lambda role: F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    conversations = F.transform("m", lambda x: F.struct(other(x["role"]).alias("from"), x["content"].alias("value")))
    return lists.select(
        "conv_id",
        F.when(listed & ~renamed, messages).alias("messages"),
        F.when(renamed, conversations).alias("conversations"),
        F.when(system, content(0)).alias("system"),
        F.when(plain, content(0)).when(system, content(1)).alias("prompt"),
        F.when(plain, content(1)).when(system, content(2)).alias("response"),
        F.when(instruction | with_input, content(0)).alias("instruction"),
        F.when(with_input, content(1)).alias("input"),
        F.when(instruction, content(1)).when(with_input, content(2)).alias("output"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = take(read(spark, sf_dir, "conversations"), {c: c for c in ("conv_id", "turn", "role", "text")})
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said,
    )
    turns = chat.canonical(conversation_records(given.union(more)), "conv_id")
    found = chat.parsed(stage(chat.formatted(turns), "chat"))
    learnt = F.array_join("loss", "")
    said_turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        F.col("key").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_turns, ""), 256).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents"), SHARD_BYTES)


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"), least=0.93)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, distance=3)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.round_trip(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_licences, op3_warc, op4_token_files, op5_chat, op6_sharding, op7_vectors, op8_packing, op9_quality_rules,
        op10_simhash, op11_spelling, op12_quality_classifier, op13_fill_in_middle,
    )
}
