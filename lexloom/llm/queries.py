"""Registered queries on texts for training corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import word_key, word_key_udf
from ..runtime import cut, table
from .charforms import same_look, unify
from .consensus import consensus
from .leak import find_leaks
from .spans import shared_spans
from .tokens import encode


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """Pairs of senses whose words, translations or glosses look the same in different characters."""
    return same_look(table(spark, directory, "senses"), "sense_id", ["word", "translation", "text"])


def _plain(column: str) -> Column:
    """Letter case and outer blanks aside."""
    return F.lower(F.regexp_replace(column, r"^[\s\p{Z}\p{C}]+|[\s\p{Z}\p{C}]+$", ""))


def survivors(records: DataFrame, trusts: DataFrame, how: str = "precedence") -> DataFrame:
    """For each group of two or more records of one headword and part of speech the records that give its best values.

    A missing part of speech is a value of its own; records without a headword are in no group. A value without a letter or
    digit is none; -1 where a group has none. Labels without a trust, and missing ones, have 0. `how` is the rule of `consensus`.
    """
    undotted = F.regexp_replace("word", "[・·･]+", "")  # as in key form, where they don't part a word
    united = unify(records.select(F.col("record_id").alias("row_key"), undotted.alias("value")), word_key)
    keys = united.select(F.col("row_key").alias("record_id"), word_key_udf("unified").alias("head")).where("head != ''")
    trust = trusts.select(_plain("label").alias("label_key"), "trust").groupBy("label_key").agg(F.max("trust").alias("trust"))
    told = (
        records.select("record_id", F.coalesce(_plain("pos"), F.lit("")).alias("pos_key"), _plain("label").alias("label_key"), "text", "pronunciation", "translation", F.col("updated_at").cast("string").alias("stamp"))
        .join(trust, "label_key", "left")
        .join(keys, "record_id")
        .withColumn("trust", F.coalesce("trust", F.lit(0)).cast("int"))
    )
    told = cut(told)  # read by the groups and by their members
    groups = told.groupBy("head", "pos_key").agg(F.min("record_id").alias("group_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("text", "pronunciation", "translation"))))
    candidates = (
        told.join(groups, ["head", "pos_key"])
        .select("group_id", fields.alias("f"), "trust", "stamp", F.col("record_id").alias("id"))
        .select("group_id", "f.field", "f.value", "trust", "stamp", "id")
        .where(F.col("value").rlike(r"[\p{L}\p{N}]"))
    )
    best = consensus(candidates, how).groupBy("group_id").pivot("field", ["text", "pronunciation", "translation"]).agg(F.max("survivor"))
    none = F.lit(-1).cast("bigint")
    return groups.select("group_id").join(best, "group_id", "left").select(
        "group_id", F.coalesce("text", none).alias("text_from"), F.coalesce("pronunciation", none).alias("pron_from"), F.coalesce("translation", none).alias("tran_from")
    )


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """The records that give the surviving text, pronunciation and translation of each group of duplicate headwords.

    TESTDATA.md orders the records of a group strictly, so the first with a value gives it; no value is aligned or voted on.
    """
    return survivors(table(spark, directory, "entry_records"), table(spark, directory, "label_trust"), "precedence")


def consensus_records(spark: SparkSession, directory: str) -> DataFrame:
    """The same by consensus: all values of a group are aligned, tokens voted on, and the value closest to the winners survives."""
    return survivors(table(spark, directory, "entry_records"), table(spark, directory, "label_trust"), "sum")


def p6_ids(spark: SparkSession, directory: str) -> DataFrame:
    """The ids of every document by a public byte-level tokenizer."""
    return encode(table(spark, directory, "documents"), "doc_id", "text").select("doc_id", "ids")


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents that hold thirteen consecutive words of an evaluation item.

    TESTDATA.md counts verbatim passages only, so words are compared as they are; `leak_kinds` has the exchanged ones too.
    """
    return find_leaks(table(spark, directory, "documents"), table(spark, directory, "eval_items"))


def leak_kinds(spark: SparkSession, directory: str) -> DataFrame:
    """Leaked pairs (doc_id, item_id) by kind: 'verbatim' passages, and 'exchanged' ones, whose numbers, units or names are others.

    A pair with passages of both kinds has a row for each.
    """
    documents, items = table(spark, directory, "documents"), table(spark, directory, "eval_items")
    verbatim, exchanged = (find_leaks(documents, items, exchanged=e).withColumn("kind", F.lit(k)) for k, e in (("verbatim", False), ("exchanged", True)))
    return verbatim.unionByName(exchanged)


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    """The characters of each document that stand in a long span of another."""
    return shared_spans(table(spark, directory, "documents"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p6_ids": p6_ids, "p7_found": p7_found, "p8_found": p8_found, "consensus_records": consensus_records, "leak_kinds": leak_kinds}
SQL: dict[str, str] = {}
