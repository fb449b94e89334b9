"""Queries over packed, nested and linked records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.keys import linked_keys
from ..operators.forest import hierarchy
from ..operators.nested import lexicon_nodes
from ..operators.packed import split_packed
from ..runtime import table


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """Every member of the list sections of the senses."""
    return split_packed(table(spark, directory, "senses"), "sense_id", "text").select("sense_id", "attr", "value_no", "val")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """Items, phrases and phrase translations of the dictionary bodies."""
    return lexicon_nodes(table(spark, directory, "union_body"))


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """The place of every word in the forest of parents and children."""
    return hierarchy(linked_keys(table(spark, directory, "word_links")))


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p5_found": p5_found}
SQL: dict[str, str] = {}
