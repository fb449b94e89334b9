"""The key form of words, the join key of the lexicon."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

_SPACE = re.compile(r"\s+")
_DOTS = re.compile("[・·]+")


def strip_latin_marks(text: str) -> str:
    """Drop the combining marks of Latin letters; other scripts keep theirs (ガ stays ガ)."""
    if text.isascii():
        return text
    out, latin = [], False
    for ch in unicodedata.normalize("NFD", text):
        if unicodedata.category(ch) != "Mn":
            latin = unicodedata.name(ch, "").startswith("LATIN")
        elif latin:
            continue
        out.append(ch)
    return unicodedata.normalize("NFC", "".join(out))


def word_key(text: str) -> str:
    """Blanks collapsed, middle dots dropped, lower case, Latin diacritics stripped, trimmed."""
    return strip_latin_marks(_DOTS.sub("", _SPACE.sub(" ", text)).lower()).strip()


def _word_keys(words: pd.Series) -> pd.Series:
    return words.map(word_key, na_action="ignore")


def word_key_udf(column) -> Column:
    """`word_key` over Arrow batches; null stays null."""
    return pandas_udf(_word_keys, StringType())(column)


def linked_keys(links: DataFrame, word_col: str = "word", parent_col: str = "parent", child_col: str = "child") -> DataFrame:
    """Rows (child, parent) in key form from rows with a word and its lists of parents and children; parent null names a word only.

    A link told by both sides comes once. Null, empty and blank words and members are passed over.
    """
    none = F.lit(None).cast("string")
    word = F.col(word_col)
    told = (
        links.select(word.alias("child"), none.alias("parent"))
        .unionByName(links.select(word.alias("child"), F.explode(parent_col).alias("parent")))
        .unionByName(links.select(F.explode(child_col).alias("child"), word.alias("parent")))
    )
    keyed = told.select(word_key_udf("child").alias("child"), F.nullif(word_key_udf("parent"), F.lit("")).alias("parent"))
    alone = keyed.where("child is null or child = ''").select(F.col("parent").alias("child"), none.alias("parent"))
    return keyed.unionByName(alone).where("child is not null and child != ''").distinct()


def blank_to_null(column: Column) -> Column:
    return F.when(F.trim(column) != "", column)
