"""Readers of the formats that lexicons and corpora come in, and the matching writers.

Lines that don't have the form of their source are left out, as the sources' own readers do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import collapse, nfkc, normalize_text, normalize_word, sub, trim

# Fixed value: the greatest length of a headword.
MAX_WORD = 48
# The first sign of a pointer of a WordNet data file and its name; adverbs derive where adjectives pertain.
POINTERS = {
    "!": "antonym", "@": "hypernym", "~": "hyponym", "=": "attribute", "+": "derivative", "*": "entailment", ">": "cause", "^": "seealso", "$": "group", "&": "similar", "<": "perticiple",
    "\\": "pertainym",
}
# The letters of parts of speech, by which the files are told too.
PARTS_OF_SPEECH = {"n": "noun", "v": "verb", "a": "adjective", "s": "adjective", "r": "adverb"}

PAGE_SCHEMA = StructType(
    [
        StructField("title", StringType()),
        StructField("redirect", StringType()),
        StructField("restrictions", StringType()),
        StructField("revision", StructType([StructField(n, StringType()) for n in ("model", "format", "text")])),
    ]
)


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """title, text of the articles of a MediaWiki dump: no redirects, no restricted pages, wiki text only.

    Files are split at page elements, so a dump of many parts is read in parallel.
    """
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE_SCHEMA).load(path)
    plain = (F.col("revision.model") == "wikitext") & (F.col("revision.format") == "text/x-wiki") & (F.col("revision.text") != "")
    return pages.where(F.col("redirect").isNull() & F.col("restrictions").isNull() & plain).select("title", F.col("revision.text").alias("text"))


def sample(df: DataFrame, id_col: str, ratio: float, most: int | None = None, seed: int = 19780211) -> DataFrame:
    """Rows chosen by a seeded digest of their id, the same on every cluster; `most` rows at most."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    chosen = df.where(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint") % 1_000_000 < int(ratio * 1_000_000))
    return chosen.limit(most) if most is not None else chosen


def tokenised_lines(lines: DataFrame, cap: int | None = None) -> DataFrame:
    """The columns of `lines` but value, sentences array<array<string>>: a document a line (column value), sentences parted by tabs,
    words by blanks; `cap` cuts documents; lines without a word are left out."""
    words = lambda s: F.filter(F.split(s, " "), lambda w: w != "")
    parts = F.split("value", "\t")
    sentences = F.filter(F.transform(F.slice(parts, 1, cap) if cap is not None else parts, words), lambda w: F.size(w) > 0)
    return lines.withColumn("sentences", sentences).drop("value").where(F.size("sentences") > 0)


def tokenised_documents(spark: SparkSession, path: str, cap: int | None = None) -> DataFrame:
    """doc (file order), sentences of a file of tokenised documents."""
    return tokenised_lines(spark.read.text(path).select(F.monotonically_increasing_id().alias("doc"), "value"), cap)


def sense_fields(line: Column) -> Column:
    """The name=value fields of a line in order, values in compatibility form: array<struct<name, value>>; names may repeat."""
    named = F.filter(F.split(normalize_text(line), "\t"), lambda f: F.contains(f, F.lit("=")))
    return F.transform(named, lambda f: F.struct(F.substring_index(f, "=", 1).alias("name"), collapse(F.substring(f, F.instr(f, "=") + 1, F.char_length(f))).alias("value")))


def senses(lines: DataFrame, slim: bool = False) -> DataFrame:
    """word, key, fields of a sense file's lines (column value); words too long or without any content are left out.

    `slim` cuts each text at its first section mark.
    """
    fields = lines.select(sense_fields(F.col("value")).alias("fields"))
    if slim:
        fields = fields.select(F.transform("fields", lambda f: F.struct(f["name"].alias("name"), sub(f["value"], r" *\[-+\].*").alias("value"))).alias("fields"))
    word = F.filter("fields", lambda f: f["name"] == "word")
    named = fields.withColumn("word", F.when(F.size(word) > 0, word[0]["value"])).withColumn("fields", F.filter("fields", lambda f: (f["name"] != "word") & (f["value"] != "")))
    good = named.where(F.col("word").isNotNull() & (F.col("word") != "") & (F.char_length("word") <= MAX_WORD) & (F.size("fields") > 0))
    return good.select("word", normalize_word(F.col("word")).alias("key"), "fields")


def field_rows(senses_frame: DataFrame) -> DataFrame:
    """key, word, name, values: repeated fields of one name joined in order."""
    each = senses_frame.select("key", "word", F.posexplode("fields").alias("at", "f"))
    ordered = F.array_sort(F.collect_list(F.struct("at", F.col("f.value").alias("v"))))
    return each.groupBy("key", "word", F.col("f.name").alias("name")).agg(F.transform(ordered, lambda x: x["v"]).alias("values"))


# The fields that name related words.
RELATIONS = "synonym hypernym hyponym antonym derivative relation".split()


def related_fields(senses_frame: DataFrame) -> DataFrame:
    """key, word, name, value: the fields of related words, those of one name joined by ', ' in order."""
    rows = field_rows(senses_frame).where(F.col("name").isin(RELATIONS))
    return rows.select("key", "word", "name", F.array_join("values", ", ").alias("value"))


def listed_values(lines: DataFrame) -> DataFrame:
    """key, values: a word and its values in tab-separated fields, repeats in key form left out, order kept."""
    f = lines.select(F.split("value", "\t").alias("f")).where(F.size("f") >= 2)
    values = F.filter(F.slice("f", F.lit(2), F.size("f")), lambda v: trim(v) != "")
    keys = F.transform("values", normalize_word)
    once = F.filter("values", lambda v, i: F.array_position(keys, normalize_word(v)) == i + 1)
    cut = f.select(normalize_word(F.get("f", F.lit(0))).alias("key"), F.transform(values, trim).alias("values")).where("key != ''")
    return cut.select("key", once.alias("values")).where(F.size("values") > 0)


def hints(lines: DataFrame) -> DataFrame:
    """key, surface, poses, prob: hints at the parts of speech of a surface, in three fields; others are left out."""
    f = lines.select(F.split(trim(F.col("value")), "\t").alias("f")).where(F.size("f") == 3)
    poses = F.filter(F.transform(F.split(F.get("f", F.lit(1)), ","), trim), lambda p: p != "")
    return f.select(normalize_word(F.get("f", F.lit(0))).alias("key"), F.get("f", F.lit(0)).alias("surface"), poses.alias("poses"), F.get("f", F.lit(2)).try_cast("double").alias("prob"))


def pronunciations(lines: DataFrame) -> DataFrame:
    """key, word, ipa of lines of two fields; of several lines for a word the first in order of the sound counts."""
    f = lines.select(F.split(trim(F.col("value")), "\t").alias("f")).where(F.size("f") == 2)
    rows = f.select(trim(F.get("f", F.lit(0))).alias("word"), trim(F.get("f", F.lit(1))).alias("ipa")).where("word != '' and ipa != ''")
    return rows.groupBy("word").agg(F.min("ipa").alias("ipa")).select(normalize_word(F.col("word")).alias("key"), "word", "ipa")


def keyword_list(lines: DataFrame) -> DataFrame:
    """key: one keyword a line, in key form, each once."""
    return lines.select(normalize_word(F.col("value")).alias("key")).where("key != ''").distinct()


def page_count(pages: DataFrame) -> DataFrame:
    """n_pages of a frame of wiki pages, a single row."""
    return pages.agg(F.count("*").alias("n_pages"))


def parallel_corpus(lines: DataFrame) -> DataFrame:
    """domain, score, source, target of lines with exactly four fields, in compatibility form."""
    f = lines.select(F.split(trim(nfkc(F.col("value"))), "\t").alias("f")).where(F.size("f") == 4)
    return f.select(F.get("f", F.lit(0)).alias("domain"), F.try_to_number(F.get("f", F.lit(1)), F.lit("S999999999.999999999")).cast("double").alias("score"), F.get("f", F.lit(2)).alias("source"), F.get("f", F.lit(3)).alias("target"))


def acquisition_ages(lines: DataFrame) -> DataFrame:
    """key, aoa: mean plus deviation (3.0 where it is missing) of seven-column ratings, averaged over all files."""
    f = lines.select(F.split("value", ",").alias("f")).where(F.size("f") == 7)
    number = lambda i: F.when(F.trim(F.get("f", F.lit(i))).rlike(r"^\d+(\.\d+)?$"), F.trim(F.get("f", F.lit(i))).cast("double"))
    rated = f.select(normalize_word(F.get("f", F.lit(0))).alias("key"), number(3).alias("occur"), number(4).alias("mean"), number(5).alias("deviation")).where("key != '' and mean is not null")
    return rated.groupBy("key").agg(F.avg(F.col("mean") + F.coalesce("deviation", F.lit(3.0))).alias("aoa"))


def synsets(lines: DataFrame) -> DataFrame:
    """synset_id, pos, words, gloss, pointers array<struct<type, target>> of a WordNet data file (column value).

    Comment lines and lines without exactly one gloss are left out, the count of words is hexadecimal, underscores stand for
    blanks, brackets in words are dropped. Holonyms, meronyms and the pointers to topics, regions and usages are no relations here.
    """
    sides = F.split(trim(F.col("value")), r" \| ")
    rows = lines.where(~F.startswith("value", F.lit(" "))).where(F.size(sides) == 2).select(F.split(sides[0], " ").alias("f"), trim(sides[1]).alias("gloss"))
    rows = rows.where((F.size("f") >= 6) & F.get("f", F.lit(0)).rlike(r"^\d{8}$") & (F.col("gloss") != ""))
    counted = rows.withColumn("n", F.conv(F.get("f", F.lit(3)), 16, 10).cast("int")).withColumn("p", F.get("f", F.col("n") * 2 + 4).cast("int"))
    word = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: trim(sub(F.replace(F.get("f", i * 2 + 4), F.lit("_"), F.lit(" ")), r"\(.*?\)")))
    at = lambda i, k: F.get("f", F.col("n") * 2 + 5 + i * 4 + k)
    named = lambda values: F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    letter = F.get("f", F.lit(2))
    kind = named(PARTS_OF_SPEECH)[letter]
    symbol = lambda i: F.when((F.substring(at(i, 0), 1, 1) == "\\") & (kind == "adverb"), "derivative").otherwise(named(POINTERS)[F.substring(at(i, 0), 1, 1)])
    pointer = F.when(F.col("p") > 0, F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda i: F.struct(symbol(i).alias("type"), F.concat(at(i, 1), F.lit("-"), at(i, 2)).alias("target"))))
    file = F.translate(letter, "s", "a")
    return counted.select(F.concat(F.get("f", F.lit(0)), F.lit("-"), file).alias("synset_id"), kind.alias("pos"), word.alias("words"), "gloss", F.filter(F.coalesce(pointer, F.array()), lambda x: x["type"].isNotNull()).alias("pointers"))


def synset_relations(synsets_frame: DataFrame) -> DataFrame:
    """word, type, related: the words of the synsets that a word's synsets point to."""
    edge = synsets_frame.select("words", F.explode("pointers").alias("p")).select("words", "p.type", F.col("p.target").alias("synset_id"))
    reached = edge.join(synsets_frame.select("synset_id", F.col("words").alias("others")), "synset_id")
    return reached.select(F.explode("words").alias("word"), "type", "others").select("word", "type", F.explode("others").alias("related")).where("word != related").distinct()


def valid_entries(bodies: DataFrame) -> DataFrame:
    """key, problem of entries to be stored: null where an entry has a word and only items with label, pos and text."""
    schema = "array<struct<word:string,item:array<struct<label:string,pos:string,text:string>>>>"
    parsed = bodies.select("key", F.explode_outer(F.from_json("body", schema)).alias("e"))
    no = lambda f: F.exists("e.item", lambda i: F.coalesce(i[f], F.lit("")) == "")
    problem = F.when(F.col("e").isNull(), "no entry").when(F.coalesce(F.col("e.word"), F.lit("")) == "", "no word").when(F.coalesce(F.size("e.item"), F.lit(0)) <= 0, "no item")
    return parsed.select("key", problem.when(no("label"), "no label").when(no("pos"), "no pos").when(no("text"), "no text").alias("problem"))


def write_lines(df: DataFrame, path: str, *columns: str) -> None:
    """Tab-separated lines of the columns; nulls are empty."""
    df.select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, key: str) -> None:
    """A key table: Parquet dealt and sorted by key, so that a look-up prunes by its row groups' bounds."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def look_up(spark: SparkSession, path: str, key: str, begin: str, end: str | None = None) -> DataFrame:
    """Rows of a key table at a key, or in [begin, end)."""
    rows = spark.read.parquet(path)
    return rows.where(F.col(key) == begin) if end is None else rows.where((F.col(key) >= begin) & (F.col(key) < end))
