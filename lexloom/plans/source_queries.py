"""Queries that read the formats: lines made of a table's columns, read as a file's lines are."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.phonetic import sampa_to_ipa
from ..functions.text import clean_sentence, is_safe_text, key_prefix, normalize_word
from ..operators import examples, lexicon
from ..runtime import table
from ..sources import readers
from . import sqltext as q
from .lexicon_queries import _E, _R, rows


def _part(spark, directory):
    return table(spark, directory, "part")


def _line(*columns):
    return F.concat_ws("\t", *columns).alias("value")


def read_sense_fields(spark, directory):
    """Fields of sense lines, of one name joined in order."""
    first = _part(spark, directory).groupBy("p_name").agg(F.min(F.struct("p_partkey", "p_type", "p_brand")).alias("r")).select("p_name", "r.*")
    lines = first.select(_line(F.concat(F.lit("word="), "p_name"), F.concat(F.lit("noun="), "p_type"), F.concat(F.lit("synonym="), "p_brand"), F.lit("junk"), F.concat(F.lit("synonym="), "p_name")))
    return readers.field_rows(readers.senses(lines)).select("key", "word", "name", F.array_join("values", ", ").alias("value"))


def read_related_fields(spark, directory):
    """Relation fields of sense lines."""
    lines = _part(spark, directory).groupBy("p_brand").agg(F.min("p_name").alias("a"), F.max("p_name").alias("b")).select(_line(F.concat(F.lit("word="), "p_brand"), F.concat(F.lit("synonym="), "a"), F.concat(F.lit("synonym="), "b"), F.concat(F.lit("antonym="), "b")))
    return readers.related_fields(readers.senses(lines)).select("key", "name", "value")


def read_listed_values(spark, directory):
    """Values of a word in fields of a line, repeats left out."""
    lines = _part(spark, directory).select(_line(F.col("p_partkey").cast("string"), *(F.get(F.split("p_name", " "), F.lit(i)) for i in range(3)), F.upper(F.get(F.split("p_name", " "), F.lit(0)))))
    return readers.listed_values(lines).select("key", F.array_join("values", "|").alias("values"))


def read_ages(spark, directory):
    """Ages of acquisition from lines of ratings, averaged."""
    lines = _part(spark, directory).select(F.concat_ws(",", "p_brand", F.lit("a"), F.lit("b"), F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 3 == 0, "").otherwise("2.5"), F.lit("x")).alias("value"))
    return readers.acquisition_ages(lines).select("key", F.round("aoa", 9).alias("aoa"))


def read_parallel(spark, directory):
    """Parallel lines of four fields; others are left out."""
    lines = _part(spark, directory).select(F.when(F.col("p_partkey") % 7 == 0, _line("p_brand", "p_name")).otherwise(_line("p_brand", F.lit("0.5"), "p_name", "p_type")).alias("value"))
    return readers.parallel_corpus(lines).groupBy("domain").agg(F.count("*").alias("n"), F.sum("score").alias("score"), F.min("source").alias("source"), F.max("target").alias("target"))


def read_tokenised(spark, directory):
    """Documents of tokenised lines: sentences and words."""
    lines = _part(spark, directory).select(F.col("p_partkey").alias("doc"), _line("p_name", F.lit(" "), "p_type"))
    s = readers.tokenised_lines(lines)
    return s.select("doc", F.size("sentences").alias("n_sentences"), F.size(F.flatten("sentences")).alias("n_words"))


def read_hints(spark, directory):
    """Hints at parts of speech."""
    lines = _part(spark, directory).select(_line("p_name", F.lit("noun, verb"), F.col("p_size").cast("string")))
    return readers.hints(lines).groupBy("key").agg(F.count("*").alias("n"), F.sum("prob").alias("prob"))


def read_pronunciations(spark, directory):
    """Pronunciations, one for each word."""
    lines = table(spark, directory, "entry_records").where("pronunciation is not null and word is not null").select(_line(F.regexp_replace("word", r"\s+", " "), "pronunciation"))
    return readers.pronunciations(lines).select("word", "ipa")


def read_keywords(spark, directory):
    """Keywords, one a line."""
    return readers.keyword_list(table(spark, directory, "word_links").select(F.col("word").alias("value")))


def sampled_documents(spark, directory):
    """A tenth of the documents by a seeded digest."""
    return readers.sample(table(spark, directory, "documents").select("doc_id"), "doc_id", 0.1)


def sampa_words(spark, directory):
    """Words read as if they were X-SAMPA."""
    return _part(spark, directory).select("p_partkey", sampa_to_ipa(F.regexp_replace("p_name", " ", "_")).alias("ipa"))


def clean_lines(spark, directory):
    """Senses without bullets, and whether any reader shows them."""
    s = table(spark, directory, "senses").where("text is not null")
    return s.select("sense_id", clean_sentence(F.concat(F.lit("・ "), "text")).alias("text"), is_safe_text(F.col("text")).alias("safe"), key_prefix(normalize_word(F.col("word"))).alias("prefix"))


def full_translation_index(spark, directory):
    """Headwords of translations and of phrases' translations, with short forms, weighted by age of acquisition and place."""
    r = rows(spark, directory)
    phrases = lexicon.sense_rows(table(spark, directory, "entry_records")).where("translation is not null").select("key", "translation")
    ages = r.select("key").distinct().where(F.char_length("key") % 2 == 0).select("key", (F.char_length("key") + 0.0).alias("aoa"))
    return lexicon.full_translation_index(r, phrases, ages).select("translation", "key", F.round("score", 12).alias("score"))


def highlighted(spark, directory):
    """Parallel lines with evaluation items' words in brackets."""
    from .text_queries import _queries, pairs

    p = pairs(spark, directory)
    found = examples.search_examples(_queries(spark, directory), p, "any").join(_queries(spark, directory), "qid").join(p, "id")
    return found.select("qid", "id", examples.highlight(F.col("source"), F.array("q")).alias("source"))


QUERIES = {
    f.__name__: f
    for f in (
        read_sense_fields, read_related_fields, read_listed_values, read_ages, read_parallel, read_tokenised, read_hints, read_pronunciations, read_keywords, sampled_documents, sampa_words,
        clean_lines, full_translation_index, highlighted,
    )
}

_SHORT = (
    (r"([\p{Han}\p{Katakana}ー]{2,})(する|すること|される|されること|をする)$", 1),
    (r"([\p{Han}\p{Katakana}ー]{2,})(的|的な|的に)$", 2),
    (r"([\p{Han}]{2,})(が|の|を|に|へ|と|より|から|で|や|な|なる|たる)$", 3),
)
_SHORT_SQL = " union all ".join(f"select key, g, place, {sub} as sub, regexp_replace(translation, '{p}', '\\1') as translation, w * 0.8 as w from c0 where regexp_matches(translation, '{p}')" for p, sub in _SHORT)

SQL = {
    "read_sense_fields": f"""
      with o as (select p_name, p_type, p_brand from part qualify row_number() over (partition by p_name order by p_partkey) = 1)
      select {q.normalize_word('p_name')} as key, p_name as word, 'noun' as name, p_type as value from o union all select {q.normalize_word('p_name')}, p_name, 'synonym', p_brand || ', ' || p_name from o""",
    "read_related_fields": f"""
      with b as (select p_brand, min(p_name) as a, max(p_name) as b from part group by all)
      select {q.normalize_word('p_brand')} as key, 'synonym' as name, a || ', ' || b as value from b union all select {q.normalize_word('p_brand')}, 'antonym', b from b""",
    "read_listed_values": f"""
      with w as (select p_partkey, string_split(p_name, ' ')[1:3] as w from part), v as (select p_partkey, list_append(list_filter(w, lambda x: x is not null), upper(w[1])) as v from w),
      k as (select p_partkey, v, list_transform(v, lambda x: {q.normalize_word('x')}) as n from v)
      select p_partkey::varchar as key, array_to_string(list_filter(v, lambda x, i: list_position(n, n[i]) = i), '|') as "values" from k""",
    "read_ages": f"select {q.normalize_word('p_brand')} as key, round(avg(p_size + case when p_size % 3 = 0 then 3.0 else 2.5 end), 9) as aoa from part group by all",
    "read_parallel": "select p_brand as domain, count(*) as n, sum(0.5::double) as score, min(p_name) as source, max(p_type) as target from part where p_partkey % 7 <> 0 group by all",
    "read_tokenised": "select p_partkey as doc, 2::int as n_sentences, (len(list_filter(string_split(p_name, ' '), lambda w: w <> '')) + len(list_filter(string_split(p_type, ' '), lambda w: w <> '')))::int as n_words from part",
    "read_hints": f"select {q.normalize_word('p_name')} as key, count(*) as n, sum(p_size)::double as prob from part group by all",
    "read_pronunciations": f"select w as word, min(ipa) as ipa from (select {q.trim(q.chain('word', [(chr(92) + 's+', ' ')]))} as w, {q.trim('pronunciation')} as ipa from entry_records where pronunciation is not null and word is not null) where w <> '' and ipa <> '' group by all",
    "read_keywords": f"select distinct {q.normalize_word('word')} as key from word_links where {q.normalize_word('word')} <> ''",
    "sampled_documents": "select doc_id from documents where ('0x' || left(md5('19780211|' || doc_id), 8))::bigint % 1000000 < 100000",
    "clean_lines": f"""
      select sense_id, {q.trim(q.chain(q.chain(q.trim("'・ ' || text"), [('^[・*-]+ *', '')]), [(q.SPACES, ' ')]))} as text,
        not regexp_matches(text, '[^\\x20-\\x7F\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}ー・、。々]') and not regexp_matches(text, '[\\\\{{}}`]') as safe,
        case when regexp_matches({q.normalize_word('word')}, '^[a-z]') then {q.normalize_word('word')}[1] else '_' end as prefix
      from senses where text is not null""",
    "full_translation_index": f"""
      with {_R}, {_E[len(_R) + 2:]},
      a as (select key, len(key)::double as aoa from e where len(key) % 2 = 0),
      t as (select key, translation, max(prob) as own from r where translation is not null group by all),
      p2 as (select distinct {q.normalize_word('word')} as key, translation from entry_records where translation is not null),
      c0 as (select key, 0 as g, row_number() over (partition by key order by own desc, translation) as place, 0 as sub, translation, 1.0 as w from t
        union all select p2.key, 1, row_number() over (partition by p2.key order by p2.translation), 0, p2.translation, 0.5 from p2 join e on e.key = p2.key),
      c as (select * from c0 union all {_SHORT_SQL}),
      n as (select key, {q.normalize_word('translation')} as translation, g, place, sub, w from c),
      f as (select * from n where translation <> '' qualify row_number() over (partition by key, translation order by g, place, sub) = 1),
      o as (select *, row_number() over (partition by key order by g, place, sub) - 1 as i from f)
      select translation, o.key, round(e.prob * (30 - least(coalesce(aoa, 20), 20)) / 10 * w * pow(0.98::double, i), 12) as score from o join e on e.key = o.key left join a on a.key = o.key""",
}
