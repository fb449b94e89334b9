"""Queries of the search layer that combine several searches, and of annotation and related headwords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_word
from ..operators import examples, lexicon, related, search
from ..runtime import cut, table
from . import sqltext as q
from .lexicon_queries import _ASKED, _E, _EDGES, _INFL, _KEYS, _TRAN, asked, edges, keys, lexicon_entries, rows
from .text_queries import _PAIRS, pairs

PATTERNS = ("^(pre|un)", "(^| )[a-e]+", "ing$", "^.{4}$")


def _forms(spark, directory):
    return cut(lexicon.inflection_index(rows(spark, directory)))


def _set_phrases(spark, directory):
    """Queries with a possessive before a headword, and the headwords with the set phrases that these would be."""
    queries = asked(spark, directory).withColumn("q", F.concat(F.lit("my "), "q"))
    known = keys(spark, directory)
    return queries, known.unionByName(known.select(F.concat(F.lit("one's "), "key").alias("key"), "rank"))


def search_set_phrases(spark, directory):
    """Set phrases of queries with a possessive."""
    return search.set_phrases(*_set_phrases(spark, directory))


def search_regex(spark, directory):
    """Headwords that each of some patterns matches, all in one pass."""
    return search.matching(list(PATTERNS), keys(spark, directory)).select("qid", "key")


def _translations(spark, directory):
    t = rows(spark, directory).where("translation is not null").select("key", normalize_word(F.col("translation")).alias("translation"))
    return t.where("translation != ''").distinct()


def search_reverse_list(spark, directory):
    """Headwords by translation, for lists of a translation and its beginning."""
    s = table(spark, directory, "senses").where("sense_id % 20 = 0 and translation is not null")
    t = normalize_word(F.col("translation"))
    queries = s.select(F.col("sense_id").alias("qid"), F.concat_ws(",", t, F.left(t, F.lit(2))).alias("q"))
    found = search.reverse_containing(queries, lexicon.translation_index(rows(spark, directory)), _translations(spark, directory))
    return found.withColumn("score", F.round("score", 9))


def _mixed(spark, directory):
    """Queries as they are, behind a possessive, within a phrase, with a letter lost, and translations."""
    w = asked(spark, directory)
    kind = F.col("qid") / 20 % 4
    phrase = F.when(kind == 0, F.col("q")).when(kind == 1, F.concat(F.lit("my "), "q")).when(kind == 2, F.concat(F.lit("the "), "q", F.lit(" of"))).otherwise(F.left("q", F.char_length("q") - 1))
    s = table(spark, directory, "senses").where("sense_id % 20 = 0 and translation is not null")
    japanese = s.select((-F.col("sense_id")).alias("qid"), normalize_word(F.col("translation")).alias("q"))
    return w.select("qid", phrase.alias("q")).unionByName(japanese)


def search_dispatch(spark, directory):
    """The first way of searching that answers a query, and its headwords."""
    known = cut(_set_phrases(spark, directory)[1])
    index = cut(lexicon.translation_index(rows(spark, directory)))
    return search.dispatch(_mixed(spark, directory), known, index, _translations(spark, directory), 10)


def search_popup(spark, directory):
    """What a pop-up shows of queries in the plural."""
    queries = asked(spark, directory).withColumn("q", F.concat("q", F.lit("s")))
    return search.popup(queries, cut(keys(spark, directory)), _forms(spark, directory))


def _word_spans(spark, directory):
    """The words of headwords of several words, in place: their other words are the context."""
    k = asked(spark, directory)
    words = F.split(F.concat(F.lit("the "), "q", F.lit(" of")), " ")
    return k.select("qid", words.alias("words")).select("qid", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))


def search_in_context(spark, directory):
    """Headwords around each word of queries within a phrase."""
    return search.in_context(_word_spans(spark, directory), keys(spark, directory), _forms(spark, directory))


def example_search_inflected(spark, directory):
    """Lines that hold a word of evaluation items or its regular plural, in any case."""
    items = table(spark, directory, "eval_items").where("item_id % 20 = 0 and text is not null")
    word = F.get(F.filter(F.split("text", r"[^\p{L}\p{N}_]+"), lambda w: F.char_length(w) >= 5), F.lit(0))
    queries = items.select(F.col("item_id").alias("qid"), F.lower(word).alias("q")).where("q is not null")
    return examples.search_examples(queries.withColumn("forms", F.array(F.concat("q", F.lit("s")))), pairs(spark, directory), "inflected")


def _annotated_entries(spark, directory):
    forms = lexicon.inflection_index(rows(spark, directory)).groupBy("key").agg(F.collect_set("form").alias("inflections"))
    children = edges(spark, directory).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    e = lexicon_entries(spark, directory).join(forms, "key", "left").join(children, "key", "left")
    return cut(e.withColumn("aoa", F.lit(None).cast("double")).withColumn("n_children", F.coalesce("n_children", F.lit(0))))


def annotate_items(spark, directory):
    """Headwords of the words of example texts: glosses of the senses whose id is divisible by 20, with their headword before them."""
    s = table(spark, directory, "senses").where("sense_id % 20 = 0 and word is not null")
    texts = s.select(F.col("sense_id").alias("id"), F.concat("word", F.lit("'s "), F.coalesce("text", F.lit("")), F.lit(". "), F.initcap("word"), F.lit("s")).alias("text"))
    found = search.annotate_text(texts, _annotated_entries(spark, directory), _forms(spark, directory))
    return found.withColumn("score", F.round("score", 9))


def _relations(spark, directory):
    """Entry relations as a search expands them: key, kind, place (from 0), label."""
    at = lambda by, o: (F.row_number().over(Window.partitionBy(by).orderBy(o)) - 1).alias("place")
    e = edges(spark, directory)
    down = e.select(F.col("parent").alias("key"), F.lit("related").alias("kind"), at("parent", "child"), F.col("child").alias("label"))
    up = e.select(F.col("child").alias("key"), F.lit("rephrase").alias("kind"), at("child", "parent"), F.col("parent").alias("label"))
    t = lexicon.translation_index(rows(spark, directory))
    best = (F.row_number().over(Window.partitionBy("key").orderBy(F.round("score", 12).desc(), "translation")) - 1).alias("place")
    return cut(down.unionByName(up).unionByName(t.select("key", F.lit("translation").alias("kind"), best, F.col("translation").alias("label"))))


def _poses(spark, directory):
    return rows(spark, directory).where("pos is not null and pos != ''").groupBy("key", "pos").agg(F.count("*").alias("n"))


def entry_features(spark, directory):
    """Features of headwords as the related search compares them."""
    return related.entry_features(_relations(spark, directory), _poses(spark, directory)).select("key", "label", F.round("weight", 6).alias("weight"))


def search_related(spark, directory):
    """Headwords related to the stated queries, by expansion from headword to headword."""
    r = _relations(spark, directory)
    f = cut(related.entry_features(r, _poses(spark, directory)))
    links = r.where("kind != 'translation'")
    shared = r.where("kind = 'translation'").select("key", "place", "label")
    found = related.expand(asked(spark, directory), f, links, shared)
    return found.select("qid", "key", F.round("score", 6).alias("score"), "place")


QUERIES = {
    f.__name__: f
    for f in (
        search_set_phrases, search_regex, search_reverse_list, search_dispatch, search_popup, search_in_context, example_search_inflected, annotate_items, entry_features, search_related,
    )
}

_K1 = "k1 as (select key, rank from k union all select 'one''s ' || key, rank from k)"
_EVAL_WORD = r"list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: len(w) >= 5)[1]"
_ANY_WORD = "(^|[^\\p{L}\\p{N}_])"
_REL = f"""
rel as (
  select parent as key, 1 as g, row_number() over (partition by parent order by child) - 1 as place, child as label from edges
  union all select child, 2, row_number() over (partition by child order by parent) - 1, parent from edges
  union all select key, 3, row_number() over (partition by key order by round(score, 12) desc, translation) - 1, translation from ti)"""

SQL = {
    "search_set_phrases": f"with {_KEYS}, {_ASKED}, {_K1} select qid, key, 0 as place from asked join k1 on key = 'one''s ' || q where len(string_split('my ' || q, ' ')) between 2 and 5",
    "search_regex": f"with {_E}, p(qid, p) as (values {', '.join(f'({n}, {q.quote(p)})' for n, p in enumerate(PATTERNS))}) select qid, key from e join p on regexp_matches(key, p)",
    "search_reverse_list": f"""
      with {_TRAN}, qs as (select sense_id as qid, {q.normalize_word('translation')} as t from senses where sense_id % 20 = 0 and translation is not null),
      w as (select distinct qid, trim(w) as w from (select qid, unnest(string_split(t || ',' || t[:2], ',')) as w from qs) where trim(w) <> ''),
      f as (select qid, key, max(score) as score from w join ti on ti.translation = w.w group by all)
      select qid, key, round(score, 9) as score from f where exists (from w join t on true where w.qid = f.qid and t.key = f.key and contains(t.translation, w.w))""",
    "search_popup": f"""
      with {_KEYS}, {_INFL}, {_ASKED}, p as (select qid, q || 's' as q from asked),
      f as (select qid, key, 0 as place from p join e on e.key = q
        union all select qid, key, (row_number() over (partition by qid order by round(score, 12) desc, key))::int from p join ii on form = q where key <> q),
      n as (select qid, key, (row_number() over (partition by qid order by levenshtein(q, key), rank))::int as place from p join k on abs(len(q) - len(key)) <= 2 and levenshtein(q, key) <= 2
        where qid not in (select qid from f) qualify place <= 10)
      select qid, key, place from f where place <= 10 union all select qid, key, place from n""",
    "search_in_context": f"""
      with {_E}, {_INFL}, {_ASKED}, s as (select qid, string_split('the ' || q || ' of', ' ') as w from asked),
      spot as (select qid, w, unnest(range(1, len(w) + 1)) as i from s),
      c as (select distinct * from (select qid, w, i, w[i] as core from spot union all select qid, w, i, ii.key from spot join ii on ii.form = w[i])),
      g as (select *, unnest(range(0, 4)) as a from c), h as (select *, unnest(range(0, 4)) as b from g),
      t as (select distinct qid, array_to_string(list_concat(w[i - a:i - 1], [core], w[i + 1:i + b]), ' ') as q from h where i - a >= 1 and i + b <= len(w))
      select distinct qid, key from t join e on e.key = t.q""",
    "example_search_inflected": f"""
      with {_PAIRS}, qs as (select item_id as qid, lower({_EVAL_WORD}) as q from eval_items where item_id % 20 = 0 and text is not null),
      f as (select qid, q from qs where q is not null union all select qid, q || 's' from qs where q is not null)
      select distinct qid, id from f join pairs on contains(lower(source), q) where case when contains(lower(source), q) then regexp_matches(lower(source), '{_ANY_WORD}' || q || '($|[^\\p{{L}}\\p{{N}}_])') end""",
    "entry_features": f"""
      with {_TRAN}, {_EDGES}, {_REL},
      p as (select key, '__' || pos as label, count(*) as n from r where pos is not null and pos <> '' group by all),
      base as (select distinct key, key as label from (select key from rel union select key from p)),
      lim as (select * from rel where place < (case g when 1 then 16 when 2 then 4 else 20 end) and label <> key),
      once as (select key, label, min(g * 1000 + place) as o from lim group by all),
      num as (select key, label, o // 1000 as g, row_number() over (partition by key order by o) as i, count(*) filter (where o < 3000) over (partition by key) as early from once),
      f as (select key, label, 1.0::double as w from base
        union all select key, label, case when g < 3 then pow(0.95::double, i) else greatest(pow(0.95::double, early), 0.4) * pow(0.95::double, i - early) end from num
        union all select key, label, n::double / max(n) over (partition by key) from p)
      select key, label, round(max(w), 6) as weight from f group by all""",
}
