"""Queries over the merged lexicon of senses and entry records, and its search layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_word
from ..operators import lexicon, search
from ..operators.corpus import english, sentence_tokens, sentence_total, word_counts
from ..operators.tokenize import tokens
from ..runtime import cut, table
from . import sqltext as q


def rows(spark: SparkSession, directory: str) -> DataFrame:
    return lexicon.sense_rows(table(spark, directory, "senses"))


def records(spark: SparkSession, directory: str) -> DataFrame:
    return lexicon.sense_rows(table(spark, directory, "entry_records"))


def edges(spark: SparkSession, directory: str) -> DataFrame:
    """child, parent in key form, told by either side."""
    links = table(spark, directory, "word_links")
    up = links.select(normalize_word(F.col("word")).alias("child"), F.explode("parent").alias("parent")).select("child", normalize_word(F.col("parent")).alias("parent"))
    down = links.select(normalize_word(F.col("word")).alias("parent"), F.explode("child").alias("child")).select(normalize_word(F.col("child")).alias("child"), "parent")
    return up.unionByName(down).where("child != '' and parent != ''").distinct()


def keywords(spark, directory):
    """Headwords of the parent and child lists."""
    return table(spark, directory, "word_links").select(normalize_word(F.col("word")).alias("key")).where("key != ''").distinct()


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def lexicon_merge(spark, directory):
    """Senses and records merged by key and label, with shares of the text."""
    return _rounded(lexicon.merge_sources(rows(spark, directory), records(spark, directory)), "text_score", "share", digits=6)


def lexicon_entries(spark, directory):
    """One row per headword."""
    return lexicon.entries(rows(spark, directory))


def _scores(spark, directory):
    children = edges(spark, directory).groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "key")
    return lexicon.key_scores(lexicon_entries(spark, directory), children)


def key_ranks(spark, directory):
    """Headwords by how worth knowing they are."""
    return lexicon.ranked(_scores(spark, directory)).select("key", F.round("score", 9).alias("score"), "rank")


def keys(spark, directory):
    return key_ranks(spark, directory).select("key", "rank")


def translation_index(spark, directory):
    """Headwords of each translation, best first."""
    return lexicon.listed(lexicon.translation_index(rows(spark, directory)), "translation", "key")


def reverse_keys(spark, directory):
    """Translations by their worth as search keys."""
    return _rounded(lexicon.reverse_key_scores(translation_index(spark, directory)), "score")


def inflection_index(spark, directory):
    """Headwords of each regular inflection, best first."""
    return lexicon.listed(lexicon.inflection_index(rows(spark, directory)), "form", "key")


def co_translations(spark, directory):
    """Translations that share at least two headwords."""
    return lexicon.co_translations(rows(spark, directory))


def translation_votes(spark, directory):
    """Votes of the labels for each translation of a headword."""
    return lexicon.votes(records(spark, directory), table(spark, directory, "label_trust"))


def best_labels(spark, directory):
    """The label whose items suit a reader best."""
    return lexicon.best_labels(rows(spark, directory), ("ed",), ("wn", "we"))


def _corpus_words(spark, directory):
    """key, prob of the words of the English corpus, materialised."""
    s = cut(sentence_tokens(english(table(spark, directory, "documents").select("doc_id", "text", "lang")), True))
    return cut(word_counts(s).crossJoin(sentence_total(s)).select(F.col("word").alias("key"), (F.col("cnt") / F.col("n_sentences")).alias("prob")))


def spelling_pairs(spark, directory):
    """Words of the English corpus that differ as British and American spelling do."""
    return _rounded(lexicon.spelling_pairs(_corpus_words(spark, directory)), "ratio")


def derivations(spark, directory):
    """Words of the English corpus and the words they derive from."""
    return _rounded(lexicon.derivations(_corpus_words(spark, directory)), "ratio", digits=6)


def parent_closure(spark, directory):
    """Ancestors up to three links away."""
    return lexicon.closure(edges(spark, directory))


def form_owners(spark, directory):
    """The headword that owns each inflected form."""
    return lexicon.form_owners(lexicon.inflection_index(rows(spark, directory)), edges(spark, directory))


def homophones(spark, directory):
    """Words of the same pronunciation."""
    return lexicon.homophones(table(spark, directory, "entry_records"))


def inverted_entries(spark, directory):
    """The dictionary turned round."""
    return _rounded(lexicon.inverted_entries(rows(spark, directory)), "score")


def vocabulary_sections(spark, directory):
    """Ranked headwords in sections of a hundred."""
    return lexicon.sections(_scores(spark, directory))


def initial_index(spark, directory):
    """Headwords by first letter."""
    return lexicon.initials(lexicon_entries(spark, directory))


def redirect_forms(spark, directory):
    """Forms that lead to headwords without being any."""
    return lexicon.redirects(edges(spark, directory), lexicon.inflection_index(rows(spark, directory)), lexicon_entries(spark, directory))


def label_items(spark, directory):
    """Items of one label, as its source gave them."""
    return rows(spark, directory).where("label = 'wn'").groupBy("key").agg(F.count("*").alias("n_items"), F.countDistinct("pos").alias("n_pos"))


def asked(spark, directory):
    """The stated query set: words of the links whose id is divisible by 20."""
    found = table(spark, directory, "word_links").where("link_id % 20 = 0").select(F.col("link_id").alias("qid"), normalize_word(F.col("word")).alias("q"))
    return found.where("q != ''")


def _heads(spark, directory):
    return asked(spark, directory).withColumn("q", F.left("q", F.lit(5)))


def search_exact(spark, directory):
    """Headwords equal to a query."""
    return search.exact(asked(spark, directory), keys(spark, directory)).select("qid", "key")


def search_prefix(spark, directory):
    """Headwords that begin as a query does."""
    return search.begins(_heads(spark, directory), keys(spark, directory)).select("qid", "key")


def search_suffix(spark, directory):
    """Headwords that end as a query does."""
    return search.ends(asked(spark, directory).withColumn("q", F.expr("right(q, 3)")), keys(spark, directory)).select("qid", "key")


def search_contain(spark, directory):
    """Headwords that contain the middle of a query."""
    return search.contains(asked(spark, directory).withColumn("q", F.substring("q", 2, 4)).where("q != ''"), keys(spark, directory)).select("qid", "key")


def search_word(spark, directory):
    """Headwords with a query's first word in them."""
    first = F.element_at(F.split("q", "[ -]"), 1)
    return search.words(asked(spark, directory).withColumn("q", first).where("q != ''"), keys(spark, directory)).select("qid", "key")


def search_edit(spark, directory):
    """The nearest headwords within two edits."""
    return search.edits(asked(spark, directory), keys(spark, directory), capacity=10).select("qid", "key", "distance")


def grade_page(spark, directory):
    """The third page of a hundred headwords by rank."""
    return key_ranks(spark, directory).where("rank > 200 and rank <= 300")


def search_reverse(spark, directory):
    """Headwords by translation: the translations of senses whose id is divisible by 20."""
    s = table(spark, directory, "senses").where("sense_id % 20 = 0 and translation is not null")
    queries = s.select(F.col("sense_id").alias("qid"), normalize_word(F.col("translation")).alias("q")).where("q != ''")
    return _rounded(search.reverse(queries, lexicon.translation_index(rows(spark, directory))), "score")


def search_inflected(spark, directory):
    """Headwords of plural queries."""
    queries = asked(spark, directory).withColumn("q", F.concat("q", F.lit("s")))
    return search.inflected(queries, keys(spark, directory), lexicon.inflection_index(rows(spark, directory)))


def search_partial(spark, directory):
    """Headwords within longer queries: the words of senses whose id is divisible by 20, each between an article and a particle."""
    s = table(spark, directory, "senses").where("sense_id % 20 = 0")
    queries = s.select(F.col("sense_id").alias("qid"), F.concat(F.lit("the "), normalize_word(F.col("word")), F.lit(" of")).alias("q"))
    return search.partial(queries, keys(spark, directory))


def annotate_coverage(spark, directory):
    """How much of each English document the lexicon covers."""
    e = english(table(spark, directory, "documents").select("doc_id", "text", "lang"))
    s = sentence_tokens(e, True).withColumnRenamed("doc_id", "id")
    s = cut(s)
    common = s.select(F.explode("words").alias("key")).groupBy("key").agg(F.count("*").alias("n_items")).where("n_items >= 20")
    entry = lexicon_entries(spark, directory).select("key", "prob", "n_items", "n_labels")
    more = common.join(entry, "key", "left_anti").select("key", F.lit(1e-7).alias("prob"), "n_items", F.lit(1).cast("bigint").alias("n_labels"))
    return _rounded(search.coverage(s, search.phrase_hits(s, cut(entry.unionByName(more)))), "coverage").withColumnRenamed("id", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        lexicon_merge, lexicon_entries, key_ranks, translation_index, reverse_keys, inflection_index, co_translations, translation_votes, best_labels, spelling_pairs,
        derivations, parent_closure, form_owners, homophones, inverted_entries, vocabulary_sections, initial_index, redirect_forms, label_items,
        search_exact, search_prefix, search_suffix, search_contain, search_word, search_edit, grade_page, search_reverse, search_inflected, search_partial, annotate_coverage,
    )
}


def _rows(name: str, source: str) -> str:
    return f"""{name} as (
  select {q.normalize_word('word')} as key, word, lower(trim(label)) as label, lower(trim(pos)) as pos, text, translation, greatest(coalesce(probability, 0), 1e-7) as prob
  from {source} where {q.normalize_word('word')} <> '')"""


_R = _rows("r", "senses")
_E = f"""{_R},
e as (select key, max(prob) as prob, count(*) as n_items, count(distinct label) as n_labels, bool_or(translation is not null) as has_tran from r group by key)"""
_EDGES = f"""
edges as (
  select distinct child, parent from (
    select {q.normalize_word('word')} as child, {q.normalize_word('p')} as parent from (select word, unnest(parent) as p from word_links)
    union all select {q.normalize_word('c')}, {q.normalize_word('word')} from (select word, unnest(child) as c from word_links))
  where child <> '' and parent <> '')"""
_KEYS = f"""{_E}, {_EDGES},
kids as (select parent as key, count(*) as n_children from edges group by all),
scored as (
  select key, greatest(sqrt(prob), 1e-5) * 0.5 * (case when has_tran then 2 else 1 end) * log2(n_items + 1) * log2(n_labels + 1) * log2(coalesce(n_children, 0) + 4)
    * (case when regexp_matches(key, '^\\d+$') then 0.1 when regexp_matches(key, '^\\d') then 0.3 when regexp_matches(key, '^[^\\p{{Latin}}]|[^\\p{{Latin}}]$') then 0.5 else 1 end) as score
  from e left join kids using (key)),
k as (select key, round(score, 9) as score, row_number() over (order by round(score, 9) desc, key) as rank from scored)"""
_TRAN = f"""{_R},
t as (select key, translation, max(prob) as own from (select key, {q.normalize_word('translation')} as translation, prob from r where translation is not null) where translation <> '' group by all),
ti as (select translation, key, max(own) over (partition by key) * pow(0.98, row_number() over (partition by key order by own desc, translation) - 1) as score from t),
tl as (select translation, count(*) as n, string_agg(key, chr(9) order by round(score, 12) desc, key) as members from ti group by all)"""
_CVC = "'^[bcdfghklmnpqrstvwxz]+[aeiou][bcdfgklmnpqrstvz]$'"
_INFL = rf"""
w as (select key, pos, max(prob) as prob, count(*) as n, bool_or(translation is not null) as t from r where regexp_matches(key, '^[a-z]+$') group by all),
wf as (
  select *, case when regexp_matches(key, '(s|ch|sh|x|o)$') then key || 'es' when regexp_matches(key, '[^aeiou]y$') then key[:-2] || 'ies' else key || 's' end as third,
    case when regexp_matches(key, '[^e]e$') then key[:-2] || 'ing' when regexp_matches(key, {_CVC}) then key || key[-1] || 'ing' else key || 'ing' end as present,
    case when regexp_matches(key, 'e$') then key || 'd' when regexp_matches(key, '[^aeiou]y$') then key[:-2] || 'ied' when regexp_matches(key, {_CVC}) then key || key[-1] || 'ed' else key || 'ed' end as past,
    case when regexp_matches(key, '[^aeiou]y$') then key[:-2] || 'i' else regexp_replace(key, 'e$', '') end as stem from w),
forms as (
  select key, prob * log2(n) * (case when t then 2 else 1 end) as score,
    unnest(case pos when 'noun' then [third] when 'verb' then [third, present, past] when 'adjective' then [stem || 'er', stem || 'est'] else [] end) as form from wf),
ii as (select form, key, max(score) as score from forms where form <> key group by all)"""
_ASKED = f"asked as (select link_id as qid, {q.normalize_word('word')} as q from word_links where link_id % 20 = 0 and {q.normalize_word('word')} <> '')"

SQL = {
    "lexicon_merge": f"""
      with {_R}, {_rows('r2', 'entry_records')},
      b as (select key, label, count(*) as n_items, max(prob) as prob, sum(round(log2(1 + coalesce(len(text), 0)), 9)) as s from (select * from r union all select * from r2) group by all)
      select key, label, n_items, prob, round(s, 6) as text_score, round(case when sum(s) over (partition by key) > 0 then s / sum(s) over (partition by key) else 0 end, 6) as share from b""",
    "lexicon_entries": f"with {_E} select * from e",
    "key_ranks": f"with {_KEYS} select key, score, rank from k",
    "translation_index": f"with {_TRAN} select * from tl",
    "reverse_keys": f"with {_TRAN} select translation as key, round((sqrt(n) - len(translation) * 1e-7) * (case when regexp_matches(translation, '^\\p{{Hiragana}}+$') then 0.2 else 1 end) * (case when len(translation) = 1 then 0.5 else 1 end), 9) as score from tl",
    "inflection_index": f"with {_R}, {_INFL} select form, count(*) as n, string_agg(key, chr(9) order by round(score, 12) desc, key) as members from ii group by all",
    "co_translations": f"""
      with {_R}, t as (select distinct key, {q.normalize_word('translation')} as t from r where translation is not null and {q.normalize_word('translation')} <> '')
      select a.t as a, b.t as b, count(*) as n from t a join t b on a.key = b.key and a.t < b.t group by all having count(*) >= 2""",
    "translation_votes": f"""
      with {_rows('r', 'entry_records')}, tr as (select lower(trim(label)) as label, max(trust) as trust from label_trust group by all),
      b as (select key, translation, label, max(coalesce(trust, 0)) as w from (select key, label, {q.normalize_word('translation')} as translation from r where translation is not null) left join tr using (label) where translation <> '' group by all)
      select key, translation, sum(w)::bigint as votes from b group by all""",
    "best_labels": f"""
      with {_R},
      s as (select key, label, count(*) as n, avg(round(abs(ln(9) - ln(w)), 9)) as far from (
        select key, label, greatest(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\x0b\\p{{Z}}]+'), lambda x: x <> '')), 1) as w from r) group by all),
      c as (select key, label, round((abs(ln(5) - ln(n)) + 0.5) * (far + 1) * (case when label = 'ed' then 0.8 when label in ('wn', 'we') then 1.0 else 1.4 end), 9) as cost from s)
      select key, label, cost from c qualify row_number() over (partition by key order by cost, label nulls first) = 1""",
    "derivations": f"""
      with {q.ENGLISH_WORDS}, e as (select word as key, cnt / n_sentences as prob from word_cnt, n), rules(s, b, n) as (values ('iness','y',3),('ness','',3),('ability','able',2),('ibility','ible',2),('ity','',3),('ity','e',3),('ization','ize',3),('ation','ate',3),('ation','',4),('ation','e',3),
        ('ion','',4),('ion','e',4),('ment','',3),('er','',3),('er','e',3),('or','',4),('or','e',3),('ist','',4),('ism','',4),('ize','',4),('ify','',3),('ily','y',3),('ally','al',3),('ly','',3),('able','',3),('able','e',3),
        ('ible','',3),('ful','',3),('less','',3),('ous','',4),('ive','',4),('ive','e',3),('al','',4),('al','e',4),('ic','',4),('ish','',3),('ing','',3),('ing','e',3),('ed','',3),('ed','e',3)),
      x as (select distinct key, prob, key[:len(key) - len(s)] || b as stem from e join rules on ends_with(key, s) and len(key) >= len(s) + n where regexp_full_match(key, '[a-z]{{4,}}'))
      select x.key, stem, round(e.prob / x.prob, 6) as ratio from x join e on e.key = stem where stem <> x.key and e.prob / x.prob >= 0.1""",
    "spelling_pairs": f"""
      with {q.ENGLISH_WORDS}, e as (select word as key, cnt / n_sentences as prob from word_cnt, n), p(a, b) as (values ('se','ze'),('sing','zing'),('sed','zed'),('ser','zer'),('sation','zation'),('ce','se'),('our','or'),('og','ogue'),('re','er'),('l','ll')),
      v as (select distinct key, prob, key[:len(key) - len(a)] || b as variant from (select * from e, p union all select e.*, b, a from e, p) where ends_with(key, a) and len(key) > len(a))
      select v.key, variant, round(least(v.prob, e.prob) / (v.prob + e.prob), 9) as ratio from v join e on e.key = variant""",
    "parent_closure": f"""
      with {_EDGES},
      s as (select child, parent as ancestor, 1 as distance from edges
        union all select a.child, b.parent, 2 from edges a join edges b on a.parent = b.child
        union all select a.child, c.parent, 3 from edges a join edges b on a.parent = b.child join edges c on b.parent = c.child)
      select child, ancestor, min(distance)::int as distance from s where child <> ancestor group by all""",
    "form_owners": f"with {_R}, {_INFL}, {_EDGES}, p as (select distinct parent as key from edges) select form, arg_max(ii.key, struct_pack(c := round(score * (case when p.key is null then 1 else 10 end), 12), k := ii.key)) as owner from ii left join p on p.key = ii.key group by all",
    "homophones": f"""
      with s as (select distinct regexp_replace(pronunciation, '[ˈˌ ]', '', 'g') as sound, {q.normalize_word('word')} as w from entry_records where regexp_matches(pronunciation, '\\p{{L}}') and {q.normalize_word('word')} <> '')
      select sound, count(*) as n, string_agg(w, chr(9) order by w) as words from s group by all having count(*) > 1""",
    "inverted_entries": f"with {_TRAN} select translation, key, round(greatest(0.1, sqrt(max(own) over (partition by key))) + 0.5 * pow(0.8, row_number() over (partition by key order by own desc, translation) - 1), 9) as score from t",
    "vocabulary_sections": f"with {_KEYS} select (rank - 1) // 100 as section, (rank - 1) % 100 as at, key from k",
    "initial_index": f"with {_E} select case when regexp_matches(upper(key[1]), '^[A-Z]$') then upper(key[1]) else '#' end as initial, count(*) as n, min(key) as first, max(key) as last from e group by all",
    "redirect_forms": f"""
      with {_E}, {_INFL}, {_EDGES},
      led as (select parent as form, child as target from edges union all select child, parent from edges union all select form, key from ii)
      select form, min(target) as target from led where form not in (select key from e) and target in (select key from e) group by all""",
    "label_items": f"with {_R} select key, count(*) as n_items, count(distinct pos) as n_pos from r where label = 'wn' group by all",
    "search_exact": f"with {_E}, {_ASKED} select qid, key from asked join e on e.key = q",
    "search_prefix": f"with {_E}, {_ASKED} select qid, key from asked join e on starts_with(e.key, q[:5])",
    "search_suffix": f"with {_E}, {_ASKED} select qid, key from asked join e on ends_with(e.key, q[-3:])",
    "search_contain": f"with {_E}, {_ASKED} select qid, key from asked join e on contains(e.key, q[2:5]) where q[2:5] <> ''",
    "search_word": f"with {_E}, {_ASKED}, f as (select qid, regexp_split_to_array(q, '[ -]')[1] as q from asked) select qid, key from f join e on contains(' ' || replace(e.key, '-', ' ') || ' ', ' ' || q || ' ') where q <> ''",
    "search_edit": f"with {_KEYS}, {_ASKED} select qid, key, levenshtein(q, key)::int as distance from asked join k on abs(len(q) - len(key)) <= 2 and levenshtein(q, key) <= 2 qualify row_number() over (partition by qid order by levenshtein(q, key), rank) <= 10",
    "grade_page": f"with {_KEYS} select key, score, rank from k where rank > 200 and rank <= 300",
    "search_reverse": f"with {_TRAN}, qs as (select sense_id as qid, {q.normalize_word('translation')} as q from senses where sense_id % 20 = 0 and translation is not null) select qid, key, round(score, 9) as score from qs join ti on ti.translation = q",
    "search_inflected": f"""
      with {_E}, {_INFL}, {_ASKED}, p as (select qid, q || 's' as q from asked)
      select qid, key, 0 as place from p join e on e.key = q
      union all select qid, key, (row_number() over (partition by qid order by round(score, 12) desc, key))::int from p join ii on form = q where key <> q""",
    "search_partial": f"""
      with {_E}, qs as (select sense_id as qid, string_split('the ' || {q.normalize_word('word')} || ' of', ' ') as w from senses where sense_id % 20 = 0 and word is not null),
      l as (select qid, w, unnest([len(w) - 1, len(w) - 2]) as n from qs where len(w) between 2 and 6),
      p as (select qid, w, n, unnest(range(0, len(w) - n)) as start from l where n > 0)
      select qid, key, start::int as start, n::int as n from p join e on e.key = array_to_string(w[start + 1:start + n], ' ')""",
    "annotate_coverage": f"""
      with {q.ENGLISH_TOKENS}, {_E},
      common as (select key, count(*) as n from (select unnest(words) as key from lowered) group by all having count(*) >= 20),
      lex as (select key from e union select key from common),
      st as (select doc_id, sent_id, words, unnest(range(1, len(words) + 1)) as a from lowered),
      g as (select doc_id, sent_id, a, n from (select st.*, unnest(range(1, 5)) as n from st) where a + n - 1 <= len(words) and array_to_string(words[a:a + n - 1], ' ') in (select key from lex)),
      h as (select doc_id, count(*) as n_annotated from (select distinct doc_id, sent_id, unnest(range(a, a + n)) as p from g) group by all),
      t as (select doc_id, sum(len(words))::bigint as n_words from lowered group by all)
      select doc_id, n_words, coalesce(n_annotated, 0) as n_annotated, round(coalesce(n_annotated, 0) / n_words, 9) as coverage from t left join h using (doc_id)""",
}
SQL = {name: sql for name, sql in SQL.items() if sql}
