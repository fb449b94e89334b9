"""Corpus statistics over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import format_prob, normalize_word, predict_language
from ..operators import corpus
from ..operators.tokenize import document_sentences, readable_documents, source_phrases, tokens
from ..runtime import cut, table
from . import sqltext as q

LEAST_WORD, LEAST_COOC = 4, 1000


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "documents").select("doc_id", "text", "lang", "source", "domain_name")


def english(spark: SparkSession, directory: str) -> DataFrame:
    return corpus.english(documents(spark, directory))


def corpus_totals(spark, directory):
    """Documents, sentences and words of the English corpus."""
    return corpus.totals(corpus.sentence_tokens(english(spark, directory), False))


def sentence_split(spark, directory):
    """All sentences of all documents."""
    return document_sentences(documents(spark, directory), cap=None)


def tokenize_en(spark, directory):
    """Tokens of each English sentence, as written and in key form."""
    s = document_sentences(english(spark, directory))
    return s.select("doc_id", "sent_id", F.array_join(tokens(F.col("sentence")), " ").alias("words"), F.array_join(tokens(F.col("sentence"), True), " ").alias("lowered"))


def tokenize_readable(spark, directory):
    """The readable sentences of each English document."""
    return readable_documents(english(spark, directory)).select("doc_id", "place", F.array_join("words", " ").alias("words"))


def normalize_words(spark, directory):
    """The key form of every distinct token."""
    word = document_sentences(english(spark, directory)).select(F.explode(tokens(F.col("sentence"))).alias("word")).distinct()
    return word.select("word", normalize_word(F.col("word")).alias("norm"))


def predict_languages(spark, directory):
    """Documents by given and predicted language."""
    d = documents(spark, directory).where("text is not null")
    return d.groupBy(F.lower("lang").alias("lang"), predict_language(F.col("text")).alias("predicted")).agg(F.count("*").alias("n"))


def _sentences(spark, directory):
    """Tokenised sentences, materialised: they are counted in more than one way."""
    return cut(corpus.sentence_tokens(english(spark, directory), False))


def _phrase_probs(spark, directory, longest=3):
    s = _sentences(spark, directory)
    return corpus.phrase_probs(corpus.ngram_counts(s, longest), corpus.sentence_total(s))


def ngram_counts(spark, directory):
    """Sentence counts of all 1- to 3-grams."""
    return corpus.ngram_counts(corpus.sentence_tokens(english(spark, directory), False))


def phrase_prob(spark, directory):
    """Probabilities of the phrases likely enough for their shape, also as text."""
    return _phrase_probs(spark, directory).select("phrase", "cnt", F.round("prob", 9).alias("prob"), format_prob(F.col("prob")).alias("as_text"))


def top_bigrams(spark, directory):
    """The twenty most probable bigrams."""
    probs = _phrase_probs(spark, directory, 2).where(F.contains("phrase", F.lit(" ")))
    return probs.orderBy(F.desc("cnt"), "phrase").limit(20).select("phrase", "cnt", F.round("prob", 9).alias("prob"))


def word_counts(spark, directory):
    """Sentence counts and probabilities of words in key form."""
    s = _sentences(spark, directory)
    return corpus.word_counts(corpus.lowered(s)).crossJoin(corpus.sentence_total(s)).select("word", "cnt", F.round(F.col("cnt") / F.col("n_sentences"), 9).alias("prob"))


def _coocs(spark, directory):
    lists = cut(corpus.document_words(english(spark, directory)))
    s = corpus.each_sentence(lists)
    counts, total = cut(corpus.word_counts(s)), cut(corpus.sentence_total(s))
    return counts, total, corpus.cooccurrences(lists, counts, LEAST_WORD)


def _score_table(spark, directory):
    counts, total, coocs = _coocs(spark, directory)
    probs = counts.crossJoin(total).select("word", (F.col("cnt") / F.col("n_sentences")).alias("prob"))
    top = cut(corpus.top_cooccurrences(coocs, counts, total, LEAST_COOC).select("word", "cooc", "score"))
    return corpus.cooccurrence_probs(top, probs, total), probs


def cooc_scores(spark, directory):
    """Decayed co-occurrence sums."""
    return _coocs(spark, directory)[2]


def cooc_topk(spark, directory):
    """The best co-occurring words of each word."""
    counts, total, coocs = _coocs(spark, directory)
    return corpus.top_cooccurrences(coocs, counts, total, LEAST_COOC)


def cooc_prob(spark, directory):
    """Co-occurrence probabilities."""
    return _score_table(spark, directory)[0].select("word", "cooc", F.round("prob", 12).alias("prob"), "rank")


def cooc_score_table(spark, directory):
    """Idf and co-occurrence scores in whole thousandths."""
    return corpus.score_table(*_score_table(spark, directory))


def related_words(spark, directory):
    """Words related to the words of evaluation items; the query set is every item whose id is divisible by 20."""
    scores = cut(corpus.score_table(*_score_table(spark, directory)))
    items = table(spark, directory, "eval_items").where("item_id % 20 = 0 and text is not null")
    queries = items.select(F.col("item_id").alias("query"), F.explode(tokens(F.col("text"), True)).alias("word")).distinct()
    found = corpus.related_words(queries, scores)
    return found.select("query", "word", F.round("score", 6).alias("score"))


def phrase_back_off(spark, directory):
    """Probabilities of the 4-grams of evaluation texts against the corpus."""
    probs = _phrase_probs(spark, directory)
    words = table(spark, directory, "eval_items").where("text is not null").select(tokens(F.col("text")).alias("w")).where(F.size("w") >= 4)
    phrases = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 3), lambda i: F.array_join(F.slice("w", i, 4), " "))).alias("phrase"))
    return corpus.back_off(phrases, probs).select("phrase", F.round(F.col("prob") * 1e9, 3).alias("prob_e9"))


# Fixed value: a target term, a run of Han with its Hiragana ending or a run of Katakana.
TARGET = r"\p{Han}+\p{Hiragana}{0,2}|[\p{Katakana}ー]+"


def parallel_lines(spark, directory):
    """domain, source, target of the parallel documents' lines that have both sides, near repeats across domains left out."""
    d = documents(spark, directory).where("source = 'parallel' and domain_name is not null")
    line = d.select("doc_id", F.col("domain_name").alias("domain"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    both = line.withColumn("f", F.split("line", "\t")).where(F.size("f") == 2).select("doc_id", "line_no", "domain", F.col("f")[0].alias("src"), F.col("f")[1].alias("trg"))
    # of lines that begin alike and of lines that end alike the first, by sums before the shuffle, so that no task holds all of them
    row = F.struct("doc_id", "line_no", "domain", "src", "trg")
    first = lambda df, at: df.groupBy(F.concat_ws("\t", *(F.substring(c, at, 32) for c in ("src", "trg"))).alias("k")).agg(F.min(row).alias("r")).select("r.*")
    return first(first(both, 1), -32).select("domain", "src", "trg")


def _phrase_pairs(spark, directory):
    lines = parallel_lines(spark, directory)
    targets = F.array_distinct(F.regexp_extract_all("trg", F.lit(TARGET.replace(r"\p{", r"\p{Is")), F.lit(0)))
    sides = lines.select("domain", source_phrases(F.col("src")).alias("s"), targets.alias("t"))
    return sides.select("domain", F.explode("s").alias("src"), "t").select("domain", "src", F.explode("t").alias("trg")).distinct()


def domain_pairs(spark, directory):
    """In how many domains each pair of a source phrase and a target term stands, with both marginals."""
    src, trg, pair = corpus.pair_counts(_phrase_pairs(spark, directory))
    return pair.where("cnt >= 2").join(src.withColumnRenamed("cnt", "src_cnt"), "src").join(trg.withColumnRenamed("cnt", "trg_cnt"), "trg").select("src", "trg", "cnt", "src_cnt", "trg_cnt")


def translation_assoc(spark, directory):
    """Association of source phrases and target terms."""
    found = corpus.association(*corpus.pair_counts(_phrase_pairs(spark, directory)))
    return found.select("src", "trg", "cnt", *(F.round(c, 6).alias(c) for c in ("ef", "fe", "score")))


QUERIES = {
    f.__name__: f
    for f in (
        corpus_totals, sentence_split, tokenize_en, tokenize_readable, normalize_words, predict_languages, ngram_counts, phrase_prob, top_bigrams, word_counts,
        cooc_scores, cooc_topk, cooc_prob, cooc_score_table, related_words, phrase_back_off, domain_pairs, translation_assoc,
    )
}

_PARALLEL = f"""
lines as (
  select doc_id, domain_name as domain, unnest(l) as line, generate_subscripts(l, 1) as line_no
  from (select doc_id, domain_name, string_split(text, chr(10)) as l from documents where source = 'parallel' and domain_name is not null and text is not null)
),
both_sides as (select doc_id, line_no, domain, f[1] as src, f[2] as trg from (select *, string_split(line, chr(9)) as f from lines) where len(f) = 2),
heads as (select * from both_sides qualify row_number() over (partition by src[:32] || chr(9) || trg[:32] order by doc_id, line_no) = 1),
once as (select * from heads qualify row_number() over (partition by src[-32:] || chr(9) || trg[-32:] order by doc_id, line_no) = 1),
chunks as (select doc_id, line_no, unnest(string_split({q.chain('src', [(r"[^-_'’\p{Latin}\d\s]+", chr(10))])}, chr(10))) as chunk from once),
chunk_words as (
  select doc_id, line_no, list_transform(regexp_extract_all(chunk, '[\\p{{Latin}}\\d][-_''’\\p{{Latin}}\\d]*'), lambda w: regexp_replace(w, '[''’]s?$', '')) as w from chunks
),
src_phrases as (
  select doc_id, line_no, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as src from chunk_words
),
pairs as (
  select distinct o.domain, p.src, unnest(regexp_extract_all(o.trg, '{TARGET}')) as trg from once o join src_phrases p using (doc_id, line_no)
),
src_cnt as (select src, count(distinct domain) as cnt from pairs group by all),
trg_cnt as (select trg, count(distinct domain) as cnt from pairs group by all),
pair_cnt as (select src, trg, count(distinct domain) as cnt from pairs group by all)"""

SQL = {
    "corpus_totals": f"with {q.ENGLISH_TOKENS} select count(distinct doc_id) as n_docs, count(*) as n_sentences, coalesce(sum(len(words)), 0)::bigint as n_words from sw",
    "sentence_split": f"select doc_id, unnest(s) as sentence, (generate_subscripts(s, 1) - 1)::int as sent_id from (select doc_id, {q.sentences('text')} as s from documents)",
    "tokenize_en": f"with {q.ENGLISH_TOKENS} select doc_id, sent_id::int as sent_id, array_to_string(words, ' ') as words, array_to_string(list_transform(words, lambda w: {q.normalize_word('w')}), ' ') as lowered from toks",
    "tokenize_readable": f"""
      with s as (
        select doc_id, list_filter({q.sentences('text')}, lambda x: not contains('.?!。？！,;、', x[1]) and contains('.?!。？！', x[-1])) as s
        from documents where lower(lang) = 'en'),
      u as (select doc_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as place from s)
      select doc_id, place::int as place, array_to_string(w, ' ') as words from (select doc_id, place, {q.tokens('sentence')} as w from u) where len(w) >= 6""",
    "normalize_words": f"with {q.ENGLISH_TOKENS}, w as (select distinct unnest(words) as word from toks) select word, {q.normalize_word('word')} as norm from w",
    "predict_languages": r"select lower(lang) as lang, case when regexp_matches(text, '[\p{Hiragana}\p{Katakana}ー\p{Han}]') then 'ja' else 'en' end as predicted, count(*) as n from documents where text is not null group by all",
    "ngram_counts": f"with {q.ENGLISH_NGRAMS} select phrase, cnt from ngram_cnt",
    "phrase_prob": f"with {q.ENGLISH_PROBS} select phrase, cnt, round(prob, 9) as prob, regexp_replace(printf('%.7f', prob), '^0\\.', '.') as as_text from probs",
    "top_bigrams": f"with {q.ENGLISH_PROBS} select phrase, cnt, round(prob, 9) as prob from probs where phrase like '% %' and phrase not like '% % %' order by cnt desc, phrase limit 20",
    "word_counts": f"with {q.ENGLISH_WORDS} select word, cnt, round(cnt / n_sentences, 9) as prob from word_cnt, n",
    "cooc_scores": f"with {q.ENGLISH_COOCS} select word, cooc, score from coocs",
    "cooc_topk": f"with {q.ENGLISH_COOCS} select word, cooc, score, rank::int as rank from top_coocs",
    "cooc_prob": f"with {q.ENGLISH_COOCS} select word, cooc, round(prob, 12) as prob, rank::int as rank from cooc_prob",
    "cooc_score_table": f"with {q.ENGLISH_COOCS} select word, idf_score, cooc, cooc_score from score_table",
    "related_words": f"""
      with {q.ENGLISH_COOCS},
      vectors as (
        select word, label, weight from (
          select distinct word, word as label, 0.05 * idf_score * idf_score / 1e6 * {q.weight('word')} as weight from score_table
          union all select word, cooc, cooc_score * idf_score / 1e6 * {q.weight('cooc')} from score_table)),
      queries as (select distinct item_id as query, {q.normalize_word('w')} as word from (select item_id, unnest({q.tokens('text')}) as w from eval_items where item_id % 20 = 0 and text is not null)),
      seeds as (select query, label, sum(weight) as weight from queries join vectors using (word) group by all),
      ranked as (select *, row_number() over (partition by query order by round(weight, 9) desc, label) as rank from seeds),
      fresh as (select query, label, weight, row_number() over (partition by query order by round(weight, 9) desc, label) as rank from seeds s where not exists (from queries o where o.query = s.query and o.word = s.label)),
      reached as (
        select t.query, v.label, max(t.weight * v.weight) as weight from fresh t join vectors v on v.word = t.label
        where t.rank <= 32 and not exists (from queries o where o.query = t.query and o.word = v.label) group by all),
      near as (select query, label from fresh where rank <= 16),
      far as (
        select query, label from (select *, row_number() over (partition by query order by round(weight, 9) desc, label) as rank from reached r
          where not exists (from near x where x.query = r.query and x.label = r.label)) where rank <= 128),
      candidates as (select query, word from queries union select query, label from near union select query, label from far),
      seed as (select query, label, weight from ranked where rank <= 256),
      norms as (select query, sqrt(sum(weight * weight)) as norm from seed group by all),
      shared as (select c.query, c.word, sum(s.weight * v.weight) as dot, sqrt(sum(v.weight * v.weight)) as other
        from candidates c join vectors v on v.word = c.word join seed s on s.query = c.query and s.label = v.label group by all)
      select query, word, round(case when least(dot / (norm * other), 1.0) >= 0.99999 then 1.0 else least(dot / (norm * other), 1.0) end, 6) as score from shared join norms using (query)""",
    "phrase_back_off": f"""
      with {q.ENGLISH_PROBS},
      w as (select {q.tokens('text')} as w from eval_items where text is not null),
      p as (select distinct w[i:i + 3] as g from (select w, unnest(range(1, len(w) - 2)) as i from w where len(w) >= 4)),
      ph as (select array_to_string(g, ' ') as phrase, {q.tokens("array_to_string(g, ' ')")} as w from p),
      parts as (select phrase, len(w) as len, m, array_to_string(w[i:i + m - 1], ' ') as gram from (select *, unnest(range(1, least(len(w), 3) + 1)) as m from ph) cross join lateral (select unnest(range(1, len(w) - m + 2)) as i)),
      levels as (select g.phrase, g.len, g.m, count(*) as n_all, count(p.prob) as hits, sum(1 / p.prob) as inverse from parts g left join probs p on p.phrase = g.gram group by all having count(*) = count(p.prob)),
      best as (select phrase, arg_max(hits / inverse * pow(0.3, len - m) * pow(0.1, least(len, 3) - m), m) as prob from levels group by phrase)
      select phrase, round(greatest(coalesce(prob, 0), 1e-9) * 1e9, 3) as prob_e9 from (select distinct phrase from ph) left join best using (phrase)""",
    "domain_pairs": f"with {_PARALLEL} select p.src, p.trg, p.cnt, s.cnt as src_cnt, t.cnt as trg_cnt from pair_cnt p join src_cnt s using (src) join trg_cnt t using (trg) where p.cnt >= 2",
    "translation_assoc": f"""
      with {_PARALLEL},
      a as (select p.src, p.trg, p.cnt, t.cnt as tc, p.cnt / (s.cnt + 2) as ef, p.cnt / (t.cnt + 2) as fe from pair_cnt p join src_cnt s using (src) join trg_cnt t using (trg) where p.cnt >= 2)
      select src, trg, cnt, round(ef, 6) as ef, round(fe, 6) as fe, round(ef * fe, 6) as score from a where round(ef * fe, 12) >= 0.01 or (len(trg) >= 3 and tc >= 10)""",
}
