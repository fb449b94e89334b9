"""Queries over parallel lines, marked-up pages, similarity and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import corpus, examples, features, lexicon, similarity
from ..operators import tokenize as tk
from ..operators.search import edits
from ..runtime import cut, table
from . import sqltext as q
from .lexicon_queries import _E, _EDGES, _R, _TRAN, edges, lexicon_entries, rows


def pairs(spark: SparkSession, directory: str) -> DataFrame:
    """id, doc_id, line_no, source, target: lines of parallel documents that have both sides."""
    d = table(spark, directory, "documents").where("source = 'parallel' and text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    f = F.split("line", "\t")
    both = d.where(F.size(f) == 2).select("doc_id", "line_no", t.trim(f[0]).alias("source"), t.trim(f[1]).alias("target"))
    return both.where("source != '' and target != ''").withColumn("id", F.col("doc_id") * 100000 + F.col("line_no"))


def wiki_lines(spark, directory):
    """Plain lines of encyclopedia and dictionary texts."""
    d = table(spark, directory, "documents").where("source in ('encyclopedia', 'dictionary')")
    return d.select("doc_id", F.posexplode(tk.wiki_lines(F.col("text"))).alias("line_no", "line"))


def html_pages(spark, directory):
    """Texts wrapped as HTML pages and turned to lines again."""
    d = table(spark, directory, "documents").where("text is not null")
    body = F.concat(F.lit("<h1 class='x'>"), F.coalesce("head_key", F.lit("")), F.lit("</h1><p>"), F.replace("text", F.lit("\n"), F.lit("<br>")), F.lit("</p><!-- end --><script>var x;</script>"))
    page = F.concat(F.lit("<html><head><title>"), F.coalesce("head_key", F.lit("")), F.lit("</title></head><body>"), body, F.lit("</body></html>"))
    return d.select("doc_id", tk.html_text(page).alias("text"))


def book_pages(spark, directory):
    """The pages of marked-up books and their lines."""
    d = table(spark, directory, "documents").where("source = 'book'")
    return tk.divide_pages(d).groupBy("doc_id", "page").agg(F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


def book_sections(spark, directory):
    """Book lines with the running number of their heading."""
    lines = tk.divide_pages(table(spark, directory, "documents").where("source = 'book'")).where("page > 0")
    so_far = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    follows = F.lead("line").over(Window.partitionBy("doc_id").orderBy("line_no"))
    head = F.col("line").rlike(r"^\[head[1-3]\]:")
    return lines.select("doc_id", "line_no", F.sum(head.cast("int")).over(so_far).alias("section"), F.coalesce(follows.rlike(r"^\[head"), F.lit(True)).alias("is_last"))


def crammed(spark, directory):
    """Texts with hard-wrapped lines joined to paragraphs."""
    return table(spark, directory, "documents").where("text is not null and source in ('encyclopedia', 'book')").select("doc_id", tk.cram(F.col("text")).alias("text"))


def reject_reasons(spark, directory):
    """Why parallel lines are no good examples: repeats first, then what the gate refuses."""
    marked = examples.duplicated(pairs(spark, directory))
    reason = F.coalesce(F.concat("duplicate", F.lit("-repeated")), examples.reject_reason(F.col("source"), F.col("target")), F.lit("kept"))
    return marked.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def _exnum(spark, directory):
    words = F.filter(F.split(F.lower("source"), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    return pairs(spark, directory).select(F.explode(F.array_distinct(tk.ngrams(words, 3))).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n"))


def example_rank(spark, directory):
    """Parallel lines by length and rarity."""
    return examples.rank_examples(pairs(spark, directory), _exnum(spark, directory)).select("id", F.round("score", 6).alias("score"))


def example_dedup(spark, directory):
    """The first line of each source sentence."""
    return examples.deduplicate(pairs(spark, directory), "id").select("id", "source", "target")


def example_repeats(spark, directory):
    """Lines much like one of the ten before."""
    return examples.near_repeats(pairs(spark, directory), "doc_id", "line_no").where("repeats").select("id")


def _queries(spark, directory):
    items = table(spark, directory, "eval_items").where("item_id % 20 = 0 and text is not null")
    return items.select(F.col("item_id").alias("qid"), F.get(F.filter(F.split("text", r"[^\p{L}\p{N}_]+"), lambda w: F.char_length(w) >= 5), F.lit(0)).alias("q")).where("q is not null")


def example_search(spark, directory):
    """Lines that hold a word of an evaluation item, as it is written."""
    return examples.search_examples(_queries(spark, directory), pairs(spark, directory), "exact")


def example_search_any(spark, directory):
    """The same in any case."""
    return examples.search_examples(_queries(spark, directory), pairs(spark, directory), "any")


def example_search_contain(spark, directory):
    """Lines that hold it anywhere."""
    return examples.search_examples(_queries(spark, directory), pairs(spark, directory), "contain")


def example_attach(spark, directory):
    """The best lines of each headword."""
    p = pairs(spark, directory)
    words = p.select(F.explode(F.array_distinct(tk.tokens(F.col("source"), True))).alias("key")).groupBy("key").agg(F.count("*").alias("prob")).where("prob >= 2")
    return examples.attach(words, p)


def postings_index(spark, directory):
    """Sentences of each phrase of English documents, rare phrases first, at most a hundred each."""
    e = corpus.english(table(spark, directory, "documents"))
    s = cut(corpus.sentence_tokens(e, False))
    probs = corpus.phrase_probs(corpus.ngram_counts(s), corpus.sentence_total(s))
    ids = s.select(F.concat_ws("-", "doc_id", "sent_id").alias("id"), "words")
    return examples.postings(ids, probs).select("phrase", "n_total", F.array_join("ids", " ").alias("ids"))


def postings_total(spark, directory):
    """The n-grams of source sentences by how many lines hold them."""
    return _exnum(spark, directory).where("n >= 2")


def _glosses(spark, directory):
    r = rows(spark, directory).where("text is not null")
    cand = table(spark, directory, "entry_records").where("text is not null").select(F.col("record_id").alias("id"), t.normalize_word(F.col("word")).alias("key"), tk.tokens(F.col("text"), True).alias("words")).where(F.size("words") > 0)
    return cand, r.select("key", tk.tokens(F.col("text"), True).alias("words")).where(F.size("words") > 0).distinct()


def gloss_bleu(spark, directory):
    """How far the glosses of records agree with the senses of their word."""
    return similarity.bleu(*_glosses(spark, directory)).select("id", F.round("bleu", 6).alias("bleu"), F.round("precision", 6).alias("precision"))


def twiddle_rank(spark, directory):
    """Children of a word re-ranked by likeness to it."""
    by = edges(spark, directory).groupBy(F.col("parent").alias("q")).agg(F.array_sort(F.collect_list("child")).alias("words"))
    return similarity.twiddle(by.withColumn("qid", F.col("q"))).select("q", "word", "i", "score", "place")


def edit_neighbours(spark, directory):
    """Headwords within two edits of each other."""
    key = lexicon_entries(spark, directory).select("key", F.lit(0).alias("rank"))
    found = edits(key.select(F.col("key").alias("qid"), F.col("key").alias("q")), key)
    return found.where("qid < key").select(F.col("qid").alias("a"), F.col("key").alias("b"), "distance")


def dedup_words(spark, directory):
    """Translations of each headword without near repeats."""
    r = rows(spark, directory).where("translation is not null").groupBy("key").agg(F.array_sort(F.collect_set("translation")).alias("ts"))
    return r.select("key", F.size("ts").alias("n"), F.size(t.deduplicate(F.col("ts"))).alias("n_kept"))


def _relations(spark, directory):
    e = edges(spark, directory)
    own = lexicon_entries(spark, directory).select("key", F.lit("word").alias("kind"), F.lit(0).alias("place"), F.col("key").alias("label"))
    at = lambda by, o: (F.row_number().over(Window.partitionBy(by).orderBy(o)) - 1).alias("place")
    up = e.select(F.col("child").alias("key"), F.lit("parent").alias("kind"), at("child", "parent"), F.col("parent").alias("label"))
    down = e.select(F.col("parent").alias("key"), F.lit("child").alias("kind"), at("parent", "child"), F.col("child").alias("label"))
    tr = lexicon.translation_index(rows(spark, directory))
    best = F.row_number().over(Window.partitionBy("key").orderBy(F.round("score", 12).desc(), "translation")) - 1
    trans = tr.select("key", F.lit("translation").alias("kind"), best.alias("place"), F.col("translation").alias("label"))
    return own.unionByName(up).unionByName(down).unionByName(trans)


def word_features(spark, directory):
    """Weighted features of headwords by their relations."""
    return features.word_features(_relations(spark, directory)).select("key", "label", F.round("weight", 6).alias("weight"))


def feature_cosine(spark, directory):
    """Seed-side cosine of related headwords; the seeds are words of links whose id is divisible by 20."""
    f = cut(features.word_features(_relations(spark, directory)))
    asked = table(spark, directory, "word_links").where("link_id % 20 = 0").select(t.normalize_word(F.col("word")).alias("key")).distinct()
    seeds = f.join(asked, "key", "left_semi").select(F.col("key").alias("seed"), "label", "weight")
    return similarity.seed_cosine(seeds, f.withColumnRenamed("key", "id")).where("seed != id").select("seed", "id", F.round("score", 6).alias("score"))


def feature_softmax(spark, directory):
    """Features of each headword as shares."""
    f = features.word_features(_relations(spark, directory))
    return f.select("key", "label", F.round(similarity.softmax(F.col("weight"), "key"), 6).alias("share"))


#: Words that a cluster takes at classification, and the least number of clusters.
QUOTA, LEAST_CLUSTERS = 15, 20


def _roots(e):
    return e.select(F.col("parent").alias("key")).distinct().join(e.select(F.col("child").alias("key")), "key", "left_anti")


def cluster_words(spark, directory):
    """Linked headwords in clusters of equal capacity, in as many clusters as the roots need at classification."""
    e = edges(spark, directory)
    linked = e.select(F.col("child").alias("key")).distinct()
    f = features.word_features(_relations(spark, directory).join(linked, "key", "left_semi"))
    count = max(LEAST_CLUSTERS, -(-_roots(e).count() // QUOTA))
    return features.cluster(features.prune_features(f, 40, 8.0), count, items=linked)


def classify_words(spark, directory):
    """Roots put to the clusters of cluster_words."""
    e = edges(spark, directory)
    f = cut(features.word_features(_relations(spark, directory)))
    members = cluster_words(spark, directory)
    roots = _roots(e)
    return features.classify(members, f.join(roots.unionByName(members.select("key")), "key", "left_semi"), QUOTA, items=roots)


def age_of_acquisition(spark, directory):
    """Ages of parts' words: mean size plus deviation, averaged, and the age of probability where it is missing."""
    p = table(spark, directory, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("key"), F.col("p_size").cast("double").alias("mean"))
    aged = p.where("key != ''").groupBy("key").agg(F.round(F.avg(F.col("mean") + 3.0), 6).alias("aoa"), F.count("*").alias("n"))
    total = aged.agg(F.sum("n").alias("total"))
    made = F.round(-F.log(F.col("n") / F.col("total") + 1e-8) + 3.5, 6)
    least = F.min("aoa").over(Window.partitionBy(F.substring("key", 1, 1)).orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    return aged.crossJoin(total).select("key", "aoa", made.alias("made"), F.round(least, 6).alias("least_so_far"))


def text_forms(spark, directory):
    """Senses with quotes and dashes in plain spelling, kana exchanged and kinds of words."""
    s = table(spark, directory, "senses")
    return s.select(
        "sense_id", t.plain_signs(F.col("text")).alias("text"), t.to_hiragana(F.col("translation")).alias("hiragana"), t.to_katakana(F.col("translation")).alias("katakana"),
        t.word_weight(F.lower("word")).alias("weight"),
    )


def section_translations(spark, directory):
    """Members of translation sections by plain division, without the grammar of quotes."""
    s = table(spark, directory, "senses").where("text is not null")
    return s.select("sense_id", F.posexplode(t.extract_translations(F.col("text"))).alias("at", "val"))


QUERIES = {
    f.__name__: f
    for f in (
        wiki_lines, html_pages, book_pages, book_sections, crammed, reject_reasons, example_rank, example_dedup, example_repeats, example_search, example_search_any, example_search_contain,
        example_attach, postings_index, postings_total, gloss_bleu, twiddle_rank, edit_neighbours, dedup_words, word_features, feature_cosine, feature_softmax, cluster_words, classify_words,
        age_of_acquisition, text_forms, section_translations,
    )
}

_HIRA = "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわをんぁぃぅぇぉゃゅょっがぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽゔ"
_KATA = "".join(chr(ord(c) + 0x60) for c in _HIRA)
_PAIRS = f"""
lines as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as line_no from (select doc_id, string_split(text, chr(10)) as l from documents where source = 'parallel' and text is not null)),
pairs as (
  select doc_id * 100000 + line_no as id, doc_id, line_no, {q.trim('f[1]')} as source, {q.trim('f[2]')} as target from (select *, string_split(line, chr(9)) as f from lines)
  where len(f) = 2 and {q.trim('f[1]')} <> '' and {q.trim('f[2]')} <> '')"""
_REASON = """case
  when len(source) < 57 / (case when regexp_matches(source, '[A-Z].*[.!?]$') then 4 else 3 end) then 'source-short'
  when len(target) < 29 / (case when regexp_matches(source, '[A-Z].*[.!?]$') then 4 else 3 end) then 'target-short'
  when len(source) > 171 then 'source-long' when len(target) > 87 then 'target-long'
  when regexp_matches(target, 'あなた.*あなた|彼女.*彼女') then 'target-bad-pronoun'
  when regexp_matches(target, '^[」』】］）)\\].?!;,？！を。、；]') then 'target-bad-prefix'
  when len(target) - len(replace(target, '、', '')) >= 4 or len(target) - len(replace(target, '。', '')) >= 3 or len(target) - len(replace(target, ' ', '')) >= 4 then 'target-bad-punctuation'
  end"""
_EXNUM = f"""{_PAIRS},
pw as (select id, list_filter(regexp_split_to_array(lower(source), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '') as w from pairs),
pg as (select id, array_to_string(w[i:i + n - 1], ' ') as phrase from (select *, unnest(range(1, 4)) as n from pw) cross join lateral (select unnest(range(1, len(w) - n + 2)) as i)),
exnum as (select phrase, count(*) as n from (select distinct id, phrase from pg) group by all)"""
_QUERIES = r"qs as (select item_id as qid, list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: len(w) >= 5)[1] as q from eval_items where item_id % 20 = 0 and text is not null)"
_RELATIONS = f"""
rel as (
  select key, 1.0 * 1 as w, key as label from e
  union all select child, 0.8 * pow(0.95, row_number() over (partition by child order by parent) - 1), parent from edges
  union all select parent, 0.6 * pow(0.95, row_number() over (partition by parent order by child) - 1), child from edges
  union all select key, 0.5 * pow(0.95, row_number() over (partition by key order by round(score, 12) desc, translation) - 1), translation from ti),
fb as (select key, label, max(round(w, 9)) as w from rel group by all),
feat as (select key, label, w / max(w) over (partition by key) as weight from fb qualify row_number() over (partition by key order by w desc, label) <= 128)"""
_FEATURES = f"{_TRAN}, e as (select distinct key from r), {_EDGES}, {_RELATIONS}"
_PAGE_LINES = f"""
raw as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as line_no from (select doc_id, {q.lines("coalesce(text, '')")} as l from documents where source = 'book')),
marked as (
  select *, line in ('{q.META}', '{q.PAGE}') as marker, sum((line in ('{q.META}', '{q.PAGE}'))::int) over w as block,
    coalesce(last_value(case when line in ('{q.META}', '{q.PAGE}') then line = '{q.META}' end ignore nulls) over w, false) as is_meta
  from raw window w as (partition by doc_id order by line_no rows unbounded preceding)),
paged as (select doc_id, case when is_meta then 0 else dense_rank() over (partition by doc_id, is_meta order by block) end as page, line_no, line from marked where not marker)"""
_HTML = "'<html><head><title>' || coalesce(head_key, '') || '</title></head><body><h1 class=''x''>' || coalesce(head_key, '') || '</h1><p>' || replace(text, chr(10), '<br>') || '</p><!-- end --><script>var x;</script></body></html>'"


def _unescaped(column: str) -> str:
    for entity, sign in q.HTML_ENTITIES:
        column = f"replace({column}, {q.quote(entity)}, {q.quote(sign)})"
    return column


SQL = {
    "wiki_lines": f"""
      with l as (select doc_id, list_filter({q.lines(q.chain("coalesce(text, '')", q.WIKI_RULES))}, lambda x: not regexp_matches(x, '{q.WIKI_DROP}')) as l from documents where source in ('encyclopedia', 'dictionary')),
      m as (select doc_id, list_filter(list_transform(l, lambda x: {q.trim(q.chain('x', q.WIKI_MARKS))}), lambda x: x <> '') as l from l)
      select doc_id, unnest(l) as line, (generate_subscripts(l, 1) - 1)::int as line_no from m""",
    "html_pages": f"""
      with p as (select doc_id, {_HTML} as page from documents where text is not null),
      t as (select doc_id, regexp_extract({q.chain('page', [(q.SPACES, ' ')])}, '<title[^>]*>(.*?)</title>', 1) as title, array_to_string({q.lines(_unescaped(q.chain('page', q.HTML_RULES)))}, chr(10)) as body from p)
      select doc_id, case when title <> '' then '{q.META}' || chr(10) || '[title]: ' || title || chr(10) || '{q.PAGE}' || chr(10) || body else body end as text from t""",
    "book_pages": f"with {_PAGE_LINES} select doc_id, page::int as page, count(*) as n_lines, sum(len(line))::bigint as n_chars from paged group by all",
    "book_sections": f"""
      with {_PAGE_LINES}
      select doc_id, line_no::int as line_no, (sum(regexp_matches(line, '^\\[head[1-3]\\]:')::int) over (partition by doc_id order by line_no rows unbounded preceding))::bigint as section,
        coalesce(regexp_matches(lead(line) over (partition by doc_id order by line_no), '^\\[head'), true) as is_last
      from paged where page > 0""",
    "crammed": f"""
      select doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\\r', '', 'g'), '\\n[ \\t]*(?:\\n[ \\t]*)+'),
        lambda p: {q.trim("regexp_replace(p, '[ ' || chr(9) || ']*' || chr(10) || '[ ' || chr(9) || ']*', ' ', 'g')")}), lambda p: p <> ''), chr(10)) as text
      from documents where text is not null and source in ('encyclopedia', 'book')""",
    "reject_reasons": f"""
      with {_PAIRS}, a as (select *, row_number() over (partition by lower(source) order by id) as i from pairs),
      b as (select *, case when i = 1 then row_number() over (partition by lower(target), i order by id) end as j from a)
      select case when i > 1 then 'source-repeated' when j > 1 then 'target-repeated' else coalesce({_REASON}, 'kept') end as reason, count(*) as n from b group by all""",
    "example_rank": f"""
      with {_EXNUM},
      fit as (select * from pairs where len(source) between 28.5 and 114 and len(target) between 14.5 and 58),
      bonus as (select id, sum(round(0.4 / (x.n + 2), 9)) as bonus from pg g join exnum x using (phrase) where x.n <= 4 group by all)
      select id, round(sqrt(least(len(source) / 57, 57 / len(source)) * least(len(target) / 29, 29 / len(target))) * (1 + coalesce(bonus, 0)), 6) as score from fit left join bonus using (id)""",
    "example_dedup": f"with {_PAIRS} select id, source, target from pairs qualify row_number() over (partition by regexp_replace(lower(source), '[^\\p{{Latin}} ]+', '', 'g') order by id) = 1",
    "example_search": f"with {_PAIRS}, {_QUERIES} select distinct qid, id from qs join pairs on contains(source, q) where case when contains(source, q) then regexp_matches(source, '(^|[^\\p{{L}}\\p{{N}}_])' || q || '($|[^\\p{{L}}\\p{{N}}_])') end",
    "example_search_any": f"with {_PAIRS}, {_QUERIES} select distinct qid, id from qs join pairs on contains(lower(source), lower(q)) where case when contains(lower(source), lower(q)) then regexp_matches(source, '(?i)(^|[^\\p{{L}}\\p{{N}}_])' || q || '($|[^\\p{{L}}\\p{{N}}_])') end",
    "example_search_contain": f"with {_PAIRS}, {_QUERIES} select distinct qid, id from qs join pairs on contains(lower(source), lower(q))",
    "example_attach": f"""
      with {_PAIRS},
      tw as (select id, source, target, list_transform({q.tokens('source')}, lambda w: {q.normalize_word('w')}) as w from pairs),
      tu as (select id, source, target, list_filter(w, lambda x, i: list_position(w, x) = i) as w from tw),
      words as (select key, count(*) as prob from (select unnest(w) as key from tu) group by all having count(*) >= 2),
      x as (select id, source, target, w[i] as key, i - 1 as loc, len(w) as len from (select *, unnest(range(1, len(w) + 1)) as i from tu where ({_REASON}) is null)),
      o as (select x.*, prob from x join words using (key) qualify row_number() over (partition by id order by prob, key) = 1),
      s as (select key, id, round(sqrt((len - loc) / len / 2 + 0.5) * pow(least(len(source) / 57, 57 / len(source)) * least(len(target) / 29, 29 / len(target)), 0.2), 9) as score from o)
      select key, id, score, (row_number() over (partition by key order by score desc, id))::int as place from s qualify place <= 8""",
    "postings_index": f"""
      with {q.ENGLISH_PROBS},
      g as (select distinct doc_id, sent_id, phrase from (select doc_id, sent_id, array_to_string(words[i:i + n - 1], ' ') as phrase from (select *, unnest(range(1, 4)) as n from sw) cross join lateral (select unnest(range(1, len(words) - n + 2)) as i))),
      k as (select g.phrase, doc_id, sent_id from g join probs using (phrase) qualify row_number() over (partition by doc_id, sent_id order by prob, g.phrase) <= 50),
      s as (select phrase, doc_id || '-' || sent_id as id, count(*) over (partition by phrase) as n_total from k
        qualify row_number() over (partition by phrase order by md5('19780211|' || phrase || '|' || doc_id || '-' || sent_id), doc_id || '-' || sent_id) <= 100)
      select phrase, n_total, string_agg(id, ' ' order by id) as ids from s group by all""",
    "postings_total": f"with {_EXNUM} select phrase, n from exnum where n >= 2",
    "gloss_bleu": f"""
      with {_R},
      c as (select record_id as id, {q.normalize_word('word')} as key, list_transform({q.tokens('text')}, lambda w: {q.normalize_word('w')}) as words from entry_records where text is not null),
      cand as (select * from c where len(words) > 0),
      rf as (select distinct key, words from (select key, list_transform({q.tokens('text')}, lambda w: {q.normalize_word('w')}) as words from r where text is not null) where len(words) > 0),
      refs as (select row_number() over () as ref, key, words from rf),
      cg as (select id, key, n, array_to_string(words[i:i + n - 1], ' ') as g, count(*) as c from (select *, unnest(range(1, 5)) as n from cand) cross join lateral (select unnest(range(1, len(words) - n + 2)) as i) group by all),
      rg as (select key, g, max(c) as r from (select ref, key, array_to_string(words[i:i + n - 1], ' ') as g, count(*) as c from (select *, unnest(range(1, 5)) as n from refs) cross join lateral (select unnest(range(1, len(words) - n + 2)) as i) group by all) group by all),
      st as (select id, n, sum(least(c, coalesce(r, 0))) as m, sum(c) as t from cg left join rg using (key, g) group by all),
      s as (select id, avg(ln(m / t)) filter (where m > 0) as l, min(m) as least_m, avg(m / t) as precision from st group by all),
      cl as (select id, len(c.words) as len, arg_min(len(f.words), (abs(len(f.words) - len(c.words)), len(f.words))) as ref_len from cand c join refs f using (key) group by all)
      select id, round(case when least_m = 0 then 0 else exp(l) * least(1, exp(1 - ref_len / len)) end, 6) as bleu, round(precision, 6) as precision from s join cl using (id)""",
    "twiddle_rank": f"""
      with {_EDGES}, l as (select parent as q, list(child order by child) as words from edges group by all),
      x as (select q, words[i] as word, i - 1 as i, len(words) as n from (select *, unnest(range(1, len(words) + 1)) as i from l)),
      g as (select *, case when word = q then 1.6 when len(q) > 1 and starts_with(word, q) then 1.4 when len(word) > 1 and starts_with(q, word) then 1.3 when contains(word, q) or contains(q, word) then 1.2
        when levenshtein(word, q) / greatest(len(word), len(q)) <= 0.3 then 1.2 when levenshtein(word, q) / greatest(len(word), len(q)) <= 0.5 then 1.1 else 1.0 end as gain from x),
      s as (select q, word, i::int as i, round(10 / (10 + i) * (case when n > 8 then pow(gain, ln(n) / ln(8)) else gain end), 9) as score from g)
      select q, word, i, score, (row_number() over (partition by q order by score desc, i))::int as place from s""",
    "word_features": f"with {_FEATURES} select key, label, round(weight, 6) as weight from feat",
    "feature_cosine": f"""
      with {_FEATURES}, a as (select distinct {q.normalize_word('word')} as seed from word_links where link_id % 20 = 0),
      s as (select key as seed, label, weight from feat where key in (select seed from a)),
      n as (select seed, sqrt(sum(weight * weight)) as norm from s group by all),
      d as (select s.seed, f.key as id, sum(s.weight * f.weight) as dot, sqrt(sum(f.weight * f.weight)) as other from s join feat f using (label) group by all)
      select seed, id, round(case when least(dot / (norm * other), 1.0) >= 0.99999 then 1.0 else least(dot / (norm * other), 1.0) end, 6) as score from d join n using (seed) where seed <> id""",
    "feature_softmax": f"with {_FEATURES} select key, label, round(exp(weight) / sum(exp(weight)) over (partition by key), 6) as share from feat",
    "age_of_acquisition": """
      with p as (select unnest(string_split(lower(p_name), ' ')) as key, p_size::double as mean from part),
      a as (select key, round(avg(mean + 3.0), 6) as aoa, count(*) as n from p where key <> '' group by all)
      select key, aoa, round(-ln(n / (select sum(n) from a) + 1e-8) + 3.5, 6) as made, round(min(aoa) over (partition by key[1] order by key rows unbounded preceding), 6) as least_so_far from a""",
    "text_forms": f"""
      select sense_id, {q.plain_signs('text')} as text, translate(translation, '{_KATA}', '{_HIRA}') as hiragana, translate(translation, '{_HIRA}', '{_KATA}') as katakana,
        {q.weight('lower(word)')} as weight
      from senses""",
    "section_translations": r"""
      with s as (select sense_id, regexp_extract(text, '\[translation\]: ([^\[]*)', 1) as s from senses where text is not null),
      m as (select sense_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(s, '\([^)]*\)', '', 'g'), '[,、，;；|/' || chr(9) || chr(10) || ']'),
        lambda m: regexp_replace(regexp_replace(m, '["“”「」''\\]', '', 'g'), '^[\s\x0b\p{Z}]+|[\s\x0b\p{Z}]+$', '', 'g')), lambda m: m <> '') as m from s)
      select sense_id, (generate_subscripts(m, 1) - 1)::int as at, unnest(m) as val from m""",
}
