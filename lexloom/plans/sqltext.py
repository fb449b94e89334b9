"""SQL pieces shared by the checking queries, written for an engine with RE2 patterns."""

from __future__ import annotations

import unicodedata
from functools import reduce

# The values below are stated here once more, so that a wrong one in the package shows.
STOP_WORDS = "the a an be do not and or but no any some this these that those i my me mine you your yours we our us ours he his him she her hers it its they them their".split()
SPACES = r"[\s\x0b\p{Z}]+"
PLAIN_SIGNS = (
    ("[\u2018\u2019\u201a\u201b\u2758\u275b\u275c\u275f\uff02]", "'"),
    ("[\u201c\u201d\u201e\u201f]", '"'),
    ("[\u00ad\u02d7\u2010\u2011\u2012\u2013\u2014\u2015\u2043\u2212\u2796\u2e3a\u2e3b\ufe58\ufe63\uff0d]", "-"),
)
#: Sentences: what ends none is marked by a control character before sentences are parted.
SENTENCE_RULES = (
    (r"(^|[^\p{L}\p{N}_])(Mr\.|Mrs\.|Dr\.|Prof\.|Esq\.)", "\\1\\2\x01"),
    (r"(?i)(^|[^\p{L}\p{N}_])(e\.g\.|eg\.|i\.e\.|ie\.|c\.f\.|cf\.|p\.s\.|ps\.)", "\\1\\2\x01"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu}\.) *(\p{Lu}\.) *(\p{Lu}\.) *(\p{Lu}\.)", r"\1\2\3\4\5"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu}\.) *(\p{Lu}\.) *(\p{Lu}\.)", r"\1\2\3\4"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu}\.) *(\p{Lu}\.)", r"\1\2\3"),
    (r"([.?!]) +([\"\p{Lu}\p{Lo}])", "\\1\n\\2"),
    ("\x01", ""),
    ("。", "。\n"),
)
TOKEN_RULES = (
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.", r"\1\2\3\4\5"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.", r"\1\2\3\4"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.", r"\1\2\3"),
    (r"[\p{Ps}\p{Pe}\p{Pi}\p{Pf}\p{S}~!@#$%^&*+|\\:;,/?]", " "),
)
TOKEN = r"-?[\p{Latin}0-9]+[-_'\p{Latin}0-9]*"
WIKI_ELEMENTS = "ref timeline imagemap mapframe score math gallery code hiero chem poem syntaxhighlight nowiki noinclude".split()
WIKI_DROP = r"^[{|;!]|^:*(Image|File|Category):"
WIKI_RULES = (
    (r"<!--(.*?)-->", ""), *((f"<{n}.*?</{n}>", "") for n in WIKI_ELEMENTS), (f"<({'|'.join(WIKI_ELEMENTS)}).*", ""),
    (r"</?[a-z]+[^>]*>", ""), (r"\[\[Image:(.*?)\]\]", ""), (r"\[\[File:(.*?)\]\]", ""), (r"\[\[Category:(.*?)\]\]", ""), (r"\[\[(.*?)(\|.*?)?\]\]", r"\1"),
    (r"\[http(.*?)\]", ""), (r"\{\{.*?\}\}", ""), (r"\|.*?\}\}", ""), (r"''+", ""), (r"\]\]", ""), (r"\}\}", ""), (r"&[a-zA-Z0-9]+;", ""),
)
WIKI_MARKS = ((r"^==+", ""), (r"==+$", ""), (r"^[#*:]+", ""), (SPACES, " "))
HTML_RULES = (
    (SPACES, " "), (r"<!--.*?-->", ""), (r"^.*<body[^>]*>", ""), (r"</body>.*$", ""), (r"(?i)<script[^>]*>.*?</script>", ""), (r"(?i)<style[^>]*>.*?</style>", ""),
    (r"(?i)<h([123])(>|\s[^>]*>)", "\n[head\\1]: "), (r"(?i)</?(h\d|p|div|br|li|dt|dd|tr)(>|\s[^>]*>)", "\n"), (r"(?i)<(th|td)(>|\s[^>]*>)", " "), (r"<[^>]*>", ""),
)
#: Character references that the test data have, the ampersand last.
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))
META, PAGE = "====[META]====", "====[PAGE]===="


def _latin_accents() -> tuple[str, str]:
    """Accented small Latin letters and their bases, as the Unicode names tell them."""
    marked = [c for c in map(chr, range(0xC0, 0x1F00)) if " WITH " in unicodedata.name(c, "") and unicodedata.name(c).startswith("LATIN") and len(unicodedata.normalize("NFD", c)) > 1]
    return "".join(marked), "".join(unicodedata.normalize("NFD", c)[0] for c in marked)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chain(column: str, rules) -> str:
    return reduce(lambda c, rule: f"regexp_replace({c}, {quote(rule[0])}, {quote(rule[1])}, 'g')", rules, column)


def trim(column: str) -> str:
    return chain(column, [(r"^[\s\x0b\p{Z}]+|[\s\x0b\p{Z}]+$", "")])


def normalize_word(column: str) -> str:
    """Key form: accents of Latin letters only are stripped, so sound marks of kana stay."""
    lowered = f"lower({chain(column, [(SPACES, ' '), ('[・·]+', '')])})"
    bare, base = _latin_accents()
    return f"trim(translate({chain(lowered, [(r'(' + chr(92) + r'p{Latin})' + chr(92) + r'p{Mn}+', chr(92) + '1')])}, {quote(bare)}, {quote(base)}))"


def plain_signs(column: str) -> str:
    return chain(column, PLAIN_SIGNS)


def lines(column: str) -> str:
    return f"list_filter(list_transform(string_split({column}, chr(10)), lambda x: {trim('x')}), lambda x: x <> '')"


def sentences(column: str) -> str:
    return lines(chain(f"coalesce({column}, '')", SENTENCE_RULES))


def tokens(column: str) -> str:
    return f"regexp_extract_all({chain(column, TOKEN_RULES)}, {quote(TOKEN)})"


def numeric(column: str) -> str:
    return f"regexp_matches({column}, '^[-0-9.]+$')"


def stop_word(column: str) -> str:
    return f"(regexp_matches({column}, '[0-9]') or {column} in ({', '.join(map(quote, STOP_WORDS))}))"


def weight(column: str) -> str:
    return f"(case when {numeric(column)} then 0.2::double when {stop_word(column)} then 0.5::double else 1.0::double end)"


#: Sentences of English documents, from 0 on.
ENGLISH_SENTENCES = f"""
sents as (
  select doc_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as sent_id
  from (select doc_id, {sentences('text')} as s from documents where lower(lang) = 'en')
)"""
#: Their tokens as written and in key form.
ENGLISH_TOKENS = f"""{ENGLISH_SENTENCES},
toks as (select doc_id, sent_id, {tokens('sentence')} as words from sents),
sw as (select doc_id, sent_id, words from toks where len(words) > 0),
lowered as (select doc_id, sent_id, list_transform(words, lambda w: {normalize_word('w')}) as words from sw),
n as (select count(*) as n_sentences from sw)"""
#: Key-form words with their place in the document.
ENGLISH_WORDS = f"""{ENGLISH_TOKENS},
each as (select doc_id, sent_id, unnest(words) as word, generate_subscripts(words, 1) as i from lowered),
placed as (select doc_id, sent_id, word, row_number() over (partition by doc_id order by sent_id, i) - 1 as pos from each where word <> ''),
word_cnt as (select word, count(*) as cnt from (select distinct doc_id, sent_id, word from placed) group by word)"""
#: Counts of 1- to 3-grams by sentence.
ENGLISH_NGRAMS = f"""{ENGLISH_TOKENS},
heads as (
  select doc_id, sent_id, words, len(words) as k from sw
  union all
  select doc_id, sent_id, list_concat([lower(words[1])], words[2:3]), 0 from sw where regexp_matches(words[1], '^\\p{{Lu}}[-\\p{{Ll}}]+$')
),
grams as (
  select doc_id, sent_id, array_to_string(words[i:i + m - 1], ' ') as phrase
  from (select *, unnest(range(1, 4)) as m from heads) cross join lateral (select unnest(range(1, (case when k = 0 then 1 else k - m + 1 end) + 1)) as i)
  where len(words) >= i + m - 1
),
ngram_cnt as (select phrase, count(*) as cnt from (select distinct doc_id, sent_id, phrase from grams) group by phrase)"""
#: Probabilities of phrases, as likely as their shape demands.
ENGLISH_PROBS = ENGLISH_NGRAMS + r""",
probs as (
  select phrase, cnt, cnt / n_sentences as prob from ngram_cnt, n
  where cnt / n_sentences >= (case when contains(phrase, ' ') then 1e-6 else 1e-7 end)
    * (case when regexp_matches(phrase, '\d|(^|[^\p{L}\p{N}_])-|-($|[^\p{L}\p{N}_])') then 10 else 1 end)
)"""
#: Co-occurrence sums of words in at least four weighted sentences.
ENGLISH_COOCS = f"""{ENGLISH_WORDS},
frequent as (select word from word_cnt where cnt * {weight('word')} >= 4),
kept as (select p.* from placed p join frequent using (word)),
anchors as (select doc_id, sent_id, word, min(pos) as pos from kept group by all),
best as (
  select a.doc_id, a.pos, a.word, b.word as cooc,
    max(floor(1000 * pow(0.95::double, (abs(a.pos - b.pos) - 1)::double) * (case when a.sent_id = b.sent_id then 1.0::double else 0.5::double end)))::bigint as score
  from anchors a join kept b on a.doc_id = b.doc_id and b.pos between a.pos - 20 and a.pos + 20 and a.word <> b.word
  group by all
),
coocs as (select word, cooc, sum(score)::bigint as score from best group by all),
top_coocs as (
  select word, cooc, score, row_number() over (partition by word order by round(v, 6) desc, cooc) as rank from (
    select c.word, c.cooc, c.score, c.score * pow(least(-ln(o.cnt / n_sentences), 10.0), 1.5) * {weight('c.word')} * {weight('c.cooc')} as v
    from coocs c join word_cnt o on o.word = c.cooc cross join n
    where c.score * {weight('c.word')} * {weight('c.cooc')} >= 1000
  ) qualify row_number() over (partition by word order by round(v, 6) desc, cooc) <= 256
),
word_prob as (select word, cnt / n_sentences as prob from word_cnt, n),
cooc_prob as (
  select word, cooc, prob, row_number() over (partition by word order by round(v, 9) desc, cooc) as rank from (
    select *, prob * pow(least(-ln(cooc_p), 10.0), 1.5) * {weight('cooc')} as v from (
      select t.word, t.cooc, o.prob as cooc_p, t.score / 1000 / greatest(round_even(w.prob * n_sentences, 0), 1) as prob
      from top_coocs t join word_prob w on w.word = t.word join word_prob o on o.word = t.cooc cross join n)
  ) qualify row_number() over (partition by word order by round(v, 9) desc, cooc) <= 256
),
score_rows as (
  select c.word, floor(round(pow(least(-ln(w.prob), 10.0), 1.5) * {weight('c.word')} * 1000, 6))::bigint as idf_score, c.cooc,
    floor(round(least(c.prob, 0.05) * pow(least(-ln(o.prob), 10.0), 1.5) * {weight('c.cooc')} * 1000, 6))::bigint as cooc_score
  from cooc_prob c join word_prob w on w.word = c.word join word_prob o on o.word = c.cooc
),
score_table as (
  select word, idf_score, cooc, cooc_score from score_rows
  qualify row_number() over (partition by word order by cooc_score desc, cooc) <= 128
)"""
