"""Sentences, tokens and document clean-up as Column expressions."""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ..functions.text import normalize_word, sub, trim

# Titles and abbreviations that end no sentence; the latter in any letter case.
TITLES = "Mr Mrs Dr Prof Esq".split()
ABBREVIATIONS = "e.g eg i.e ie c.f cf p.s ps".split()
# The rules that prepare a sentence for tokens.
TOKEN_RULES = (
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.", r"\1\2\3\4\5"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.(\p{Lu})\.", r"\1\2\3\4"),
    (r"(^|[^\p{L}\p{N}_])(\p{Lu})\.(\p{Lu})\.", r"\1\2\3"),
    (r"[\p{Ps}\p{Pe}\p{Pi}\p{Pf}\p{S}~!@#$%^&*+|\\:;,/?]", " "),
)
# Fixed value: a simple token.
TOKEN = r"-?[\p{Latin}0-9]+[-_'\p{Latin}0-9]*"
# Characters that a readable sentence does not begin with, and those it ends with.
BAD_HEADS, GOOD_TAILS = ".?!。？！,;、", ".?!。？！"
# The elements of wiki markup whose content is dropped, the links that are no text, the lines that are dropped.
WIKI_ELEMENTS = "ref timeline imagemap mapframe score math gallery code hiero chem poem syntaxhighlight nowiki noinclude".split()
WIKI_LINKS = "Image File Category".split()
WIKI_DROP = r"^[{|;!]|^:*(Image|File|Category):"
# The rules that turn HTML into lines.
HTML_RULES = (
    (r"[\s\x0b\p{Z}]+", " "),
    (r"<!--.*?-->", ""),
    (r"^.*<body[^>]*>", ""),
    (r"</body>.*$", ""),
    (r"(?i)<script[^>]*>.*?</script>", ""),
    (r"(?i)<style[^>]*>.*?</style>", ""),
    (r"(?i)<h([123])(>|\s[^>]*>)", "\n[head\\1]: "),
    (r"(?i)</?(h\d|p|div|br|li|dt|dd|tr)(>|\s[^>]*>)", "\n"),
    (r"(?i)<(th|td)(>|\s[^>]*>)", " "),
    (r"<[^>]*>", ""),
)
META, PAGE = "====[META]====", "====[PAGE]===="


def _chain(column: Column, rules) -> Column:
    return reduce(lambda c, rule: sub(c, *rule), rules, column)


def _lines(column: Column) -> Column:
    return F.filter(F.transform(F.split(column, "\n"), trim), lambda x: x != "")


def _ends_no_sentence() -> str:
    """A look-behind: the stop before belongs to a title or an abbreviation."""
    quoted = lambda words: "|".join(w.replace(".", r"\.") for w in words)
    return rf"(?<!(?:^|[^\p{{L}}\p{{N}}_])(?:{quoted(TITLES)}|(?i:{quoted(ABBREVIATIONS)}))\.)"


#: Blanks between the stops of initials, which are no gaps between words.
_WITHIN_INITIALS = r" (?<=(?:^|[^\p{L}\p{N}_])\p{Lu}\. ) *(?=\p{Lu}\.)"
#: Where a sentence ends: at a line's end, behind an ideographic stop, and in the blanks between a stop and a capital.
_BOUNDARY = rf"\n|(?<=。)|(?<=[.?!]){_ends_no_sentence()} +(?=[\"\p{{Lu}}\p{{Lo}}])"


def sentences(text: Column) -> Column:
    """The sentences of a text: array<string>; null and blank texts have none. Initials are drawn together."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), _WITHIN_INITIALS, ""), _BOUNDARY)
    return F.filter(F.transform(parts, trim), lambda x: x != "")


def tokens(sentence: Column, lowering: bool = False) -> Column:
    """The simple tokens of a sentence, with `lowering` in key form."""
    found = F.regexp_extract_all(_chain(sentence, TOKEN_RULES), F.lit(TOKEN.replace(r"\p{Latin}", r"\p{IsLatin}")), F.lit(0))
    return key_forms(found) if lowering else found


def key_forms(words: Column) -> Column:
    """Words without blanks in key form: all at once, for a call for each word costs more than the work."""
    return F.filter(F.split(normalize_word(F.array_join(words, "\x01")), "\x01"), lambda w: w != "")


def tokenize(df: DataFrame, language: str, text: str, lowering: bool = False, plugins: dict | None = None) -> Column:
    """Tokens in a language: English by rule, others by a plug-in that maps a Column to an array<string> Column."""
    if language in (plugins or {}):
        return plugins[language](df[text])
    if language != "en":
        raise ValueError(f"no tokenizer for {language}")
    return tokens(df[text], lowering)


def document_sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", cap: int | None = None) -> DataFrame:
    """One row per sentence: the id, sent_id (from 0), sentence; with `cap`, only the first `cap` sentences of a document."""
    found = sentences(F.col(text_col))
    return documents.select(id_col, F.posexplode(F.slice(found, 1, cap) if cap is not None else found).alias("sent_id", "sentence"))


def readable(sentence: Column) -> Column:
    """Whether a sentence begins and ends as one that can be read by itself."""
    return ~F.substring(sentence, 1, 1).isin(list(BAD_HEADS)) & F.substring(sentence, -1, 1).isin(list(GOOD_TAILS))


def readable_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int | None = None) -> DataFrame:
    """The readable sentences of each document, tokenised, without those of fewer than six words: id, place, words.

    With `most`, only the middle `most` readable sentences of a document.
    """
    good = documents.select(id_col, F.filter(sentences(F.col(text_col)), readable).alias("s"))
    if most is not None:
        begin = F.floor(F.greatest(F.size("s") - most, F.lit(0)) / 2.5).cast("int")
        good = good.select(id_col, F.slice("s", begin + 1, F.lit(most)).alias("s"))
    each = good.select(id_col, F.posexplode("s").alias("place", "sentence"))
    return each.select(id_col, "place", tokens(F.col("sentence")).alias("words")).where(F.size("words") >= 6)


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def _without_elements(text: Column) -> Column:
    """Without comments, elements that hold no text, rests of such elements, and all other tags."""
    elements = "(" + "|".join(WIKI_ELEMENTS) + ")"
    return _chain(text, ((r"<!--.*?-->", ""), (rf"<{elements}.*?</\1>", ""), (rf"<{_any(WIKI_ELEMENTS)}.*", ""), ("</?[a-z]+[^>]*>", "")))


def _without_links(text: Column) -> Column:
    """Links as their targets, without links to files and pages of the web."""
    return _chain(text, ((rf"\[\[{_any(WIKI_LINKS)}:.*?\]\]", ""), (r"\[\[(.*?)(?:\|.*?)?\]\]", r"\1"), (r"\[http.*?\]", "")))


def _without_templates(text: Column) -> Column:
    """Without templates, also those that begin on a line before, and without what is left of marks and entities."""
    return _chain(text, ((r"\{\{.*?\}\}", ""), (r"\|.*?\}\}", ""), (r"''+|\]\]|\}\}|&[a-zA-Z0-9]+;", "")))


def wiki_lines(text: Column) -> Column:
    """The plain lines of a wiki text: array<string>."""
    plain = _without_templates(_without_links(_without_elements(F.coalesce(text, F.lit("")))))
    kept = F.filter(_lines(plain), lambda x: ~x.rlike(WIKI_DROP))
    bare = lambda x: trim(sub(sub(sub(x, "^==+|==+$"), "^[#*:]+"), r"[\s\x0b\p{Z}]+", " "))
    return F.filter(F.transform(kept, bare), lambda x: x != "")


@pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Character references of HTML, named or numbered, as the characters they stand for."""
    return texts.map(lambda x: html.unescape(x) if "&" in x else x, na_action="ignore")


def html_text(page: Column) -> Column:
    """An HTML page as lines: its title as a META block, headings marked, tags and entities resolved."""
    title = F.regexp_extract(sub(page, r"[\s\x0b\p{Z}]+", " "), "<title[^>]*>(.*?)</title>", 1)
    body = unescape(_chain(page, HTML_RULES))
    lines = F.array_join(_lines(body), "\n")
    return F.when(title != "", F.concat_ws("\n", F.lit(META), F.concat(F.lit("[title]: "), title), F.lit(PAGE), lines)).otherwise(lines)


def cram(text: Column) -> Column:
    """Hard-wrapped lines joined to paragraphs; blank lines part them."""
    paragraphs = F.split(F.regexp_replace(text, r"\r", ""), r"\n[ \t]*(?:\n[ \t]*)+")
    return F.array_join(F.filter(F.transform(paragraphs, lambda p: trim(F.regexp_replace(p, r"[ \t]*\n[ \t]*", " "))), lambda p: p != ""), "\n")


def divide_pages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines of marked-up books: the id, page (0 for meta lines), line_no, line; markers themselves are left out.

    A line belongs to the running number of non-empty pages; the running sums stay within the document.
    """
    raw = documents.select(id_col, F.posexplode(_lines(F.coalesce(F.col(text_col), F.lit("")))).alias("line_no", "line"))
    so_far = Window.partitionBy(id_col).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marker = F.col("line").isin(META, PAGE)
    marked = raw.withColumn("block", F.sum(marker.cast("int")).over(so_far)).withColumn(
        "is_meta", F.coalesce(F.last(F.when(marker, F.col("line") == META), ignorenulls=True).over(so_far), F.lit(False))
    )
    lines = marked.where(~marker)
    page = F.dense_rank().over(Window.partitionBy(id_col, "is_meta").orderBy("block"))
    return lines.select(id_col, F.when(F.col("is_meta"), 0).otherwise(page).alias("page"), "line_no", "line")


# A word of a source sentence and its possessive ending.
SOURCE_WORD, POSSESSIVE = r"[\p{Latin}\d][-_'’\p{Latin}\d]*", r"['’]s?$"


def source_phrases(sentence: Column, longest: int = 3) -> Column:
    """The distinct n-grams of a sentence that no sign but blanks interrupts; possessive endings dropped."""
    chunks = F.filter(F.split(sub(sentence, r"[^-_'’\p{Latin}\d\s]+", "\n"), "\n"), lambda c: trim(c) != "")
    words = F.transform(chunks, lambda c: F.transform(F.regexp_extract_all(c, F.lit(SOURCE_WORD.replace(r"\p{Latin}", r"\p{IsLatin}")), F.lit(0)), lambda w: sub(w, POSSESSIVE)))
    return F.array_distinct(F.flatten(F.transform(words, lambda w: ngrams(w, longest))))


def ngrams(words: Column, longest: int) -> Column:
    """All 1..longest-grams of an array of words, joined by blanks, with repeats."""
    of = lambda n: F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.concat(*(of(n) for n in range(1, longest + 1)))
