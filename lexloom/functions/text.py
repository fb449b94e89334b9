"""Text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# English stop words.
STOP_WORDS = (
    "the a an be do not and or but no any some this these that those i my me mine you your yours we our us ours "
    "he his him she her hers it its they them their"
).split()
# The kana that have a counterpart, in the same order.
HIRAGANA = "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわをんぁぃぅぇぉゃゅょっがぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽゔ"
KATAKANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワヲンァィゥェォャュョッガギグゲゴザジズゼゾダヂヅデドバビブベボパピプペポヴ"
# Weights of words by kind.
NUMERIC_WEIGHT, STOP_WEIGHT = 0.2, 0.5
# Code points of quotes and dashes, and the plain form of each.
PLAIN_SIGNS = (
    (r"[\x{2018}\x{2019}\x{201A}\x{201B}\x{2758}\x{275B}\x{275C}\x{275F}\x{FF02}]", "'"),
    (r"[\x{201C}-\x{201F}]", '"'),
    (r"[\x{AD}\x{2D7}\x{2010}-\x{2015}\x{2043}\x{2212}\x{2796}\x{2E3A}\x{2E3B}\x{FE58}\x{FE63}\x{FF0D}]", "-"),
)
# Suffixes that differ between British and American spelling, either way.
SPELLING_SUFFIXES = (("se", "ze"), ("sing", "zing"), ("sed", "zed"), ("ser", "zer"), ("sation", "zation"), ("ce", "se"), ("our", "or"), ("og", "ogue"), ("re", "er"), ("l", "ll"))

SPACES = r"[\s\x0b\p{Z}]+"
JAPANESE = r"[\p{Hiragana}\p{Katakana}ー\p{Han}]"


def java(pattern: str) -> str:
    """A pattern with Unicode scripts named as Java names them."""
    for script in ("Latin", "Han", "Hiragana", "Katakana", "Common", "Cyrillic", "Greek", "Runic", "Hangul"):
        pattern = pattern.replace(f"\\p{{{script}}}", f"\\p{{Is{script}}}")
    return pattern


def sub(column: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(column, F.lit(java(pattern)), F.lit(by.replace("\\1", "$1").replace("\\2", "$2").replace("\\3", "$3").replace("\\4", "$4").replace("\\5", "$5")))


def trim(column: Column) -> Column:
    """Without outer blanks of any kind."""
    return sub(column, r"^[\s\x0b\p{Z}]+|[\s\x0b\p{Z}]+$")


@cache
def _latin_accents() -> tuple[str, str]:
    """All precomposed accented Latin letters of the first planes and their bases, by decomposition."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and unicodedata.name(base[0], "").startswith("LATIN") and all(unicodedata.category(c) == "Mn" for c in base[1:]):
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(column: Column) -> Column:
    """Latin letters without diacritics, precomposed or combining; other scripts keep their marks."""
    return F.translate(F.regexp_replace(column, r"(?<=\p{IsLatin})\p{Mn}+", ""), *_latin_accents())


def normalize_word(column: Column) -> Column:
    """The key form: blanks collapsed, middle dots dropped, lower case, Latin accents stripped, trimmed."""
    return F.trim(strip_accents(F.lower(sub(sub(column, SPACES, " "), "[・·]+"))))


def plain_signs(column: Column) -> Column:
    """Quotes and dashes in plain spelling."""
    return reduce(lambda c, rule: sub(c, *rule), PLAIN_SIGNS, column)


@pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility forms composed; the JVM has no built-in function for it."""
    return texts.map(lambda x: x if x.isascii() else unicodedata.normalize("NFKC", x), na_action="ignore")


def normalize_text(column: Column) -> Column:
    """Compatibility forms composed, quotes and dashes in plain spelling."""
    return plain_signs(nfkc(column))


def collapse(column: Column) -> Column:
    """Blanks and control characters as single spaces, none outside."""
    return F.trim(sub(column, r"[\p{Z}\p{C}]+", " "))


def is_numeric(word: Column) -> Column:
    return word.rlike("^[-0-9.]+$")


def is_stop_word(word: Column, language: str = "en") -> Column:
    """English: a listed word; Japanese: Hiragana only, date characters only, or any Latin letter; both: any digit."""
    digit = word.rlike("[0-9]")
    if language == "en":
        return digit | word.isin(STOP_WORDS)
    return digit | word.rlike(java(r"^[\p{Hiragana}ー]+$|^[年月日]+$|\p{Latin}"))


def word_weight(word: Column, language: str = "en") -> Column:
    return F.when(is_numeric(word), NUMERIC_WEIGHT).when(is_stop_word(word, language), STOP_WEIGHT).otherwise(1.0)


def predict_language(text: Column) -> Column:
    return F.when(text.rlike(java(JAPANESE)), "ja").otherwise("en")


def to_katakana(text: Column) -> Column:
    return F.translate(text, HIRAGANA, KATAKANA)


def to_hiragana(text: Column) -> Column:
    return F.translate(text, KATAKANA, HIRAGANA)


def edit_ratio(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty strings."""
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest == 0, 0.0).otherwise(F.levenshtein(a, b) / longest)


def deduplicate(words: Column) -> Column:
    """Words in order, without those too close to an earlier one that was kept (ratio 0.21, Katakana words 0.41)."""

    def step(kept: Column, word: Column) -> Column:
        limit = F.when(word.rlike(java(r"^[\p{Katakana}ー]+$")), 0.41).otherwise(0.21)
        near = F.exists(kept, lambda k: edit_ratio(normalize_word(k), normalize_word(word)) < limit)
        return F.when(near, kept).otherwise(F.array_append(kept, word))

    return F.aggregate(words, F.array().cast("array<string>"), step)


def twiddle_gain(word: Column, query: Column, count: Column) -> Column:
    """How much a word of a ranked list gains by its likeness to the query."""
    ratio = edit_ratio(word, query)
    gain = (
        F.when(word == query, 1.6)
        .when((F.char_length(query) > 1) & F.startswith(word, query), 1.4)
        .when((F.char_length(word) > 1) & F.startswith(query, word), 1.3)
        .when(F.contains(word, query) | F.contains(query, word), 1.2)
        .when(ratio <= 0.3, 1.2)
        .when(ratio <= 0.5, 1.1)
        .otherwise(1.0)
    )
    return F.when(count > 8, F.pow(gain, F.log(count.cast("double")) / F.log(F.lit(8.0)))).otherwise(gain)


def format_prob(prob: Column, digits: int = 7) -> Column:
    """A probability with fixed digits and no leading zero."""
    return F.regexp_replace(F.format_string(f"%.{digits}f", prob), r"^0\.", ".")


def spell_variants(word: Column) -> Column:
    """The other spellings of a word under the suffix pairs, either way."""
    swaps = [
        F.when(F.endswith(word, F.lit(a)) & (F.char_length(word) > len(a)), F.regexp_replace(word, f"{a}$", b))
        for pair in SPELLING_SUFFIXES
        for a, b in (pair, pair[::-1])
    ]
    return F.array_distinct(F.array_compact(F.array(*swaps)))


def display_width(char: Column) -> Column:
    """Columns that a character takes: two beyond the Latin blocks."""
    return F.when(F.ascii(char) > 256, 2).otherwise(1)


def cut_width(text: Column, width: int) -> Column:
    """The start of a text up to the character that passes a display width, with '...' where more follows."""
    start = F.struct(F.lit("").alias("out"), F.lit(width).alias("left"), F.lit(False).alias("full"))

    def step(acc: Column, c: Column) -> Column:
        full = acc["full"] | (acc["left"] < 0)
        return F.struct(F.when(full, acc["out"]).otherwise(F.concat(acc["out"], c)).alias("out"), (acc["left"] - display_width(c)).alias("left"), full.alias("full"))

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step, lambda acc: F.when(acc["full"], F.concat(acc["out"], F.lit("..."))).otherwise(acc["out"]))


def words_within(words: Column, width: int, least: int) -> Column:
    """The first words that a display width holds, two columns between them, but `least` of them at any rate."""
    size = lambda w: F.aggregate(F.filter(F.split(w, ""), lambda c: c != ""), F.lit(0), lambda n, c: n + display_width(c))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def step(acc: Column, w: Column) -> Column:
        full = acc["full"] | ((F.size(acc["out"]) >= least) & (acc["used"] + size(w) > width))
        return F.struct(F.when(full, acc["out"]).otherwise(F.array_append(acc["out"], w)).alias("out"), (acc["used"] + size(w) + 2).alias("used"), full.alias("full"))

    return F.aggregate(F.filter(F.transform(words, trim), lambda w: w != ""), start, step, lambda acc: acc["out"])


def sentence_key(text: Column) -> Column:
    """A sentence as one character per word, by a hash over 55,294 code points, so that edit distance counts words."""
    words = F.filter(F.split(sub(F.lower(text), r"[^ \p{Latin}]+"), " "), lambda w: w != "")
    code = lambda w: F.pmod(F.xxhash64(w), F.lit(0xD7FE)) + 1
    return F.array_join(F.transform(words, lambda w: F.decode(F.unhex(F.lpad(F.hex(code(w)), 4, "0")), "UTF-16BE")), "")


def clean_sentence(text: Column) -> Column:
    """A sentence without bullets before it, blanks collapsed."""
    return trim(sub(sub(trim(text), "^[・*-]+ *"), SPACES, " "))


def word_id(word: Column) -> Column:
    """A word as an identifier: blanks as underscores, other signs percent-encoded with a tilde in place of the percent sign."""
    quoted = F.replace(F.replace(F.url_encode(F.replace(word, F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return F.replace(F.replace(F.replace(quoted, F.lit("%7E"), F.lit("~")), F.lit("%2F"), F.lit("/")), F.lit("%"), F.lit("~"))


def key_prefix(key: Column) -> Column:
    """The first letter of a key, '_' for anything but a small Latin letter."""
    first = F.substring(key, 1, 1)
    return F.when(first.rlike("^[a-z]$"), first).otherwise("_")


# Characters that any reader shows, and signs that markup doesn't bear.
UNSAFE_TEXT, UNSAFE_SIGNS = r"[^\x20-\x7F\p{Han}\p{Hiragana}\p{Katakana}ー・、。々]", r"[\\{}`]"
# Fixed value: what is in none of the scripts that readers have letters for.
FOREIGN_SCRIPT = r"[^\s\p{Common}\p{Latin}\p{Cyrillic}\p{Greek}\p{Runic}\p{Han}\p{Hangul}\p{Hiragana}\p{Katakana}ー]"


def is_safe_text(text: Column) -> Column:
    return ~text.rlike(java(UNSAFE_TEXT)) & ~text.rlike(UNSAFE_SIGNS)


def sanitize(text: Column) -> Column:
    """Characters of rare scripts and beyond the basic plane as boxes, blanks and control characters collapsed."""
    boxed = sub(sub(text, FOREIGN_SCRIPT, "□"), r"[^\x{0}-\x{FFFF}]", "□")
    return trim(sub(boxed, r"[\s\p{C}]+", " "))


def extract_translations(text: Column) -> Column:
    """The members of a text's first translation section: brackets and quotes dropped, parted by commas."""
    section = F.regexp_extract(text, r"\[translation\]: ([^\[]*)", 1)
    members = F.split(sub(section, r"\([^)]*\)"), "[,、，;；|/\t\n]")
    return F.filter(F.transform(members, lambda m: trim(sub(m, r"[\"“”「」'\\\\]"))), lambda m: m != "")


def derivative_stems(word: Column) -> Column:
    """Candidate stems of a derived word, by suffix; evidence is left to a join with probabilities."""
    # Suffix, repair, least length of the stem.
    rules = (
        ("iness", "y", 3), ("ness", "", 3), ("ability", "able", 2), ("ibility", "ible", 2), ("ity", "", 3), ("ity", "e", 3), ("ization", "ize", 3), ("ation", "ate", 3),
        ("ation", "", 4), ("ation", "e", 3), ("ion", "", 4), ("ion", "e", 4), ("ment", "", 3), ("er", "", 3), ("er", "e", 3), ("or", "", 4), ("or", "e", 3), ("ist", "", 4),
        ("ism", "", 4), ("ize", "", 4), ("ify", "", 3), ("ily", "y", 3), ("ally", "al", 3), ("ly", "", 3), ("able", "", 3), ("able", "e", 3), ("ible", "", 3), ("ful", "", 3),
        ("less", "", 3), ("ous", "", 4), ("ive", "", 4), ("ive", "e", 3), ("al", "", 4), ("al", "e", 4), ("ic", "", 4), ("ish", "", 3), ("ing", "", 3), ("ing", "e", 3), ("ed", "", 3), ("ed", "e", 3),
    )
    stems = [F.when(F.endswith(word, F.lit(s)) & (F.char_length(word) >= len(s) + n), F.regexp_replace(word, f"{s}$", r)) for s, r, n in rules]
    return F.array_distinct(F.array_compact(F.array(*stems)))
