"""One consistent form for text that looks the same but is stored in different characters.

`fold` settles everything that one character decides (width, blanks, unseen characters, hyphens, joined letters, the storage of
accents and sound marks). Look-alike letters of another alphabet need their token: `resolve` gives a token the script that its
unmistakable letters have, and `unify` substitutes that result only where the corpus vocabulary bears it out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

# The kinds of hyphen that cannot be told apart.
HYPHENS = "-‐‑﹣－"
# Letters without ink.
BLANK_LETTERS = "ᅟᅠ⠀ㅤﾠ"
# Marks without ink that are no format characters.
UNSEEN_MARKS = "͏឴឵᠋᠌᠍᠏"
# Look-alikes of Latin letters, by script; each string is read in pairs (other letter, Latin letter).
CYRILLIC = "аaсcеeһhіiјjӏlоoрpԛqѕsԝwхxуyԁdѵvАAВBСCЕEНHІIЈJКKМMОOРPЅSТTХXҮYԚQԜWӀI"
GREEK = "αaγyιiκkνvοoρpυuχxΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
ARMENIAN = "օoոnսuհhցgզqյjՕOՏSՍU"
LATIN_OTHER = "ɡg"
# Look-alikes of Katakana among Han and Hiragana, in pairs (other, Katakana).
KANA = "夕タ工エ力カ二ニ八ハ卜ト口ロ一ーへヘべベぺペ"


def _pairs(text: str) -> dict[str, str]:
    return dict(zip(text[::2], text[1::2]))


_TO_LATIN = _pairs(CYRILLIC) | _pairs(GREEK) | _pairs(ARMENIAN) | _pairs(LATIN_OTHER)
_FROM_LATIN = {name: {b: a for a, b in reversed(_pairs(s).items())} for name, s in (("CYRILLIC", CYRILLIC), ("GREEK", GREEK), ("ARMENIAN", ARMENIAN))}
_SHARED_LATIN = {b for m in _FROM_LATIN.values() for b in m}
_KANA = _pairs(KANA)
_HAN_OF = {b: a for a, b in _KANA.items() if "CJK" in unicodedata.name(a)}
_HIRAGANA_OF = {b: a for a, b in _KANA.items() if "HIRAGANA" in unicodedata.name(a)}
_LATIN_TABLE = str.maketrans(_TO_LATIN)
_KANA_TABLE = str.maketrans(_KANA)

_ODD_LETTER = regex.compile(f"[{''.join(_TO_LATIN)}\\p{{Cyrillic}}\\p{{Greek}}\\p{{Armenian}}]")
_ODD_KANA = regex.compile(f"[{''.join(_KANA)}{''.join(_KANA.values())}]")
#: Characters that `fold` never changes, when blanks are single; anything else takes the full way.
_PLAIN = regex.compile("[!-~ À-ÖØ-ſɐ-ɠɢ-ʯˈˌḀ-ỿぁ-ゖァ-ヺー一-龥、。「」【】“”‘’…—–]*")
_PLAIN_LINES = regex.compile(_PLAIN.pattern.replace("[!", "[\\s!"))
_ODD_HAN = re.compile(f"[{''.join(_KANA)}]")
_ASCII_WORD = re.compile("[a-z0-9]+")
_PLAIN_WORD = re.compile(r"[^\W_]+")
_WORD = regex.compile(r"[\p{L}\p{M}\p{Nd}]+")
_TOKEN = regex.compile(r"[\p{L}\p{M}]+")
_BLANKS = regex.compile(" {2,}")


class _CharTable(dict):
    """What one character becomes, worked out from its Unicode properties when it is first met."""

    def __missing__(self, code: int) -> str:
        self[code] = value = _fold_char(chr(code))
        return value


def _fold_char(ch: str) -> str:
    kind = unicodedata.category(ch)
    if ch in HYPHENS:
        return "-"
    if ch.isspace() or kind in ("Zs", "Zl", "Zp") or ch in BLANK_LETTERS:
        return " "
    if kind in ("Cf", "Cc") or ch in UNSEEN_MARKS or "VARIATION SELECTOR" in unicodedata.name(ch, ""):
        return ""
    if ch in "゛゜":  # spacing sound marks
        return chr(ord(ch) - 2)
    tag, _, codes = unicodedata.decomposition(ch).partition("> ")
    joined = tag == "<compat" and (kind[0] == "L" or kind == "Nl" or 0x2E80 <= ord(ch) <= 0x2FDF) and ch != "ſ"
    if codes and (tag in ("<wide", "<narrow", "<small", "<font") or joined):
        return "".join(_fold_char(chr(int(x, 16))) for x in codes.split())
    return ch


_TABLE = _CharTable()


def fold(text: str) -> str:
    """`text` in one form as far as single characters decide it; blanks become single spaces, outer ones go."""
    if not _PLAIN.fullmatch(text):
        text = unicodedata.normalize("NFC", text.translate(_TABLE))
    if "  " in text:
        text = _BLANKS.sub(" ", text)
    return text.strip(" ")


def _to_latin(text: str) -> str:
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_LATIN_TABLE))


def skeleton(text: str) -> str:
    """Folded text with every look-alike in one script: strings look the same exactly if their skeletons are equal."""
    if text.isascii():
        return text
    if _ODD_LETTER.search(text):
        text = _to_latin(text)
    return text.translate(_KANA_TABLE)


def words(text: str) -> list[str]:
    """The words of a text: unbroken runs of letters and digits, look-alikes in one script, in lower case."""
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    if _PLAIN_LINES.fullmatch(text):
        return _PLAIN_WORD.findall((text.translate(_KANA_TABLE) if _ODD_HAN.search(text) else text).lower())
    return _WORD.findall(skeleton(fold(text)).lower())


def _script(ch: str) -> str:
    return unicodedata.name(ch, "").split(" ", 1)[0]


def resolve(token: str) -> str:
    """The token with its look-alikes in the script of its unmistakable letters; a function of the token's skeleton alone.

    Alphabets: the script with most unmistakable letters wins, Latin if none has any. Kana and Han: a look-alike goes with its
    nearest unmistakable neighbours, Katakana first.
    """
    if token.isascii():
        return token
    if _ODD_LETTER.search(token):
        plain = _to_latin(token)
        votes: dict[str, int] = {}
        for ch in unicodedata.normalize("NFD", plain):
            if ch not in _SHARED_LATIN and (script := _script(ch)) in ("LATIN", *_FROM_LATIN):
                votes[script] = votes.get(script, 0) + 1
        best = max(votes, key=lambda s: (votes[s], s == "LATIN", s), default="LATIN")
        if best in _FROM_LATIN:
            plain = unicodedata.normalize("NFC", "".join(_FROM_LATIN[best].get(c, c) for c in unicodedata.normalize("NFD", plain)))
        token = plain
    if _ODD_KANA.search(token):
        bones = token.translate(_KANA_TABLE)
        sure = [None if c in _HAN_OF or c in _HIRAGANA_OF else _script(c) for c in bones]
        left, seen = [], None
        for s in sure:
            seen = s or seen
            left.append(seen)
        right, seen = [], None
        for s in reversed(sure):
            seen = s or seen
            right.append(seen)
        out = []
        for c, a, b in zip(bones, left, reversed(right)):
            if c in _HAN_OF and "KATAKANA" not in (a, b) and "CJK" in (a, b):
                c = _HAN_OF[c]
            elif c in _HIRAGANA_OF and (a == "HIRAGANA" or a != "KATAKANA" and b != "KATAKANA" and (a or b)):
                c = _HIRAGANA_OF[c]
            out.append(c)
        token = "".join(out)
    return token


def _doubtful(folded: str) -> bool:
    return not folded.isascii() and bool(_ODD_LETTER.search(folded) or _ODD_KANA.search(folded))


def _split(alike: Callable[[str], str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, fixes, vocabulary = [], [], []
            for text in batch.column("value").to_pylist():
                folded = fold(text)
                row, own, clean = [folded], [], []
                if _doubtful(folded):
                    row, at = [], 0
                    for m in _TOKEN.finditer(folded):
                        token, better = m.group(), resolve(m.group())
                        if token == better:
                            clean.append(alike(token))
                            continue
                        row += [folded[at : m.start()], token]
                        own.append({"at": len(row) - 1, "surface": token, "better": better, "key": alike(better)})
                        at = m.end()
                    row.append(folded[at:])
                elif folded:
                    clean = map(alike, _TOKEN.findall(folded))
                parts.append(row)
                fixes.append(own)
                vocabulary.append(list(dict.fromkeys(clean)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), pa.array(parts, pa.list_(pa.string())), pa.array(fixes, _FIXES), pa.array(vocabulary, pa.list_(pa.string()))],
                names=["row_key", "parts", "fixes", "words"],
            )

    return run


_FIXES = pa.list_(pa.struct([(name, pa.int32() if name == "at" else pa.string()) for name in ("at", "surface", "better", "key")]))


def _itself(token: str) -> str:
    return token


def unify(values: DataFrame, alike: Callable[[str], str] = _itself) -> DataFrame:
    """Bring every value to one consistent form by script-aware repair.

    `values` has row_key (any type, unique) and value (string); other columns are ignored. The result has row_key and unified.
    A token whose letters are of mixed script, or all look-alikes, is replaced by its `resolve`d form if the corpus vocabulary
    bears it out: the form itself stands in the corpus, or a second spelling leads to it. Else it stays. Hence two values that
    look the same are equal afterwards: spellings of one token are either the same already or bear each other out. Where values
    are compared more loosely later, in key form say, `alike` gives a token that form, and the vocabulary is asked in it.

    null gives null; an empty or blank value gives ''. Repeated rows are handled each by itself. A text of any length is one
    row; its tokens are never compared with each other.
    """
    known = values.select("row_key", "value")
    kind = known.schema["row_key"].dataType.simpleString()
    schema = f"row_key {kind}, parts array<string>, fixes array<struct<at:int,surface:string,better:string,key:string>>, words array<string>"
    cut_up = cut(known.where(F.col("value").isNotNull()).mapInArrow(_split(alike), schema))  # read five times below
    each = cut_up.where(F.size("fixes") > 0).select("row_key", F.explode("fixes").alias("f")).select("row_key", "f.*")
    wanted = each.groupBy("key").agg((F.min("surface") != F.max("surface")).alias("twice"))
    vocabulary = cut_up.select(F.explode("words").alias("key")).distinct().withColumn("clean", F.lit(True))
    borne_out = wanted.join(vocabulary, "key", "left").where(F.col("twice") | F.col("clean").isNotNull()).select("key")
    fixed = each.join(borne_out, "key").groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("at", "better"))).alias("put"))
    clean = cut_up.where(F.size("fixes") == 0).select("row_key", F.element_at("parts", 1).alias("unified"))
    doubtful = (
        cut_up.where(F.size("fixes") > 0)
        .join(fixed, "row_key", "left")
        .select("row_key", F.array_join(F.transform("parts", lambda part, i: F.coalesce(F.col("put")[i], part)), "").alias("unified"))
    )
    empty = known.where(F.col("value").isNull()).select("row_key", F.lit(None).cast("string").alias("unified"))
    return clean.unionByName(doubtful).unionByName(empty)


def same_look(rows: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Pairs of rows (field, id_a, id_b), id_a < id_b, whose values in a field differ in characters but look the same.

    Values that are null don't count; blank values look alike as any others do. Only values that have a differing twin are
    paired, and only digests of 128 bits travel. Blanks make no difference at any place, as TESTDATA.md states.
    """
    long = None
    for field in fields:
        one = rows.select(F.lit(field).alias("field"), F.col(id_col).alias("id"), F.col(field).cast("string").alias("value"))
        long = one if long is None else long.unionByName(one)
    long = long.where(F.col("value").isNotNull())
    united = unify(long.select(F.struct("field", "id", _digest("value").alias("raw")).alias("row_key"), "value"))
    keyed = united.select("row_key.*", _digest(F.replace("unified", F.lit(" "), F.lit(""))).alias("look"))
    differing = keyed.groupBy("field", "look").agg(F.min("raw").alias("least"), F.max("raw").alias("most")).where("least != most").select("field", "look")
    members = cut(keyed.join(differing, ["field", "look"]))
    # spellings are paired first, so that rows of one spelling never meet each other
    spelling = members.select("field", "look", "raw").distinct()
    pairs = spelling.withColumnRenamed("raw", "raw_a").join(spelling.withColumnRenamed("raw", "raw_b"), ["field", "look"]).where("raw_a < raw_b")
    a = members.withColumnsRenamed({"id": "a", "raw": "raw_a"})
    b = members.withColumnsRenamed({"id": "b", "raw": "raw_b"})
    met = pairs.join(a, ["field", "look", "raw_a"]).join(b, ["field", "look", "raw_b"])
    return met.select("field", F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def _digest(column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.substring(F.sha2(column, 256), 1, 32)
