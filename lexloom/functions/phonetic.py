"""Phonetic alphabets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs of X-SAMPA and of the international alphabet, in pairs parted by commas; ∅ stands for no sign.
SAMPA = r"""
a a , b b , b_< ɓ , c c , d d , d` ɖ , d_< ɗ , e e , f f , g ɡ , g_< ɠ , h h , h\ ɦ , i i , j j , j\ ʝ , k k , l l , l` ɭ , l\ ɺ , m m , n n , n` ɳ
o o , p p , p\ ɸ , q q , r r , r` ɽ , r\ ɹ , r\` ɻ , s s , s` ʂ , s\ ɕ , t t , t` ʈ , u u , v v , v\ ʋ , w w , x x , x\ ɧ , y y , z z , z` ʐ , z\ ʑ
A ɑ , B β , B\ ʙ , C ç , D ð , E ɛ , F ɱ , G ɣ , G\ ɢ , G\_< ʛ , H ɥ , H\ ʜ , I ɪ , I\ ᵻ , J ɲ , J\ ɟ , J\_< ʄ , K ɬ , K\ ɮ , L ʎ , L\ ʟ , M ɯ , M\ ɰ
N ŋ , N\ ɴ , O ɔ , O\ ʘ , P ʋ , Q ɒ , R ʁ , R\ ʀ , S ʃ , T θ , U ʊ , U\ ᵿ , V ʌ , W ʍ , X χ , X\ ħ , Y ʏ , Z ʒ , . . , " ˈ , % ˌ , ' ʲ , : ː , :\ ˑ
- ∅ , @ ə , @\ ɘ , @` ɚ , { æ , } ʉ , 1 ɨ , 2 ø , 3 ɜ , 3\ ɞ , 4 ɾ , 5 ɫ , 6 ɐ , 7 ɤ , 8 ɵ , 9 œ , & ɶ , ? ʔ , ?\ ʕ , * ∅ , / ∅ , < ∅ , <\ ʢ , > ∅
>\ ʡ , ^ ꜛ , ! ꜜ , !\ ǃ , | | , |\ ǀ , || ‖ , ||\ ǁ , =\ ǂ , -\ ‿ , _" ̈ , _+ ̟ , _- ̠ , _/ ̌ , _0 ̥ , _< ∅ , = ̩ , _> ʼ , _?\ ˤ , _\ ̂ , _^ ̯ , _} ̚
` ˞ , ~ ̃ , _A ̘ , _a ̺ , _B ̏ , _B_L ᷅ , _c ̜ , _d ̪ , _e ̴ , <F> ↘ , _F ̂ , _G ˠ , _H ́ , _H_T ᷄ , _h ʰ , _j ʲ , _k ̰ , _L ̀ , _l ˡ , _M ̄ , _m ̻
_N ̼ , _n ⁿ , _O ̹ , _o ̞ , _q ̙ , <R> ↗ , _ ̌ , _R_F ᷈ , _ ̝ , _T ̋ , _t ̤ , _v ̬ , _w ʷ , _X ̆ , _x ̽
"""


def _signs() -> dict[str, str]:
    """Each sign once, as it is told first."""
    pairs = [pair.split(" ") for pair in SAMPA.strip().replace("\n", " , ").split(" , ")]
    return {sampa: "" if ipa == "∅" else ipa for sampa, ipa in reversed(pairs)}


def sampa_to_ipa(sampa: Column) -> Column:
    """X-SAMPA as signs of the international alphabet, the longest sign first; brackets and other characters than ASCII are left out.

    null for a text with an ASCII character that no sign begins with.
    """
    signs = _signs()
    longest_first = "|".join(re.escape(s) for s in sorted(signs, key=len, reverse=True))
    parts = F.regexp_extract_all(sampa, F.lit(f"(?s)(?:{longest_first}|.)"), F.lit(0))
    sign = F.create_map(*(F.lit(x) for pair in signs.items() for x in pair))
    known = F.forall(parts, lambda p: sign[p].isNotNull() | p.isin("(", ")") | p.rlike(r"[^\x00-\x7F]"))
    return F.when(known, F.array_join(F.transform(parts, lambda p: F.coalesce(sign[p], F.lit(""))), ""))
