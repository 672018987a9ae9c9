"""Writing systems of names: detection by blocks, folding to plain letters, Hangul arithmetic, Jaro-Winkler."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Code point ranges of each script, first to last, in hexadecimal.
BLOCKS = {
    "LATIN": "0000-024F 0250-02AF 1D00-1D7F 1E00-1EFF 2C60-2C7F A720-A7FF AB30-AB6F",
    "CYRILLIC": "0400-052F 2DE0-2DFF A640-A69F",
    "GREEK": "0370-03FF 1F00-1FFF",
    "ARABIC": "0600-06FF 0750-077F 08A0-08FF FB50-FDFF FE70-FEFF",
    "HEBREW": "0590-05FF FB18-FB4F",
    "DEVANAGARI": "0900-097F A8E0-A8FF",
    "BENGALI": "0980-09FF",
    "TAMIL": "0B80-0BFF",
    "TELUGU": "0C00-0C7F",
    "MALAYALAM": "0D00-0D7F",
    "KANNADA": "0C80-0CFF",
    "GUJARATI": "0A80-0AFF",
    "THAI": "0E00-0E7F",
    "GEORGIAN": "10A0-10FF 2D00-2D2F",
    "ARMENIAN": "0530-058F FB00-FB17",
    "HANGUL": "AC00-D7AF 1100-11FF 3130-318F A960-A97F D7B0-D7FF",
    "CJK": "4E00-9FFF 3400-4DBF 20000-2A6DF 2A700-2EBEF 30000-3134F 3000-303F F900-FAFF",
    "HIRAGANA": "3040-309F 1B000-1B0FF",
    "KATAKANA": "30A0-30FF 31F0-31FF FF65-FF9F",
}
#: Scripts that names in a language are written in; a Latin name in one of the others is romanised.
EXPECTED = {
    "zh": "CJK", "ja": "CJK HIRAGANA KATAKANA", "ko": "HANGUL CJK", "ru": "CYRILLIC", "uk": "CYRILLIC", "bg": "CYRILLIC", "sr": "CYRILLIC LATIN", "mk": "CYRILLIC",
    "be": "CYRILLIC", "kk": "CYRILLIC", "ky": "CYRILLIC", "mn": "CYRILLIC", "tg": "CYRILLIC", "el": "GREEK", "ar": "ARABIC", "fa": "ARABIC", "ur": "ARABIC", "ps": "ARABIC",
    "he": "HEBREW", "yi": "HEBREW", "hi": "DEVANAGARI", "mr": "DEVANAGARI", "ne": "DEVANAGARI", "sa": "DEVANAGARI", "bn": "BENGALI", "as": "BENGALI", "ta": "TAMIL",
    "te": "TELUGU", "ml": "MALAYALAM", "kn": "KANNADA", "gu": "GUJARATI", "th": "THAI", "ka": "GEORGIAN", "hy": "ARMENIAN",
}
#: Jamo by the order of their place in a syllable; an empty last place comes first.
LEADS, VOWELS, TAILS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ", "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ", "ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
#: Letters that decomposing leaves whole, and their plain spelling.
WHOLE = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}
FIRST, LAST = 0xAC00, 0xD7A3


def _letters(script: str, others: bool = False) -> str:
    """A pattern of one letter of a script, or of any other."""
    ranges = "".join(r"\x{%s}-\x{%s}" % tuple(r.split("-")) for r in BLOCKS[script].split())
    return rf"[\p{{L}}&&[{'^' if others else ''}{ranges}]]"


def detect(text: Column) -> Column:
    """The script of most letters, the one that comes first on ties; OTHER without letters of any."""
    patterns = F.array(*(F.struct(F.lit(s).alias("script"), F.lit(_letters(s)).alias("one")) for s in BLOCKS))
    counted = F.transform(patterns, lambda p: F.struct(F.regexp_count(text, p["one"]).alias("n"), (-F.regexp_instr(text, p["one"])).alias("at"), p["script"].alias("script")))
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))

    def decided(found: Column) -> Column:
        best, known = F.array_max(found), F.aggregate(found, F.lit(0), lambda n, f: n + f["n"])
        return F.when((best["n"] > 0) & (best["n"] >= letters - known), best["script"]).otherwise("OTHER")

    most = F.transform(F.array(counted), decided)[0]
    # Most texts are Latin throughout, which two searches tell.
    latin = text.rlike(r"\p{L}") & ~text.rlike(_letters("LATIN", others=True))
    return F.when(F.coalesce(latin, F.lit(False)), "LATIN").otherwise(F.coalesce(most, F.lit("OTHER")))


def mismatched(lang: Column, script: Column) -> Column:
    """A Latin name in a language that isn't written so."""
    other = [k for k, s in EXPECTED.items() if "LATIN" not in s.split()]
    return F.coalesce((script == "LATIN") & F.lower(F.split_part(lang, F.lit("-"), F.lit(1))).isin(other), F.lit(False))


#: Accented letters and their plain letters, of Latin-1 and Latin Extended-A.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćĉċčďēĕėęěĝğġģĥĩīĭįĵķĺļľńņňōŏőŕŗřśŝşšţťũūŭůűųŵŷźżž"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaaaccccdeeeeegggghiiiijklllnnnooorrrssssttuuuuuuwyzzz"


def fold(text: Column) -> Column:
    """Lower case, without the accents of Latin letters and without combining marks; other scripts stay."""
    out = F.translate(F.lower(text), ACCENTED, PLAIN)
    for letter, plain in WHOLE.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return F.regexp_replace(out, r"\p{Mn}", "")


def alnum(text: Column) -> Column:
    """Folded letters and digits alone, to compare names by."""
    return F.regexp_replace(fold(text), r"[^\p{L}\p{N}]", "")


def edge_ngrams(token: Column, least: int = 2, most: int = 20) -> Column:
    """Beginnings of a token of `least` to `most` characters."""
    end = F.least(F.length(token), F.lit(most))
    return F.when(F.coalesce(F.length(token), F.lit(0)) >= least, F.transform(F.sequence(F.lit(least), end), lambda n: F.substring(token, F.lit(1), n))).otherwise(F.array().cast("array<string>"))


def decompose_hangul(text: Column) -> Column:
    """Syllables as their jamo; other characters stay."""

    def one(c: Column) -> Column:
        at = F.ascii(c) - FIRST
        jamo = lambda table, i: F.substring(F.lit(table), i + 1, F.lit(1))
        parts = F.concat(jamo(LEADS, F.floor(at / 588).cast("int")), jamo(VOWELS, F.floor(at % 588 / 28).cast("int")), F.when(at % 28 > 0, jamo(TAILS, (at % 28 - 1).cast("int"))).otherwise(""))
        return F.when(F.ascii(c).between(FIRST, LAST), parts).otherwise(c)

    return F.when(text.rlike(r"[\x{AC00}-\x{D7A3}]"), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def compose_hangul(lead: Column, vowel: Column, tail: Column) -> Column:
    """The syllable of three jamo, the last perhaps empty or null; null if one has no such place."""
    at = lambda table, c: F.nullif(F.position(c, F.lit(table)), F.lit(0))
    last = F.when(F.coalesce(tail, F.lit("")) == "", 0).otherwise(at(TAILS, tail))
    code = FIRST + (at(LEADS, lead) - 1) * 588 + (at(VOWELS, vowel) - 1) * 28 + last
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


#: Jaro's similarity above which equal first characters count, as in Winkler's own form.
BOOSTED = 0.7


def _jaro_winkler(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, matched = [False] * len(b), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if not used[j] and b[j] == c), None)
        if j is not None:
            used[j] = True
            matched.append(c)
    m = len(matched)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(matched, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= BOOSTED:
        return jaro
    same = next((i for i in range(min(4, len(a), len(b))) if a[i] != b[i]), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro's similarity, raised by up to four equal first characters where it is above BOOSTED; null if either is."""
    return pd.Series([_jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
