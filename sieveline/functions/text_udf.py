"""The few text functions that the JVM has no expression for, as Arrow-batched pandas UDFs."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Function words of English, and stop words of other languages in Latin script.
ENGLISH_WORDS = frozenset("after also an and are as at based be been before between both but by can during for found from has have however in is it its not of on or our results show shown study such than that the their therefore these this thus to used using was we were when which with".split())
OTHER_WORDS = frozenset("ainsi al alla anche au auch aux avec bei bij ces cette che com come como con dal dans das degli dei del delle dem den der des desarrollo desde die dieser dont door dos durch ein eine einer el elle entre est esta este foi fue gli han het il ist kann las le les leur lo los mais met mit nach nel nella nicht niet nos nous objetivo onder ont par para pela plus por pour que questo se ser sich sind sobre son sono sont sulla sur sus tambi uma und una une van von werden wie wird zur".split())
WINDOW, STEP = 50, 10
RES_MIN_CHARS, WIN_MAX = 200, 0.15
HARD, HARD_LOW, HARD_LOW_WIN = 0.35, 0.20, 0.05
NE_DENSITY, NE_HITS, LATIN1 = 0.10, 6, 0.30

FEATURES = T.StructType(
    [T.StructField("hard", T.DoubleType()), T.StructField("res_len", T.IntegerType()), T.StructField("res_words", T.IntegerType()), T.StructField("win_max", T.DoubleType()), T.StructField("ne_hits", T.IntegerType()), T.StructField("ne_d", T.DoubleType()), T.StructField("l1_ratio", T.DoubleType())]
)


_ASCII = {c: " " for c in range(128) if not chr(c).isalnum()}


def words_of(s: str | None) -> list[str]:
    """NFKC, lower case, cut at every run of non-word characters or underscores."""
    if not s or s.isascii():
        return (s or "").lower().translate(_ASCII).split()
    return re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", s).lower()).split()


@F.pandas_udf(T.StringType())
def nfkc_words(texts: pd.Series) -> pd.Series:
    """The words of each text with one space between them."""
    return texts.map(lambda s: " ".join(words_of(s)))


@lru_cache(maxsize=1 << 16)
def char_class(ch: str) -> str:
    """``l`` Latin, ``g`` Greek, ``o`` a letter of another script, ``x`` no letter; by the character's name."""
    if not ch.isalpha():
        return "x"
    if ch in "ªº":
        return "l"
    name = unicodedata.name(ch, "")
    return "l" if name.startswith("LATIN") else "g" if name.startswith("GREEK") else "o"


def features(text: str | None) -> tuple[float, int, int, float, int, float, float]:
    """How foreign a text is, by letters and by words. The residue is the text without letters of other scripts."""
    s = text or ""
    classes = [char_class(c) for c in s]
    other = classes.count("o")
    letters = len(s) - classes.count("x")
    residue = " ".join("".join(" " if k == "o" else c for c, k in zip(s, classes)).split())
    low = residue.lower()
    words = re.findall("[A-Za-z]+", low)
    known = [w in ENGLISH_WORDS for w in words]
    n = len(words)
    if n <= WINDOW:
        best = sum(known) / n if n else 0.0
    else:
        best = max(sum(known[i : i + WINDOW]) for i in range(0, n - WINDOW + 1, STEP)) / WINDOW
    foreign = sum(t.isalpha() and t in OTHER_WORDS for t in re.findall("[A-Za-z0-9]+", low))
    latin1 = sum("\xa0" <= c <= "\xff" for c in s)
    return (other / letters if letters else 0.0, len(residue), n, round(best, 2), foreign, foreign / n if n else 0.0, latin1 / len(s) if s else 0.0)


@F.pandas_udf(FEATURES)
def language_features(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([features(t) for t in texts], columns=[f.name for f in FEATURES])


def language_state(text: Column, f: Column) -> Column:
    """One of eight states from the features ``f`` of ``text``; native, so the thresholds stay visible to the optimiser."""
    usable = (f["res_len"] >= RES_MIN_CHARS) & (f["win_max"] >= WIN_MAX)
    return (
        F.when(~F.coalesce(text, F.lit("")).rlike(r"[^\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"), "not_applicable")
        .when(~usable & ((f["hard"] >= HARD) | ((f["hard"] >= HARD_LOW) & (f["win_max"] < HARD_LOW_WIN))), "non_english_script")
        .when(~usable & (f["hard"] < 0.05) & (f["ne_d"] >= NE_DENSITY) & (f["ne_hits"] >= NE_HITS), "non_english_latin")
        .when(~usable & (f["hard"] < 0.05) & (f["l1_ratio"] >= LATIN1), "mojibake")
        .when(~usable, "low_english_undetermined")
        .when(f["hard"] >= 0.05, "english_bilingual_script")
        .when(f["ne_d"] >= NE_DENSITY, "english_bilingual_latin")
        .otherwise("english")
    )
