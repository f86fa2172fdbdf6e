"""Scalar text functions as native column expressions; inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

#: White space as Unicode has it (rules use ASCII white space instead; see ``dialect``).
USPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Fixed values.
STOP = "a an the of in on for and or to with by from at as into via under over between among during after before through vs versus is are be its their using based study studies research analysis approach approaches method methods application applications effect effects role new novel toward towards".split()
IRREGULAR = {
    "vortices": "vortex", "matrices": "matrix", "indices": "index", "analyses": "analysis", "hypotheses": "hypothesis", "syntheses": "synthesis", "criteria": "criterion", "phenomena": "phenomenon", "bacteria": "bacterium",
    "algae": "alga", "fungi": "fungus", "nuclei": "nucleus", "spectra": "spectrum", "media": "medium", "radii": "radius", "foci": "focus", "larvae": "larva", "genera": "genus", "stimuli": "stimulus",
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str) -> Column:
    """Lower case; everything but ASCII letters, digits, space and hyphen is a space; spaces collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9 -]+", " "), " +", " "))


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def singular(w: Column) -> Column:
    """Naive singular of one lower-case token; tokens with a digit are left alone."""
    table = F.create_map(*[F.lit(x) for kv in IRREGULAR.items() for x in kv])
    n = F.length(w)
    plain = (
        F.when(w.rlike("[0-9]"), w)
        .when((n > 4) & w.endswith("ies"), F.concat(F.substring(w, F.lit(1), n - 3), F.lit("y")))
        .when((n > 4) & w.rlike("(?:ss|sh|ch|x|z)es$"), F.substring(w, F.lit(1), n - 2))
        .when((n > 3) & w.endswith("s") & ~w.endswith("ss"), F.substring(w, F.lit(1), n - 1))
        .otherwise(w)
    )
    return F.coalesce(F.try_element_at(table, w), plain)


def term_key(c: Column | str) -> Column:
    return F.array_join(F.transform(_tokens(_c(c)), singular), " ")


def det_key(*parts: Column | str, seed: int = config.SEED) -> Column:
    """Key of deterministic random order: md5 of the seed and the parts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(p).cast("string") for p in parts]))


def uninformative_title(c: Column | str) -> Column:
    """Under 8 characters without LaTeX commands, or fewer than three words outside the stop list."""
    t = F.coalesce(_c(c), F.lit(""))
    words = F.filter(_tokens(norm(t)), lambda w: ~w.isin(STOP))
    return (F.length(F.regexp_replace(t, r"\\[a-zA-Z]+", "")) < 8) | (F.size(words) < 3)


def abstract_ok(c: Column | str, least: int = config.ABSTRACT_MIN_CHARS) -> Column:
    a = F.coalesce(_c(c), F.lit(""))
    return (F.length(a) >= least) & ~a.rlike(f"(?i)^{USPACE}*(?:no abstract|abstract not available)")


def clean_abstract(c: Column | str) -> Column:
    """Without tags, remains of a viewer and a leading heading; white space collapsed."""
    a = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\x{2028}", " ")
    a = F.regexp_replace(a, "<[^>]+>", " ")
    a = F.regexp_replace(a, "(?i)click to (?:increase|decrease) image size", " ")
    a = F.regexp_replace(a, rf"(?i)^{USPACE}*abstract(?:[:.]|{USPACE})+", "")
    return F.trim(F.regexp_replace(a, f"{USPACE}+", " "))


def trunc(c: Column | str) -> Column:
    a = _c(c)
    return F.when(F.length(a) <= 1200, a).otherwise(F.concat(F.substring(a, 1, 800), F.lit(" … "), F.right(a, F.lit(400))))


def tokens_est(c: Column | str) -> Column:
    return F.floor(F.length(F.coalesce(_c(c), F.lit(""))) / 4).cast("long")


def script_counts(c: Column | str) -> Column:
    """Struct of ASCII, East Asian and all letters."""
    t = F.coalesce(_c(c), F.lit(""))
    count = lambda p: F.length(F.regexp_replace(t, p, "")).cast("long")
    return F.struct(count("[^A-Za-z]").alias("latin"), count(r"[^\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}\x{3040}-\x{30FF}]").alias("cjk"), count(r"\P{L}").alias("letters"))


def keyword_bounds(state: Column | str) -> tuple[Column, Column]:
    s = _c(state)
    low = F.when(s.startswith("junk"), config.KEYWORD_MIN["junk"]).when(s.startswith("mixed"), config.KEYWORD_MIN["mixed"]).otherwise(config.KEYWORD_MIN["normal"])
    return low, F.lit(config.KEYWORD_MAX)


def shingles(normalised: Column | str) -> Column:
    """Distinct word 5-grams; character 8-grams of the text without spaces if it has under nine words; null if too short."""
    t = _c(normalised)
    k, n = config.SHINGLE_WORDS, config.SHINGLE_CHARS

    def grams(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, k), " "))

    def chars(flat: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(flat) - (n - 1)), lambda i: F.substring(flat, i, F.lit(n)))

    # a one-element transform binds the words, which would otherwise be split again for every shingle
    words = F.transform(F.array(_tokens(t)), lambda w: F.when(F.size(w) >= config.SHINGLE_MIN_WORDS, F.array_distinct(grams(w))))[0]
    letters = F.transform(F.array(F.replace(t, F.lit(" "), F.lit(""))), lambda x: F.when(F.length(x) >= config.SHINGLE_MIN_CHARS, F.array_distinct(chars(x))))[0]
    return F.coalesce(words, letters)


def jaccard(a: Column, b: Column, theta: float = config.NEAR_DUPLICATE_THETA) -> Column:
    """Jaccard of two arrays of distinct items; 0 where the sizes alone rule the threshold out."""
    na, nb = F.size(a), F.size(b)
    inter = F.size(F.array_intersect(a, b))
    return F.when(F.least(na, nb) < theta * F.greatest(na, nb), F.lit(0.0)).otherwise(inter / (na + nb - inter))


def keyword_identity(row_json: Column | str) -> Column:
    """Key of exactly equal keyword rows ``{term, role, variants}``; null for a malformed row."""
    parsed = F.from_json(_c(row_json), "struct<term:string,role:string,variants:array<string>>")
    return F.when(parsed["term"].isNotNull() & parsed["role"].isNotNull(), F.struct(parsed["term"].alias("term"), parsed["role"].alias("role"), F.coalesce(parsed["variants"], F.array().cast("array<string>")).alias("variants")))
