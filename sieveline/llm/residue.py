"""Template residue, filler and error pages in place of content or beside it (problem 4).

Method: records made from one template are aligned. Every field is cut into segments (lines, ``|`` parts, sentences) and
each segment is brought to its frame: marked names, numbers, identifiers and the names of bibliographic fields are the
places where records of one template differ, so they are masked and become the template's slots.

* Templates. The frames of all segments are counted over the corpus. A frame that several works hold, some in one field
  and some in another, is a template: what people write for one field isn't met word for word in the other. Error pages,
  script notices, prompts and default texts are such templates, whatever they say; no text of theirs is listed here.
* Other words of the same templates. The words of the templates against those of all other segments give each word a
  log-odds (a word that no template has, or that stands beside none of its neighbours there, one shared value). A segment is aligned with them as a whole or by its best
  beginning or end, so a template whose slots hold rare words, or that runs on into real text, is found by its other words.
* Slots. A slot is residue if it retains the name of a variable, a default or a blank. Names are learned: a name that
  marks of several styles hold is a variable's, and one that stands alone as the whole segment in both fields a default.
* Filler is a token or a pair of tokens repeated, or pseudo-Latin.

Defined results: null and empty texts hold no residue. A question isn't aligned (templates state and demand). Whole texts
are examined, however long. Repeated rows give one result for each distinct (id, field). Extra columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import written
from .encoding import as_fields

# The vocabulary of the usual pseudo-Latin filler.
LATIN = "lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
# The names of the fields a bibliographic template fills, in the languages of the corpus.
FIELD_WORDS = "title|abstract|summary|subtitle|keywords|heading|titel|titre|título|titolo|tytuł|resumen|résumé|resumo|riassunto|zusammenfassung|samenvatting|streszczenie"
# The pairs of signs in which template languages and forms put a name.
STYLES = [("{{", "}}"), ("${", "}"), ("#{", "}"), ("{$", "}"), ("{%", "%}"), ("<%=", "%>"), ("<%", "%>"), ("<<", ">>"), ("@@", "@@"), ("[[", "]]"), ("$(", ")"), ("<!--", "-->"), ("&lt;", "&gt;"), ("__", "__"), ("%", "%"), ("[", "]"), ("{", "}"), ("<", "/>")]

SLOT = "▢"
_IDENT = r"[^\W\d_](?:[\w.\-]*[^\W_])?"
_NAME = rf"{_IDENT}(?: {_IDENT}){{0,2}}"
#: A marked name. A sign of formulas before it (a backslash, ``_``, ``^``) makes it none.
MARK = re.compile(r"(?<![\\_^])(?:" + "|".join(("(?<![0-9])" if a == "%" else "") + rf"{re.escape(a)}\s*{_NAME}(?:\|\w+)?\s*{re.escape(b)}" for a, b in STYLES) + r")|\{\d\}|%(?:\d\$)?[sd](?![\w%])")
TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s+[a-z\-]+=[^<>]*)?/?>")
# The patterns below are RE2, run by Arrow over whole batches.
# MAY_MARK finds each text with a mark or a tag and few others: any sign beyond ASCII may be a letter or a space there.
_L, _W, _S = r"[A-Za-z\x{80}-\x{10ffff}]", r"[0-9A-Za-z_\x{80}-\x{10ffff}]", r"[\x{9}-\x{d}\x{1c}-\x{20}\x{80}-\x{10ffff}]*"
_I = rf"{_L}(?:{_W}|[.\-])*"
MAY_MARK = "|".join(rf"{re.escape(a)}{_S}{_I}(?: {_I}){{0,2}}(?:\|{_W}+)?{_S}{re.escape(b)}" for a, b in STYLES) + r"|\{[0-9\x{80}-\x{10ffff}]\}|%(?:[0-9\x{80}-\x{10ffff}]\$)?[sd]|</?[A-Za-z]"
_DIGITS = r"[0-9](?:[0-9a-f]|[.,:][0-9])*"
NUMBER = rf"\b[a-f]{{1,6}}{_DIGITS}|{_DIGITS}"
ASKS = r"\?[\"”»’)]?\s"
SEGMENT = r"[\n\r\x{2028}\x{2029}。！？]+|\s\|\s|[.!][\"”»’)]?\s|\*{2,}|\s>\s"
#: what parts words, but for single spaces, which stay
WORDS = r"[^\pL\pM\pN▢?\n ]+"
#: what is a word by itself
ALONE = r"([\x{3040}-\x{30ff}\x{3400}-\x{9fff}?])"

#: Works in which a frame must be met to be a template.
MIN_ALIGNED = 3
#: Least share of the works with a frame in its second field against those in its first: a heading of abstracts is the
#: title of few works, and the reverse.
BALANCE = 0.1
#: Least share of the works with a template that hold a word for it to be in the vocabulary. A work's templates have some
#: dozens of words, so the vocabulary sent to the workers has at most some dozens times ``1 / WORD_SHARE`` words.
WORD_SHARE = 0.0005
#: How much likelier, in nats, the best beginning or end of a segment must be to come from a template than a whole segment,
#: beside the logarithm of the number of places that a text offers.
MARGIN = 3.0
#: Fewer words at a beginning or an end say nothing: any text may begin with them.
LEAST_WORDS = 4


def _lists(parent: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """Values as ``n`` lists, by the number of the list that each is in."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(parent, minlength=n))].astype(np.int32)), values)


def frames_of(values: pa.Array) -> tuple[pa.ListArray, list[list[str]]]:
    """Of each text the frames of its segments (lower-case words and slots, one space between) and its marked names."""
    t = pc.replace_substring(values, "&nbsp;", " ")
    marks: list[list[str]] = [[]] * len(t)
    may = np.flatnonzero(pc.match_substring_regex(t, MAY_MARK).to_numpy(zero_copy_only=False))
    if len(may):
        some = t.take(pa.array(may)).to_pylist()
        masked = []
        for i, text in zip(may.tolist(), some):
            found: list[str] = []
            masked.append(TAG.sub(" ", MARK.sub(lambda m: found.append(m.group()) or f" {SLOT} ", text)))  # noqa: B023
            marks[i] = found
        mask = np.zeros(len(t), bool)
        mask[may] = True
        t = pc.replace_with_mask(t, pa.array(mask), pa.array(masked, t.type))
    t = pc.replace_substring_regex(pc.utf8_lower(t), NUMBER, "0")
    t = pc.replace_substring_regex(pc.replace_substring_regex(t, ASKS, " ?\n"), SEGMENT, "\n")
    t = pc.replace_substring_regex(pc.replace_substring_regex(t, WORDS, " "), ALONE, r" \1 ")
    parts = pc.split_pattern(t, "\n")
    row, parts = pc.list_parent_indices(parts).to_numpy(), pc.ascii_trim_whitespace(parts.flatten())
    some = pc.not_equal(parts, "")
    row, parts = row[some.to_numpy(zero_copy_only=False)], parts.filter(some)
    words = pc.ascii_split_whitespace(parts)
    word = words.flatten()
    word = pc.if_else(pc.is_in(word, value_set=pa.array(FIELD_WORDS.split("|"))), SLOT, word)
    frames = pc.binary_join(pa.ListArray.from_arrays(words.offsets, word), " ")
    return _lists(row, frames, len(values)), marks


#: Run by Java. Its repeats are lazy, so that the first two words of most frames are all that is read.
WORDY = r"\p{L}{2,} (?:.*? )??\p{L}{2}|(?:[\x{3040}-\x{30ff}\x{3400}-\x{9fff}] +){3}|\x{25a2} (?:.*? )??(?:\x{25a2}|\p{L}{3})|\p{L}{3,} (?:.*? )??\x{25a2}"


def _wordy(frame: Column) -> Column:
    """Frames of fewer words (or East Asian letters) are met in any field by chance; questions are no template."""
    return frame.rlike(WORDY) & ~frame.endswith("?")


def framed(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``work_id, field_name, frames, marks`` of every field with text; ``marks`` are the marked names as they stand."""
    rows = as_fields(df, id_col, fields)
    schema = T.StructType([rows.schema["work_id"], rows.schema["field_name"], T.StructField("frames", T.ArrayType(T.StringType())), T.StructField("marks", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            frames, marks = frames_of(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), frames, pa.array(marks, pa.list_(pa.string()))], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def hashed(frames: DataFrame) -> DataFrame:
    """``frames`` with ``hashes`` of those that may be templates, written beside them: three passes read these alone."""
    return frames.withColumn("hashes", F.transform(F.filter("frames", _wordy), lambda frame: F.xxhash64(frame)))


def templates(frames: DataFrame, min_aligned: int = MIN_ALIGNED) -> DataFrame:
    """``hash`` of the frames that are templates, from ``hash, work_id, field_name``: at least ``min_aligned`` works hold
    it in one field only (a title copied into its own abstract says nothing), and not all of them in the same field.

    The first aggregate is combined map-side and drops the frames of one field, so only few rows reach the exact counts.
    """
    both = frames.groupBy("hash").agg(F.min("field_name").alias("lo"), F.max("field_name").alias("hi")).where("lo <> hi").select("hash")
    met = frames.join(both, "hash", "left_semi")
    single = met.groupBy("hash", "work_id").agg(F.min("field_name").alias("lo"), F.max("field_name").alias("hi")).where("lo = hi")
    per_field = single.groupBy("hash", "lo").agg(F.count(F.lit(1)).alias("works"))
    per_frame = per_field.groupBy("hash").agg(F.sum("works").alias("works"), F.sort_array(F.collect_list("works"), asc=False).alias("by_field"))
    return per_frame.where((F.col("works") >= min_aligned) & (F.try_element_at("by_field", F.lit(2)) >= BALANCE * F.element_at("by_field", 1))).select("hash")


class Lexicon(NamedTuple):
    """Log-odds of words between templates and other text, that of any other word, and what a span must exceed."""

    words: list[str]
    weight: list[float]
    other: float
    least: float
    pairs: list[str] = []  # of neighbours in templates, one space between

    def weigher(self) -> Callable[[pa.Array, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """A function from tokens and their segments to the weights of words alone and of words beside their neighbours."""
        vocabulary, n = pa.array(self.words, pa.string()), len(self.words)
        weights, place = np.array([*self.weight, self.other]), {w: i for i, w in enumerate(self.words)}
        met = np.array(sorted(place[a] * n + place[b] for a, b in (p.split(" ") for p in self.pairs) if a in place and b in place), np.int64)

        def weigh(token: pa.Array, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = pc.fill_null(pc.index_in(token, value_set=vocabulary), n).to_numpy().astype(np.int64)
            beside = np.zeros(len(at), bool)
            if len(at) > 1 and len(met):
                pair = at[:-1] * n + at[1:]
                seen = (at[:-1] < n) & (at[1:] < n) & (segment[1:] == segment[:-1]) & (met[np.minimum(np.searchsorted(met, pair), len(met) - 1)] == pair)
                beside[:-1] |= seen
                beside[1:] |= seen
            return weights[at], np.where(beside, weights[at], np.minimum(weights[at], self.other))

        return weigh


def make_lexicon(inside: dict[str, int], total: dict[str, int], n_inside: int, n_total: int, segments: tuple[int, int], pairs: list[str]) -> Lexicon:
    """``inside`` and ``total`` count the vocabulary's words in templates and in all segments, ``n_*`` all words there;
    ``segments`` are the numbers of template segments and of all."""
    words = sorted(inside)
    outside = max(1, n_total - n_inside)
    weight = [math.log(inside[w] / n_inside) - math.log((max(0, total.get(w, 0) - inside[w]) + 0.5) / outside) for w in words]
    rest_in = n_inside - sum(inside.values()) + 1
    rest_out = outside - sum(max(0, total.get(w, 0) - inside[w]) for w in words) + 1
    other = min(-1.0, math.log(rest_in / n_inside) - math.log(rest_out / outside))
    prior = math.log(max(1, segments[0])) - math.log(max(1, segments[1] - segments[0]))
    return Lexicon(words, weight, other, -prior, pairs)


def _tokens(frames: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of a list column of frames: the row of each segment, all tokens, and the segment of each token."""
    row = pc.list_parent_indices(frames).to_numpy()
    split = pc.split_pattern(frames.flatten(), " ")
    return row, split.flatten(), pc.list_parent_indices(split).to_numpy()


def span_scores(weight: np.ndarray, segment: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment the sum of its weights, and the greatest sum of a beginning or an end of ``LEAST_WORDS`` or more."""
    whole, best = np.full(n, -np.inf), np.full(n, -np.inf)
    if len(weight):
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        of = segment[first]
        upto = np.cumsum(weight)
        before = np.r_[0.0, upto][first]
        end = np.r_[first[1:], len(weight)] - 1
        whole[of] = upto[end] - before
        size = end - first + 1
        after = np.arange(len(weight)) - np.repeat(first, size) + 1  # words of the beginning that ends here
        left = np.repeat(size, size) - after + 1  # words of the end that begins here
        lead = np.maximum.reduceat(np.where(after >= LEAST_WORDS, upto, -np.inf), first) - before
        tail = upto[end] - np.minimum.reduceat(np.where(left >= LEAST_WORDS, np.r_[0.0, upto[:-1]], np.inf), first)
        best[of] = np.maximum(lead, tail)
    return whole, best


def _filler(tokens: pa.Array, segment: np.ndarray, n: int) -> np.ndarray:
    """Segments with a token met three times in a row or a pair of tokens three times, or of pseudo-Latin."""
    code = pc.dictionary_encode(tokens).combine_chunks() if isinstance(tokens, pa.ChunkedArray) else pc.dictionary_encode(tokens)
    ids = code.indices.to_numpy()
    plain = np.array([len(w) > 2 and not w.isdigit() for w in code.dictionary.to_pylist()], bool)
    plain = plain[ids] if len(ids) else np.zeros(0, bool)
    bad = np.zeros(n, bool)

    def same(gap: int, upto: int) -> np.ndarray:
        """At i: tokens i, i + gap, i + 2 gap are equal and in one segment that holds i + upto."""
        m = len(ids) - upto
        if m <= 0:
            return np.zeros(0, bool)
        return (ids[:m] == ids[gap : gap + m]) & (ids[:m] == ids[2 * gap : 2 * gap + m]) & (segment[:m] == segment[upto : upto + m]) & plain[:m]

    one = same(1, 2)
    bad[segment[: len(one)][one]] = True
    two = same(2, 5)
    if len(two):
        pair = two & (ids[1 : 1 + len(two)] == ids[3 : 3 + len(two)]) & (ids[1 : 1 + len(two)] == ids[5 : 5 + len(two)])
        bad[segment[: len(pair)][pair]] = True
    latin = pc.is_in(tokens, value_set=pa.array(LATIN)).to_numpy(zero_copy_only=False) if len(tokens) else np.zeros(0, bool)
    if latin.any():
        long = latin & (pc.utf8_length(tokens).to_numpy() > 3)
        at = np.flatnonzero(long)
        run4 = at[:-3][(at[3:] == at[:-3] + 3) & (segment[at[3:]] == segment[at[:-3]])] if len(at) > 3 else at[:0]
        bad[segment[run4]] = True
        size, of_latin, of_long = (np.bincount(segment, w, n) for w in (np.ones(len(segment)), latin, long))
        bad |= (size > 2) & (of_latin >= 0.7 * size) & (of_long >= 3)
    return bad


def _vocabulary(rows: DataFrame, hashes: DataFrame) -> Lexicon | None:
    """Words of the templates with their counts there and everywhere; None if there is no template."""
    spark = rows.sparkSession
    met = rows.select("work_id", F.explode("frames").alias("frame")).withColumn("hash", F.xxhash64("frame")).join(hashes, "hash", "left_semi")
    inside = written(met.select("work_id", "frame"), "template-segments")
    n_seg, works = inside.agg(F.count(F.lit(1)), F.count_distinct("work_id")).first()
    if not n_seg:
        return None
    word = inside.select("work_id", F.explode(F.split("frame", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("work_id").alias("works"))
    n_in = word.agg(F.sum("n")).first()[0]
    least = max(MIN_ALIGNED, WORD_SHARE * works)
    counts = {r["word"]: r["n"] for r in word.where(F.col("works") >= least).select("word", "n").toLocalIterator()}
    words = sorted(counts)
    w = F.split("frame", " ")
    pair = inside.select("work_id", F.explode(F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws(" ", a, b)))).alias("pair"))
    pairs = [r["pair"] for r in pair.groupBy("pair").agg(F.count_distinct("work_id").alias("works")).where(F.col("works") >= least).toLocalIterator()]
    sent = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(sent.value, pa.string())
        got, tokens, segments = np.zeros(len(vocabulary), np.int64), 0, 0
        for b in batches:
            _, token, _ = _tokens(b.column(0))
            at = pc.drop_null(pc.index_in(token, value_set=vocabulary)).to_numpy()
            got += np.bincount(at, minlength=len(got))
            tokens, segments = tokens + len(token), segments + len(b.column(0).flatten())
        ids = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array([*ids.tolist(), -1, -2], pa.int64()), pa.array([*got[ids].tolist(), tokens, segments], pa.int64())], names=["at", "n"])

    # one row for each word of the vocabulary and two for the totals
    every = {r["at"]: r["n"] for r in rows.select("frames").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    total = {words[k]: n for k, n in every.items() if k >= 0}
    return make_lexicon(counts, total, n_in, every[-1], (n_seg, every[-2]), pairs)


def variables(rows: DataFrame, min_aligned: int = MIN_ALIGNED) -> DataFrame:
    """``work_id, field_name`` of fields with a slot that retains a variable's name or a default.

    A name of one letter is none. A name is a variable's if marks of at least two styles hold it in ``min_aligned`` works,
    a default if it is all that a segment of ``min_aligned`` works says, some in one field and some in another.
    """
    style = F.regexp_replace("mark", r"[\p{L}\p{N}](?:[\p{L}\p{N}_.\- |]*[\p{L}\p{N}])?| ", "")
    name = F.lower(F.regexp_extract("mark", r"(\p{L}(?:[\p{L}\p{N}_.\- ]*[\p{L}\p{N}])?)", 1))
    alone = F.array_contains("frames", SLOT)
    m = rows.where(F.size("marks") > 0).select("work_id", "field_name", alone.alias("alone"), F.explode("marks").alias("mark")).select("work_id", "field_name", "alone", style.alias("style"), name.alias("name")).where(F.length("name") > 1)
    m = written(m, "marks")
    per_work = m.groupBy("name", "work_id").agg(F.min("style").alias("s0"), F.max("style").alias("s1"), F.min(F.when(F.col("alone"), F.col("field_name"))).alias("f0"), F.max(F.when(F.col("alone"), F.col("field_name"))).alias("f1"))
    names = per_work.groupBy("name").agg(F.count(F.lit(1)).alias("works"), F.min("s0").alias("s0"), F.max("s1").alias("s1"), F.min("f0").alias("f0"), F.max("f1").alias("f1"), F.count("f0").alias("alone"))
    learned = names.where(((F.col("works") >= min_aligned) & (F.col("s0") < F.col("s1"))) | ((F.col("alone") >= min_aligned) & (F.col("f0") < F.col("f1"))))
    return m.join(learned.select("name"), "name", "left_semi").select("work_id", "field_name")


def residue_evidence(df: DataFrame, id_col: str, fields: list[str], min_aligned: int = MIN_ALIGNED) -> DataFrame:
    """``work_id, field_name, kind``: ``template`` (a segment's frame is one), ``span`` (a span of it is aligned with the
    words of templates), ``slot`` (a slot retains a name) or ``filler``; a field once for each kind.

    Frames are written once. Counts are combined map-side and joined with a shuffle; only the vocabulary is broadcast.
    """
    rows = written(hashed(framed(df, id_col, fields)), "frames")
    each = rows.select("work_id", "field_name", F.explode("hashes").alias("hash"))
    hashes = written(templates(each, min_aligned), "templates")
    lexicon = _vocabulary(rows, hashes)
    sent = df.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([rows.schema["work_id"], rows.schema["field_name"], T.StructField("kind", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = sent.value
        weigh = lex.weigher() if lex else None
        for b in batches:
            row, token, segment = _tokens(b.column(2))
            kinds = {"filler": np.unique(row[_filler(token, segment, len(row))])}
            if lex:
                asks = np.zeros(len(row), bool)
                asks[segment[pc.equal(token, "?").to_numpy(zero_copy_only=False)]] = True
                size = np.bincount(row[segment], minlength=b.num_rows)
                alone, beside = weigh(token, segment)
                whole, part = span_scores(alone, segment, len(row))[0], span_scores(beside, segment, len(row))[1]
                said = np.bincount(segment, pc.match_substring_regex(token, r"\p{L}").to_numpy(zero_copy_only=False), len(row)) > 0  # a slot alone says nothing
                kinds["span"] = np.unique(row[said & ((whole > lex.least) | (part > lex.least + MARGIN + np.log(np.maximum(1, size[row])))) & ~asks])
            for kind, k in kinds.items():
                kept = b.take(pa.array(k))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array([kind] * len(k), pa.string())], names=[f.name for f in schema])

    spans = rows.select("work_id", "field_name", "frames").mapInArrow(run, schema)
    aligned = each.join(hashes, "hash", "left_semi").select("work_id", "field_name", F.lit("template").alias("kind"))
    slots = variables(rows, min_aligned).withColumn("kind", F.lit("slot"))
    return spans.unionByName(aligned).unionByName(slots).distinct()


def residue_fields(df: DataFrame, id_col: str, fields: list[str], min_aligned: int = MIN_ALIGNED) -> DataFrame:
    """``work_id, field_name`` of the fields that hold residue."""
    return residue_evidence(df, id_col, fields, min_aligned).select("work_id", "field_name").distinct()
