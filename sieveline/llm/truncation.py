"""Texts cut off by field limits or in mid-transfer (problem 9).

Method: for each source and unit (characters, UTF-8 bytes, words) a log-normal length distribution is fitted by maximum
likelihood in which values at a candidate limit are right-censored. A length is a limit if the number of values there
can't be chance under that fit and the lengths beside it (a likelihood ratio, without a least pile, until no further
limit is found). The excess of the values at a limit over the fit is the censoring posterior of a value there.

The posterior is combined with the text's ending. An ending has a kind (prose, a heading, a list; with a mark put after a
cut or without, since complete texts end in such marks, too) and a shape: how often its last words (up to four) end a
sentence, line or list item elsewhere in the corpus, an open bracket or sign, a broken character. What a shape says
isn't set by hand. Its share among complete texts is that among the texts that end in a full stop, looked at without it
(of headings and lists, that among those at no limit); its share among cut texts is learned from the documents at limits,
each by its posterior. For every place (a step of the censoring posterior, or no limit) and kind the share of cut texts is then
the one of greatest likelihood, with the censoring posterior as its prior; of prose without a full stop at a limit it
follows from the complete texts there and how often those at no limit lack theirs. All by expectation maximisation over counts. A document is cut if its odds from place, kind and shape exceed one.

Only the words that end some text are counted, each by itself, however many there are: a filter in front of the shuffle
lets all of them and few others pass, counts are added up with map-side combining and joined to the texts. What comes to
the driver is the table of counts by place, kind and shape (at most ``PLACES`` places by some hundreds of kinds and shapes).

Defined results: null, empty and blank texts are not cut. A text that ends in a full stop, question or exclamation mark
is complete, wherever its length lies. A document of null source has only its ending judged against the limits of the
other documents without source. Whole texts are read; ids delivered twice are judged row by row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import cut, widen, written

GRAMS = 4
#: Bits of the filter of grams to count: about so many for each, within bounds. Too few cost shuffled rows, never a count.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
PROBES = (6, 35)
#: Chance of a false limit among all lengths of one source and unit.
FALSE_LIMIT = 1e-3
UNITS = ("chars", "bytes", "words")
#: How far below the limit a cut value may lie: a space cut off, a character of several bytes left out.
SLACK = {"chars": 1, "bytes": 3, "words": 0}

MARK = r"(?:\s*(?:</[A-Za-z][A-Za-z0-9]*>|\[\s*(?:\.\.\.|…)\s*\]|\(\s*(?:\.\.\.|…)\s*\)|\.\.\.+|…|\(more\)|\[more\]|\(cont(?:inued|\.)?\)|\[truncated\]|>>))+\s*$"
MARK_RE = re.compile(MARK)
TERMINAL = ".!?。！？｡؟"
CLOSING = "\"'”’»)]}』」】）"
TOKEN = re.compile(r"[㐀-鿿぀-ヿ]|[^\W\d_㐀-鿿぀-ヿ]+|\d+(?:[.,]\d+)*|[\x01-\x04]|[.!?。！？…](?=[\"'”’»)\]]*(?:\s|$|[\x01-\x04]|[㐀-鿿぀-ヿ]))|[;|•·,:\-–—]")
LIST_HEAD = re.compile(r"\s*[^\W\d_]+(?: [^\W\d_]+)?\s?[:：]\s")
SEPARATOR = re.compile(r"\s?[,;|•·]\s?|\s[-–—]\s")
ITEM_WORDS = 5
#: Characters a word on average above which a text isn't parted by spaces.
MOST_LETTERS = 20
HAS_STOP = re.compile(r"[.!?。！？…](?=[\"'”’»)\]]*(?:\s|$|[㐀-鿿぀-ヿ]))")
TEXT_END, PROSE, HEADING, LIST = "\x01", "\x02", "\x03", "\x04"
CONTROLS = re.compile("[\x01-\x04]")
OPEN_END = re.compile(r"[,;:(\[{=<+/&%–—\-]$|\($")


#: Places that documents fall into by their censoring posterior: those at no limit, and steps of its log-odds.
FREE, PLACES = 0, 12
#: Pseudo-documents by which the share of cut texts at a place is that of its censoring posterior until some are seen.
BELIEF = 2.0
MASK = (1 << 64) - 1
MIX = 0x9E3779B97F4A7C15
KIND = {PROSE: 0x51ED270B, HEADING: 0x2545F491, LIST: 0x6C8E9CF5}
CODE = {TEXT_END: 1, PROSE: 2, HEADING: 3, LIST: 4} | dict.fromkeys(".!?。！？…", 5) | dict.fromkeys(";|•·,:-–—", 6)


def _listed(line: str) -> bool:
    """Whether a line is a list of short items: led by a word and a colon, or parted by bars."""
    head = LIST_HEAD.match(line)
    if not head and " | " not in line and " · " not in line:
        return False
    items = SEPARATOR.split(line[head.end() if head else 0 :])
    return all(len(i.split()) <= ITEM_WORDS for i in items)


def _unmarked(text: str) -> str:
    """A text without the mark after its end; the pattern is tried only where a text ends like one."""
    end = text.rstrip()
    return MARK_RE.sub("", text) if end[-1:] in "…])>" or end.endswith("...") else text


def _kind(line: str, first: bool) -> str:
    return LIST if _listed(line) else HEADING if first and not HAS_STOP.search(line) else PROSE


def _marked(text: str) -> str:
    """A text without the mark after its end, each line led by its kind: prose, a heading (a first line without a full
    stop), a list of items."""
    text = _unmarked(CONTROLS.sub(" ", text).rstrip())
    out = []
    for line in text.lower().split("\n"):
        if line.strip():
            out += [_kind(line, not out), line, "\n"]
    return "".join(out)


def _last_line(text: str) -> tuple[str, str]:
    """Kind and text of the last line that isn't blank."""
    text = CONTROLS.sub(" ", text).rstrip()
    at = text.rfind("\n")
    line = text[at + 1 :].lower()
    return _kind(line, not text[: max(at, 0)].strip()), line


def _last_words(line: str, kind: str) -> list[str]:
    """The last words (``GRAMS`` or more, if there are) since a full stop, or since a sign between items."""
    size = 256
    while True:
        tail = line[-size:]
        tokens = TOKEN.findall(tail)
        words: list[str] = []
        whole = len(tail) == len(line)
        for t in tokens if whole else tokens[1:]:  # the first may be the rest of a word
            if t in CODE:
                if CODE[t] == 5 or (CODE[t] == 6 and kind == LIST):
                    words, whole = [], True
            else:
                words.append(t)
        if whole or len(words) >= GRAMS:
            return words
        size *= 4


def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest("0" if word[0].isdigit() else word) >> 1


class Wanted:
    """Whether a gram may be one of those to count: no gram that is one is ever refused, few others pass."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def __call__(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for shift in PROBES:
            i = (h >> np.uint64(shift)) & np.uint64(64 * len(self.words) - 1)
            ok &= (self.words[(i >> np.uint64(6)).astype(np.int64)] >> (i & np.uint64(63))) & np.uint64(1) == 1
        return ok


def wanted_filter(grams: DataFrame) -> np.ndarray:
    """The words of the filter for column ``hash``; sized by the (estimated) number of grams, filled from all of them."""
    n = grams.agg(F.approx_count_distinct("hash")).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit(bits - 1)) for shift in PROBES]))
    words = grams.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


class Endings:
    """Counts of how often grams end a segment (``final``) and how often they are met, by their 64-bit hashes."""

    def __init__(self, wanted: Wanted | None = None) -> None:
        self.final: dict[int, int] = {}
        self.met: dict[int, int] = {}
        self.known: dict[str, int] = {}
        self.wanted = wanted

    def add(self, texts: list[str]) -> None:
        for h, f, m in zip(*(x.tolist() for x in self.count(*self.grams(texts)))):
            self.final[h] = self.final.get(h, 0) + f
            self.met[h] = self.met.get(h, 0) + m

    @staticmethod
    def count(h: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes (signed), times final, times met."""
        u, at = np.unique(h, return_inverse=True)
        return u.view(np.int64), np.bincount(at[final], minlength=len(u)), np.bincount(at, minlength=len(u))

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the grams of all words and whether each ends a segment."""
        tokens = TOKEN.findall(TEXT_END.join([*map(_marked, texts), ""]))
        if not tokens:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        if len(self.known) > 300_000:
            self.known.clear()
        known = self.known
        for t in set(tokens).difference(known):
            known[t] = -CODE[t] if t in CODE else _word_hash(t)
        code = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        # the kind of each line, then drop separators outside lists
        lead = np.where((code <= -2) & (code >= -4), np.arange(len(code)), 0)
        kind = code[np.maximum.accumulate(lead)]
        keep = (code != -6) | (kind == -4)
        code, kind = code[keep], kind[keep]
        word = code > 0
        mark = np.flatnonzero(~word)
        at = np.arange(len(code))
        start = np.maximum.accumulate(np.where(~word, at + 1, 0))
        final = np.zeros(len(code), bool)
        final[:-1] = word[:-1] & ~word[1:]
        # the last words of prose that stops without a full stop: whether they end it is the question
        ends = mark[code[mark] == -1]
        tail = np.zeros(len(code) + 1, np.int64)
        open_ = ends[(ends > 0) & word[ends - 1] & (kind[ends - 1] == -2)]
        np.add.at(tail, start[open_ - 1], 1)
        np.add.at(tail, open_, -1)
        use = word & (np.cumsum(tail[:-1]) == 0)
        salt = np.zeros(len(code), np.uint64)
        for c, v in ((-2, KIND[PROSE]), (-3, KIND[HEADING]), (-4, KIND[LIST])):
            salt[kind == c] = v
        h1 = code.astype(np.uint64)
        h = np.zeros(len(code), np.uint64)
        hashes, finals = [], []
        with np.errstate(over="ignore"):
            for g in range(GRAMS):
                ok = use & (at - g >= start)
                shifted = np.zeros(len(code), np.uint64)
                shifted[g:] = h1[: len(code) - g]
                h = (h ^ (shifted + salt)) * np.uint64(MIX) + np.uint64(g + 1)
                some, last = h[ok], final[ok]
                if self.wanted:
                    of = self.wanted(some)
                    some, last = some[of], last[of]
                hashes.append(some)
                finals.append(last)
        return np.concatenate(hashes), np.concatenate(finals)


def _chain(words: list[str], kind: str) -> list[int]:
    """Signed hashes of the last 1, 2, ... words, as ``Endings.grams`` makes them."""
    h, out = 0, []
    for g, w in enumerate(reversed(words[-GRAMS:])):
        h = ((h ^ ((_word_hash(w) + KIND[kind]) & MASK)) * MIX + g + 1) & MASK
        out.append(h - (1 << 64) if h >> 63 else h)
    return out


def ending_counts(df: DataFrame, text_col: str, wanted: np.ndarray) -> DataFrame:
    """``hash, final, met`` of the grams that the filter lets pass, over all words of all texts; combined map-side."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("hash", "final", "met")])
    sent = df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Endings(Wanted(sent.value))
        for b in batches:
            texts, parts, some, size = b.column(0).to_pylist(), [], [], 0
            for k, t in enumerate(texts):
                some.append(t)
                size += len(t)
                if size > 1_000_000 or k == len(texts) - 1:
                    parts.append(e.grams(some))
                    some, size = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in e.count(*map(np.concatenate, zip(*parts)))], names=["hash", "final", "met"])

    counts = df.select(text_col).where(F.length(F.trim(text_col)) > 0).mapInArrow(run, schema)
    return counts.groupBy("hash").agg(F.sum("final").alias("final"), F.sum("met").alias("met"))


# -- lengths --------------------------------------------------------------------------------------------------------


def length_histogram(rows: DataFrame) -> DataFrame:
    """``source, unit, length, n`` of the texts without their marks; native, combined map-side."""
    sizes = [F.struct(F.lit(u).alias("unit"), F.col("_sizes")[2 * i].alias("length")) for i, u in enumerate(UNITS)]
    return rows.where("_sizes is not null").select("source", F.explode(F.array(*sizes)).alias("s")).where("s.length is not null").groupBy("source", "s.unit", "s.length").agg(F.count(F.lit(1)).alias("n"))


def fit_censored(length: np.ndarray, n: np.ndarray, limits: list[tuple[int, int]]) -> tuple[float, float]:
    """Mean and deviation of log length by maximum likelihood (EM); values in a limit's window are known only to be no shorter."""
    x = np.log(np.maximum(length, 1))
    at = np.zeros(len(x), bool)
    for low, high in limits:
        at |= (length >= low) & (length <= high)
    free = ~at
    w = n.astype(float)
    mu = float(np.average(x, weights=w))
    sd = max(0.1, math.sqrt(np.average((x - mu) ** 2, weights=w)))
    for _ in range(60):
        a = (x[at] - mu) / sd
        tail = np.maximum(0.5 * np.vectorize(math.erfc)(a / math.sqrt(2)), 1e-12) if len(a) else a
        hazard = np.exp(-0.5 * a * a) / math.sqrt(2 * math.pi) / tail
        m1, m2 = mu + sd * hazard, sd * sd * (1 + a * hazard) + mu * mu + 2 * mu * sd * hazard - 0
        total = w.sum()
        new = (float((w[free] * x[free]).sum()) + float((w[at] * m1).sum())) / total
        second = (float((w[free] * x[free] ** 2).sum()) + float((w[at] * m2).sum())) / total
        new_sd = max(0.1, math.sqrt(max(1e-4, second - new * new)))
        done = abs(new - mu) + abs(new_sd - sd) < 1e-6
        mu, sd = new, new_sd
        if done:
            break
    return mu, sd


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x.tolist()])


def find_limits(length: np.ndarray, n: np.ndarray, unit: str, alpha: float = FALSE_LIMIT) -> list[tuple[int, float]]:
    """Limits of one source and unit with the posterior of a value there to have been cut.

    One sort and running sums; each limit found costs one more pass over the distinct lengths.
    """
    if not len(length):
        return []
    order = np.argsort(length)
    length, n = length[order].astype(np.int64), n[order].astype(np.int64)
    slack, total = SLACK[unit], float(n.sum())
    upto = np.r_[0, np.cumsum(n)]

    def between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return upto[np.searchsorted(length, high, "right")] - upto[np.searchsorted(length, low, "left")]

    def fitted(low: np.ndarray, high: np.ndarray, mu: float, sd: float) -> np.ndarray:
        cdf = lambda v: _normal_cdf((np.log(np.maximum(v, 0.5)) - mu) / sd)
        return total * (cdf(high + 0.5) - cdf(low - 0.5))

    got = between(length - slack, length).astype(float)
    # the neighbourhood speaks for natural lengths, too: a pile must stand out of what lies just below and above it
    start = np.ceil(0.9 * length).astype(np.int64)
    below = between(start, length - slack - 1) * (slack + 1) / np.maximum(1, length - slack - start)
    above = between(length + 1, length + 2 * (slack + 1)) / 2
    found: list[tuple[int, int]] = []
    while True:
        mu, sd = fit_censored(length, n, found)
        e = np.maximum.reduce([fitted(length - slack, length, mu, sd), below, above, np.full(len(length), 0.1)])
        gain = np.where(got > e, got * np.log(np.maximum(got, 1) / e) - (got - e), 0.0)
        for low, high in found:
            gain[(length >= low - slack) & (length <= high + slack)] = 0.0
        best = int(gain.argmax())
        if gain[best] <= math.log(len(length) / alpha):
            break
        found.append((int(length[best]) - slack, int(length[best])))
    out = []
    for low, high in found:
        here = float(between(np.array([low]), np.array([high]))[0])
        natural = max(float(fitted(np.array([low]), np.array([high]), mu, sd)[0]), float(between(np.array([high + 1]), np.array([high + 2 * (slack + 1)]))[0]) / 2)
        out.append((high, min(1.0, max(0.0, 1 - natural / here))))
    return out


LIMITS = T.StructType([T.StructField("source", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("limit", T.LongType()), T.StructField("posterior", T.DoubleType())])


def source_limits(hist: DataFrame) -> DataFrame:
    """``source, unit, limit, posterior``; a task holds the histogram of one source and unit, not its texts."""

    def fit(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        found = find_limits(g["length"].to_numpy(), g["n"].to_numpy(), key[1])
        return pd.DataFrame([(key[0], key[1], int(v), float(p)) for v, p in found], columns=[f.name for f in LIMITS])

    return hist.groupBy("source", "unit").applyInPandas(fit, LIMITS)


# -- endings --------------------------------------------------------------------------------------------------------


class Open(NamedTuple):
    """An ending to be looked up: hashes of its last 1, 2, ... words and of its last word in prose."""

    chain: list[int]
    prose: int
    kind: str
    number: bool
    own: bool
    marked: bool


#: State of texts that end as complete ones do.
WHOLE = "whole"
NAMES = {PROSE: "prose", HEADING: "heading", LIST: "list"}


def ending(text: str) -> tuple[str | None, Open | None]:
    """State of a text's ending (``whole``, or kind and shape), and what to look up: of an open ending, whose state is
    None, to know its shape; of a whole one of prose, to know the shapes of complete texts."""
    body = text.rstrip()
    core = _unmarked(body).rstrip()
    marked = len(core) < len(body)
    if not core:
        return WHOLE, None
    sign = "marked " if marked else ""
    if "\ufffd" in core[-2:]:
        return f"{sign}prose: broken", None
    bare = core.rstrip(CLOSING)
    last = (bare or core)[-1]
    whole = number = False
    if last in TERMINAL:
        number = last == "." and re.search(r"\d\.$", core) is not None  # cut at its point, or a sentence ending in a number
        whole = not number
        bare = bare.rstrip(TERMINAL + CLOSING)
    elif core[-1] in ")]}」』】）\"”»" and _closed(core):
        return WHOLE, None
    elif OPEN_END.search(core) and last != "%":
        return f"{sign}prose: open", None
    if not whole and (line := core[core.rfind("\n") + 1 :]).count("(") > line.count(")"):
        return f"{sign}prose: bracket", None
    if not bare.strip():
        return WHOLE, None
    kind, line = _last_line(_unmarked(bare))
    if whole and (kind != PROSE or marked):
        return WHOLE, None
    words = _last_words(line, kind)
    if not words:
        return WHOLE, None
    own = kind != PROSE or last in TERMINAL  # such an ending was counted as final when the table was made
    return WHOLE if whole else None, Open(_chain(words, kind), _chain(words[-1:], PROSE)[0], kind, number, own, marked)


def looked_up(e: Open, final: Mapping[int, int], met: Mapping[int, int]) -> str:
    """Kind and shape of an open ending: the number of last words met before, and the log2 odds that they go on."""
    name = ("marked " if e.marked else "") + NAMES[e.kind] + (" number" if e.number else "")
    for g in range(len(e.chain), 0, -1):
        m, f = met.get(e.chain[g - 1], 0), final.get(e.chain[g - 1], 0)
        if e.own and f and m:
            m, f = m - 1, f - 1
        if m >= (2 if g > 1 else 1):
            q = (f + 0.5) / (m + 1)
            part = " in part" if g == 1 and len(e.chain) > 1 else ""  # the word is known, but never after the words before it
            return f"{name}: {'words' if g > 1 else 'word'}{part} {max(-6, min(6, round(math.log2((1 - q) / q))))}"
    return f"{name}: {'elsewhere' if e.kind != PROSE and met.get(e.prose, 0) > 0 else 'new'}"


def fit_odds(counts: dict[tuple[int, str], int], complete: dict[str, int], stopped: dict[int, int], posterior: dict[int, float]) -> dict[tuple[int, str], float]:
    """Odds that a document is cut for every (place, kind and shape) met, by expectation maximisation.

    ``complete`` counts the shapes of texts that end in a full stop, ``stopped`` such texts by place. ``posterior`` has the censoring posterior of every
    place but ``FREE``, whose prior is the share of all documents that the others explain.
    """
    names = sorted({c for _, c in counts})
    if not names:
        return {}
    places = sorted({p for p, _ in counts})
    kinds = sorted({c.partition(": ")[0] for c in names})
    shapes = sorted({c.partition(": ")[2] for c in names} | {c.partition(": ")[2] for c in complete})
    n = np.array([[[counts.get((p, f"{k}: {s}"), 0) for s in shapes] for k in kinds] for p in places], float)
    whole = np.array([sum(v for c, v in complete.items() if c.partition(": ")[2] == s) for s in shapes], float)
    even = np.full(len(shapes), 1 / len(shapes))
    prose = np.array(["prose" in k for k in kinds])
    free = np.array([p == FREE for p in places])
    prior = np.array([posterior.get(p, 0.5) for p in places])
    rest = np.where(prose[:, None], (whole + even) / (whole.sum() + 1), (n[free].sum(axis=0) + even) / (n[free].sum(axis=(0, 2))[:, None] + 1))
    at_limit = n[~free][:, prose].sum(axis=(0, 1)) if (~free).any() else n[:, prose].sum(axis=(0, 1))
    gone = (at_limit + even) / (at_limit.sum() + 1)
    rate = np.repeat(prior[:, None], len(kinds), axis=1)
    lacks = np.array([k in ("prose", "marked prose") for k in kinds])  # their missing full stop is evidence itself
    ended = np.array([stopped.get(p, 0) for p in places], float)
    for _ in range(200):
        a = rate[:, :, None] * gone
        r = a / (a + (1 - rate[:, :, None]) * rest)
        cut_n = n * r
        of_limits = (cut_n[~free][:, prose] if (~free).any() else cut_n[:, prose]).sum(axis=(0, 1))
        new = (of_limits + even) / (of_limits.sum() + 1)
        moved = np.abs(new - gone).sum()
        gone = new
        left = (n - cut_n)[free].sum(axis=0)
        rest = np.where(prose[:, None], rest, (left + even) / (left.sum(axis=1)[:, None] + 1))
        size = n.sum(axis=2)
        rate = (cut_n.sum(axis=2) + BELIEF * prior[:, None]) / (size + BELIEF)
        if ended[free].sum():
            unstopped = left.sum(axis=1) / ended[free].sum()  # complete texts without a full stop for one with it
            expected = np.minimum(1, (ended[:, None] * unstopped + 0.5 / ended[free].sum()) / np.maximum(size, 1))
            rate = np.where(lacks & ~free[:, None], np.minimum(1 - expected, 1 - 1e-6), rate)
        if moved < 1e-9:
            break
    odds = rate[:, :, None] * gone / np.maximum((1 - rate[:, :, None]) * rest, 1e-300)
    return {(p, f"{k}: {s}"): float(odds[i, j, m]) for i, p in enumerate(places) for j, k in enumerate(kinds) for m, s in enumerate(shapes) if n[i, j, m]}


def _closed(core: str) -> bool:
    """Whether the bracket or quote at the end was opened shortly before; the brackets of a note, say."""
    pair = {")": "(", "]": "[", "}": "{", "」": "「", "』": "『", "】": "【", "）": "（", "”": "“", "»": "«", '"': '"'}
    at = core.rfind(pair[core[-1]], 0, len(core) - 1)
    return at >= 0


def cut_documents(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``<id_col>, source, cut boolean, odds double`` of every row, also of those without text."""
    full = widen(df.select(F.col(id_col).alias(id_col), F.col(source_col).alias("source"), F.col(text_col).alias("text")))
    placed = _placed(full, id_col)
    table = placed.where("_class is not null or _whole").groupBy("_place", "_class", "_whole").agg(F.count(F.lit(1)).alias("n")).collect()
    complete, stopped = Counter(), Counter()
    for r in table:
        if r["_whole"]:
            stopped[r["_place"]] += r["n"]
            if r["_class"]:
                complete[r["_class"]] += r["n"]
    odds = fit_odds({(r["_place"], r["_class"]): r["n"] for r in table if not r["_whole"]}, complete, stopped, {p: _of_place(p) for p in range(1, PLACES)})
    known = df.sparkSession.createDataFrame([(p, c, False, o) for (p, c), o in odds.items()], "_place int, _class string, _whole boolean, _odds double")
    # at most PLACES times the number of classes, which are combinations of a few properties
    judged = placed.join(F.broadcast(known), ["_place", "_class", "_whole"], "left")
    return judged.select(id_col, "source", (F.coalesce("_odds", F.lit(0.0)) > 1).alias("cut"), F.coalesce("_odds", F.lit(0.0)).alias("odds"))


def _placed(full: DataFrame, id_col: str) -> DataFrame:
    """``<id_col>, source, _place, _class, _whole`` of every row, written once; ``_class`` is the kind and shape, null of a row
    without text and of a whole ending whose words can't be looked up."""
    rows = _endings(full, id_col)
    grams = rows.where("_chain is not null").select("_row", F.posexplode(F.array_append("_chain", F.col("_prose"))).alias("_at", "hash"), F.size("_chain").alias("_size"))
    counts = ending_counts(full, "text", wanted_filter(grams))
    # the counts of each row's grams, by the number that the row was given when it was written; -1 is the last word in prose
    at = F.when(F.col("_at") == F.col("_size"), -1).otherwise(F.col("_at"))
    each = [F.max(F.when(at == i, F.col(c))).alias(f"_{c}{i}") for i in (-1, *range(GRAMS)) for c in ("final", "met")]
    counted = grams.join(counts, "hash").groupBy("_row").agg(*each)
    limits = cut(source_limits(length_histogram(rows)))
    # one row for each source; joined by the engine, which broadcasts it if its measured size allows
    per_source = limits.groupBy("source").agg(F.collect_list(F.struct("unit", "limit", "posterior")).alias("_limits"))
    rows = rows.join(counted, "_row", "left").join(per_source.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left")
    whole = F.coalesce(F.col("_state") == WHOLE, F.lit(False))
    name = F.when(F.col("_chain").isNotNull(), _shape_column()).when(~whole, F.col("_state"))
    out = rows.select(id_col, "source", _place_column().alias("_place"), name.alias("_class"), whole.alias("_whole"))
    return written(out, "placed")


def _shape_column() -> Column:
    """``looked_up`` as an expression of the JVM."""
    name = F.concat(F.when(F.col("_marked"), "marked ").otherwise(""), F.col("_kind"), F.when(F.col("_number"), " number").otherwise(""), F.lit(": "))
    shape = F.when((F.col("_kind") != NAMES[PROSE]) & (F.coalesce("_met-1", F.lit(0)) > 0), "elsewhere").otherwise("new")
    for g in range(1, GRAMS + 1):
        m, f = F.coalesce(f"_met{g - 1}", F.lit(0)), F.coalesce(f"_final{g - 1}", F.lit(0))
        own = F.when(F.col("_own") & (f > 0) & (m > 0), 1).otherwise(0)
        m, f = m - own, f - own
        steps = F.greatest(F.lit(-6), F.least(F.lit(6), F.rint(F.log2((m - f + 0.5) / (f + 0.5))))).cast("int").cast("string")
        part = F.when(F.size("_chain") > 1, "word in part ").otherwise("word ") if g == 1 else F.lit("words ")
        shape = F.when(m >= (2 if g > 1 else 1), F.concat(part, steps)).otherwise(shape)
    return F.concat(name, shape)


def _place_column() -> Column:
    """``place_of`` the ``censoring_posterior`` as an expression of the JVM."""

    def met(x: Column) -> Column:
        hit = F.lit(False)
        for i, u in enumerate(UNITS):
            for size in (F.col("_sizes")[2 * i], F.col("_sizes")[2 * i + 1]):
                hit = hit | ((x["unit"] == u) & F.coalesce(size.between(x["limit"] - SLACK[u], x["limit"]), F.lit(False)))
        return F.when(hit, x["posterior"]).otherwise(F.lit(0.0))

    p = F.coalesce(F.array_max(F.transform("_limits", met)), F.lit(0.0))
    step = F.rint(F.log(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6)))) + 5
    return F.when(F.col("_sizes").isNull() | (p <= 0), FREE).otherwise(F.greatest(F.lit(1), F.least(F.lit(PLACES - 1), step.cast("int")))).cast("int")


def _endings(full: DataFrame, id_col: str) -> DataFrame:
    """All that the judgement of a row needs of its text, written once with a number for each row."""
    own = T.StructType.fromDDL("_state string, _chain array<bigint>, _prose bigint, _kind string, _number boolean, _own boolean, _marked boolean, _sizes array<bigint>")
    schema = T.StructType([full.schema[id_col], full.schema["source"], *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text in b.column(2).to_pylist():
                if not text or not text.strip():
                    found.append((None,) * len(own))
                    continue
                state, e = ending(text)
                found.append((state, *((e.chain, e.prose, NAMES[e.kind], *e[3:]) if e else (None,) * 6), text_sizes(text)))
            columns = zip(*found) if found else [[]] * len(own)
            types = [pa.string(), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(columns, types))], names=[f.name for f in schema])

    return written(full.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "endings")


def text_sizes(text: str) -> list[int | None]:
    """The text's size in each unit, without its mark and with it; a text hardly parted by spaces has no number of words."""
    core = _unmarked(text)
    words = len(core.split())
    parted = len(core) <= MOST_LETTERS * words
    return [len(core), len(text), len(core.encode()), len(text.encode()), words if parted else None, len(text.split()) if parted else None]


def censoring_posterior(sizes: list[int | None], limits: list[dict]) -> float:
    """The greatest posterior of the limits at which a size of the text lies; 0 at none."""
    size = dict(zip(UNITS, zip(sizes[::2], sizes[1::2])))
    return max((x["posterior"] for x in limits for v in size[x["unit"]] if v is not None and x["limit"] - SLACK[x["unit"]] <= v <= x["limit"]), default=0.0)


def place_of(posterior: float) -> int:
    """Step of the posterior's log-odds, from 1; ``FREE`` if it is 0."""
    if posterior <= 0:
        return FREE
    x = math.log(max(posterior, 1e-6) / max(1 - posterior, 1e-6))
    return max(1, min(PLACES - 1, round(x) + 5))


def _of_place(place: int) -> float:
    return 1 / (1 + math.exp(-(place - 5)))
