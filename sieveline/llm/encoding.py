"""Text decoded with the wrong character encoding (problem 1).

Method: the garbled sequences of all pairs (true encoding, wrong decoder) are precomputed for multi-pattern
automata: the decoded bytes of each character of a repertoire for multi-byte encodings, the images of accented letters
for single-byte pairs, of Cyrillic letters in pairs, of the heads of three-byte characters read by East Asian decoders, and
what a decoder leaves of bytes it doesn't know. Sequences of several characters are matched by automata over the runs that
aren't ASCII, those of one character by sets. A text without any of them is clean. A sequence that is impossible in
itself is proof; one that is right elsewhere (a single sign, two letters) only names a place, and counts only where its own
meaning is impossible (a closing quote between two lower-case letters, three accented letters in a row).

Only matched spans are replaced, and text around them stays as it is: single sequences and signs by themselves, runs of a
legacy multi-byte text as a whole, Cyrillic words only if they or the words beside them show the evidence and are likelier
read otherwise. Replacement is repeated for text that was garbled more than once.

Two classes come out. Text whose bytes are all there is restored. Text *beyond repair* (a replacement character, a
question mark inside a word) is found, but what can be restored is restored, and ``complete`` is false.

Defined results: null, empty and clean texts are not garbled and are returned unchanged. The whole text is examined,
however long. Rows delivered twice give one result per distinct (id, field).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import widen

# Encodings that take part in pairs; fixed values.
WRONG_FOR_UTF8 = ["cp1252", "latin_1", "cp1250", "cp437", "cp850", "mac_roman", "iso8859_15", "iso8859_2", "cp1251", "koi8_r", "cp866"]
WIDE_FOR_UTF8 = ["gbk", "big5", "cp949", "shift_jis", "euc_jp"]
SINGLE = ["cp437", "cp850", "mac_roman", "cp1252", "cp1250", "iso8859_2"]
SINGLE_CYRILLIC = ["koi8_r", "cp1251", "cp866", "iso8859_5"]
LEGACY_WIDE = ["euc_kr", "euc_jp", "gbk", "shift_jis", "big5"]

ACCENTED = "".join(chr(i) for i in range(0xC0, 0x180) if chr(i).isalpha())
SIGNS = "".join(chr(i) for i in [*range(0xA0, 0xC0), 0xD7, 0xF7, *range(0x2010, 0x2028), *range(0x2030, 0x203B), 0x20AC, 0x2122, 0x2190, 0x2192, 0x2202, 0x2208, 0x220F, 0x2211, 0x2212, 0x221A, 0x221E, 0x222B, 0x2248, 0x2260, 0x2264, 0x2265, 0xFB01, 0xFB02, 0x2C6, 0x2DC])
GREEK = "".join(chr(i) for i in range(0x391, 0x3CA) if chr(i).isalpha())
CYRILLIC = "".join(chr(i) for i in [0x401, *range(0x410, 0x450), 0x451])
RUSSIAN = set(CYRILLIC)
CAPITALS = set("АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ")
NOT_ASCII = re.compile("[^\\x00-\\x7f]+")
EAST_ASIAN_STOP = re.compile("[。！？；，、]")


def _decode(raw: bytes, codec: str) -> str:
    """Decode as browsers do: bytes without a character in a Windows code page become the control of that number."""
    if codec in ("cp1252", "cp1250", "cp1251"):
        return "".join(_byte(b, codec) for b in raw)
    return raw.decode(codec)


def _byte(b: int, codec: str) -> str:
    try:
        return bytes([b]).decode(codec)
    except UnicodeDecodeError:
        return chr(b)


_ENCODERS: dict[str, dict[str, int]] = {}


def _encode(text: str, codec: str) -> bytes:
    """Inverse of ``_decode``; raises UnicodeEncodeError."""
    if codec in ("gbk", "big5", "cp949", "shift_jis", "euc_jp", "euc_kr"):
        return text.encode(codec)
    if codec not in _ENCODERS:
        _ENCODERS[codec] = {_byte(b, codec): b for b in range(256)}
    table = _ENCODERS[codec]
    try:
        return bytes([table[c] for c in text])
    except KeyError as e:
        raise UnicodeEncodeError(codec, text, 0, 1, str(e)) from None


def _lower_letters(text: str) -> bool:
    return text.isalpha() and text == text.lower()


class Garble:
    """Tables of all pairs, the automaton and the two questions: is a text garbled, and what was it before."""

    def __init__(self) -> None:
        self.sequences: dict[str, dict[str, str]] = {}  # garbled -> {decoder: original}
        for codec in WRONG_FOR_UTF8:
            for ch in ACCENTED + SIGNS + GREEK + CYRILLIC:
                try:
                    bad = _decode(ch.encode("utf-8"), codec)
                except UnicodeDecodeError:
                    continue
                if all(c in RUSSIAN for c in bad) or _lower_letters(bad) or bad.isascii():
                    continue
                self.sequences.setdefault(bad, {}).setdefault(codec, ch)
        for ch in ACCENTED + SIGNS:  # half-width kana in the middle of Latin text
            try:
                bad = ch.encode("utf-8").decode("shift_jis")
            except UnicodeDecodeError:
                continue
            if any("｡" <= c <= "ﾟ" for c in bad):
                self.sequences.setdefault(bad, {}).setdefault("shift_jis", ch)

        # single-byte pairs: the image of each accented letter
        self.images: dict[tuple[str, str], dict[str, str]] = {}
        for true in SINGLE:
            for wrong in SINGLE:
                table = {}
                if true != wrong:
                    for ch in ACCENTED:
                        try:
                            raw = ch.encode(true)
                        except UnicodeEncodeError:
                            continue
                        image = _byte(raw[0], wrong)
                        if image != ch and raw[0] > 127:
                            table[image] = ch
                if table:
                    self.images[true, wrong] = table
        every = {c for t in self.images.values() for c in t}
        plain = set("’'‘-–—·.ºª­ʼ\xa0")
        signs = {c for c in every if not c.isalpha() and c not in plain}
        upper = {c for c in every if c.isalpha() and c != c.lower() and not "Ͱ" <= c <= "ӿ"}
        # Greek letters that don't look like Latin ones
        greek = {c for c in every if "Ͱ" <= c <= "Ͽ" and c in "ΓΘΣΦΩαβδεπστφμ"} | {"ⁿ", "ƒ", "ı"}
        cls = lambda s: "[" + "".join(map(re.escape, sorted(s))) + "]"
        low = "[a-zà-öø-ÿ]"
        letter = "[A-Za-zÀ-ÖØ-öø-ÿ]"
        opening, closing = set("‚„“‹«¡¿£") & signs, set("†‡›¤¦¨¯´¶¸¹¼½¾") & signs
        # each part begins with its characters, so that a search stops only there
        parts = [f"{cls(signs)}(?<={letter}.)(?={low})", f"{cls(upper)}(?<={letter}.)(?={low})", f"{cls(greek)}(?<=[a-z].)(?=[a-z])", f"{cls(opening)}(?<={low}.)(?=[ .,;:)])", f"{cls(closing)}(?:(?<=\\s.)|(?<=^.))(?=[a-z]{{2}})", "Š(?<= Š)(?= [a-z])"]
        self.image_in_place = re.compile("|".join(parts))
        self.image_chars = signs | upper | greek | opening | closing
        #: an image at the edge of a word, taken for one only where the text has others of the same pair
        self.image_any = re.compile(cls(signs | upper | greek))

        wide = {}
        for codec in WIDE_FOR_UTF8[:3]:
            for ch in ACCENTED + SIGNS:
                raw = ch.encode("utf-8")
                try:
                    image = raw[:2].decode(codec)
                except UnicodeDecodeError:
                    continue
                if len(image) == 1 and ord(image) > 0x2E80:
                    wide.setdefault(image, {}).setdefault(codec, ch if len(raw) == 2 else "")
        self.wide = wide
        w = cls(wide)
        self.wide_in_latin = re.compile(f"{w}(?:(?<=[A-Za-z0-9].)|(?=[a-z])|(?<=[0-9] .)(?=[ A-Z])|(?<=[a-z] .)(?= [a-z0-9])|(?<= .)(?=[0-9]))")
        self.certain = re.compile("[\x80-\x9f�]")
        self.lost = re.compile(r"\?(?:(?<=[A-Za-zÀ-ÿ]\?)(?=[a-zß-ÿ])(?!\w+=)|(?<=\(\?)(?=\d)|(?:(?<=\s\?)|(?<=^\?))(?=[a-z]{3})|(?<=\d\?)(?=\d))")
        self.case_flip = re.compile("(?<![А-Яа-яЁё])[а-яё][А-ЯЁ]{2,}|[А-ЯЁ]{2}[а-яё][А-ЯЁ]|[а-яё][А-ЯЁ]{2,}[а-яё]")
        high = re.escape("".join(sorted({_byte(b, codec) for codec in ("cp1252", "latin_1", "cp1250", "cp437", "cp850", "mac_roman") for b in range(128, 256)})))
        self.run = re.compile(f"[{high}]{{3,}}")
        self.any_run = re.compile(f"[{high}](?:[{high} -~]*[{high}])?")
        self.bare_run = re.compile(f"[{high}]{{2,}}")
        self.cyrillic_run = re.compile("[^\\x00-\\x7f]{2,}")
        self.accents = re.compile("[À-ÖØ-öø-ÿ]{3}")
        self.entity = re.compile("(?:&(?:[A-Za-z]+[0-9]*|#[0-9]+);){2,}")
        self.wide_run = re.compile("[^\\x00-\\x7f]{6,}")
        self.cyrillic_word = re.compile("[Ѐ-џ]+")
        self._build()

    def _build(self) -> None:
        """The automata and the sets of single characters."""
        self.lost_chars = {*map(chr, range(0x80, 0xA0)), "�"}
        # three-byte characters and kana read with an East Asian decoder: what their first two bytes become
        self.heads = set()
        for codec in WIDE_FOR_UTF8:
            for raw in [bytes([a, b]) for a in range(0xE2, 0xF0) for b in range(0x80, 0xC0)] + [c.encode("shift_jis") for c in map(chr, range(0x3041, 0x3094))]:
                try:
                    self.heads.add(raw.decode(codec))
                except UnicodeDecodeError:
                    continue
        # Cyrillic read with another Cyrillic decoder: a capital and a small letter change case
        words = dict.fromkeys((a.lower() + b for a in CAPITALS for b in CAPITALS), "flip")
        # two bytes of a legacy encoding, read with a single-byte decoder
        for codec in ("cp1252", "latin_1", "cp1250", "cp437", "cp850", "mac_roman"):
            high = [c for c in (_byte(b, codec) for b in range(128, 256)) if c not in self.lost_chars]
            words |= dict.fromkeys((a + b for a in high for b in high), "legacy")
        self.automaton, self.pairs = ahocorasick.Automaton(), ahocorasick.Automaton()
        for word in self.sequences:
            self.automaton.add_word(word, word)
        for word, kind in words.items():
            self.pairs.add_word(word, kind)
        self.automaton.make_automaton()
        self.pairs.make_automaton()
        self.first_chars, self.pair_chars = {w[0] for w in self.sequences}, {w[0] for w in words}

    # -- detection ------------------------------------------------------------------------------------------------

    def hits(self, s: str) -> list[tuple[int, str]]:
        """Leftmost longest garbled sequences: (start, sequence)."""
        out: list[tuple[int, str]] = []
        for run in NOT_ASCII.finditer(s):
            for end, bad in self.automaton.iter(run.group()):
                start = run.start() + end - len(bad) + 1
                while out and out[-1][0] >= start and len(out[-1][1]) < len(bad):
                    out.pop()
                if not out or start >= out[-1][0] + len(out[-1][1]):
                    out.append((start, bad))
        return out

    def _legacy_run(self, s: str) -> bool:
        if self.accents.search(s):
            return True
        for m in self.run.finditer(s):
            t = m.group()
            odd = sum(1 for c in t if not (c.isalpha() and c == c.lower()))
            if odd >= 2 and (len(t) >= 4 or odd == 3) and not all(c in "’”“‘…–—»«°€£\xa0" for c in t):
                return True
        return False

    def _round_trip(self, s: str) -> bool:
        """Whether some run of East Asian characters has bytes that are nearly all right UTF-8 in themselves."""
        return any(self._as_utf8(part) for run in self.wide_run.findall(s) for part in EAST_ASIAN_STOP.split(run))

    def _as_utf8(self, run: str) -> bool:
        if len(run) < 6 or not any("⺀" <= c <= "힣" for c in run):
            return False
        for codec in WIDE_FOR_UTF8[:3]:
            raw = run.encode(codec, "ignore")
            back = raw.decode("utf-8", "ignore")
            if len(raw) > len(run) and len(back) < len(run) and len(back.encode("utf-8")) >= 0.8 * len(raw):
                return True
        return self._wide_for_wide(run) != run

    @staticmethod
    def _wide_for_wide(run: str) -> str:
        """A run of ideographs that is Japanese in a legacy encoding read with the decoder of another one.

        Read rightly it is one-fifth hiragana, which ideographs read so by mistake never give. (Korean can't be told this
        way: common Chinese characters share their bytes with Hangul syllables.)
        """
        if sum("㐀" <= c <= "鿿" for c in run) < 0.6 * len(run):
            return run
        for wrong in WIDE_FOR_UTF8[:3]:
            raw = run.encode(wrong, "ignore")
            if len(raw) < 1.8 * len(run):
                continue
            t = raw.decode("shift_jis", "ignore")
            if len(t) >= 6 and len(t) * 2.2 >= len(raw) and 5 * sum("ぁ" <= c <= "ん" for c in t) >= len(t):
                return t
        return run

    def evidence(self, s: str | None) -> str | None:
        """The kind of sequence that shows a text to be garbled, None of a clean one.

        Automata and sets name the kinds met; a kind that may be right elsewhere is checked where it stands.
        """
        if not s:
            return None
        if not s.isascii():
            chars = set(s)
            if chars & self.lost_chars:
                return "lost"
            if chars & self.first_chars and (found := self.hits(s)):
                soft = [b for _, b in found if any(c in RUSSIAN for c in b) or all(o in CYRILLIC + GREEK for o in self.sequences[b].values())]
                if len(found) > len(soft) or len(soft) > 1:
                    return "sequence"
            if chars & self.image_chars and self.image_in_place.search(s):
                return "image"
            if chars & self.pair_chars:
                met = {kind for run in NOT_ASCII.findall(s) if len(run) > 1 for _, kind in self.pairs.iter(run)}
                if "legacy" in met and self._legacy_run(s):
                    return "legacy"
                if "flip" in met and self.case_flip.search(s):
                    return "flip"
            if chars & self.wide.keys() and self.wide_in_latin.search(s):
                return "wide"
            if chars & self.heads and self._round_trip(s):
                return "head"
        if "&" in s and (m := self.entity.search(s)) and not (t := html.unescape(m.group())).isascii() and (self.hits(t) or self.certain.search(t) or self._legacy_run(t)):
            return "entity"
        return "lost" if "?" in s and "://" not in s and self.lost.search(s) is not None else None

    def is_garbled(self, s: str | None) -> bool:
        return self.evidence(s) is not None

    # -- restoration ----------------------------------------------------------------------------------------------

    def _whole_runs(self, s: str) -> str:
        """Runs that are one text of several bytes a character read with a single-byte decoder."""

        def options(run: str, true: tuple[str, ...]) -> Iterator[str]:
            for wrong in WRONG_FOR_UTF8:
                try:
                    raw = _encode(run, wrong)
                except UnicodeEncodeError:
                    continue
                for codec in true:
                    try:
                        yield raw.decode(codec)
                    except UnicodeDecodeError:
                        continue

        def likelier(run: str, true: tuple[str, ...], share: float) -> str:
            costs = {t: self._cost(t) for t in dict.fromkeys(options(run, true))}  # most runs have no reading
            t = min(costs, key=costs.get, default=run)
            return t if costs and costs[t] < share * self._cost(run) else run

        def utf8(m: re.Match) -> str:
            return likelier(m.group(), ("utf-8",), 1.0)

        def legacy(m: re.Match) -> str:
            return likelier(m.group(), (*LEGACY_WIDE, *SINGLE_CYRILLIC), 0.3) if self._legacy_run(m.group()) else m.group()

        for runs in (self.any_run, self.bare_run, self.cyrillic_run):
            s = runs.sub(utf8, s)
        return self.any_run.sub(legacy, s)

    def _cost(self, s: str) -> float:
        if s.isascii():
            return 0.0
        odd = len(self.certain.findall(s)) * 2 + len(self.hits(s)) * 2 + len(self.image_in_place.findall(s)) + 3 * self._legacy_run(s) + len(self.case_flip.findall(s)) + len(self.wide_in_latin.findall(s))
        common = sum(1 for c in s if "가" <= c <= "힣" or "぀" <= c <= "ヿ" or "一" <= c <= "鿿" or "а" <= c <= "я")
        rare = sum(1 for c in s if "｡" <= c <= "ﾟ" or "" <= c <= "" or "㐀" <= c <= "䶿")
        return odd + 2 * rare - 0.01 * common

    def _sequences(self, s: str) -> str:
        found = self.hits(s)
        if not found:
            return s
        votes = Counter(codec for _, b in found for codec in self.sequences[b])
        out, upto = [], 0
        for start, bad in found:
            options = self.sequences[bad]
            codec = max(options, key=lambda c: (votes[c], -WRONG_FOR_UTF8.index(c) if c in WRONG_FOR_UTF8 else -99))
            out += [s[upto:start], options[codec]]
            upto = start + len(bad)
        return "".join([*out, s[upto:]])

    def _images(self, s: str) -> str:
        places = [m.start() for m in self.image_in_place.finditer(s)]
        if not places:
            return s
        best, score = None, 0.0
        for pair, table in self.images.items():
            back = [table.get(s[i], "") for i in places]
            got = sum(1 + 0.1 * (c in "éèáíóúñçãõäöüßêàâ") for c in back if c and c == c.lower())
            if got > score:
                best, score = table, got
        if best is None:
            return s
        chars = list(s)
        for i in places:
            chars[i] = best.get(s[i], s[i])
        # the same images at the edges of words, unless the sign is right where it stands
        for m in re.finditer(r"(?<=[a-z])[‚ˆ‡ƒ…Š†“”•–—](?=[ ,.;:])|(?:(?<=\s)|^)[\x80-\x9fŽ“‚](?=[a-z])", "".join(chars)):
            i = m.start()
            if chars[i] == s[i] and chars[i] not in "…“”–—" and chars[i] in best:
                chars[i] = best[chars[i]]
        return "".join(chars)

    def _wide(self, s: str) -> str:
        def back(m: re.Match) -> str:
            options = [o for o in self.wide[m.group()].values() if o]
            return options[0] if options else m.group()

        def run(m: re.Match) -> str:
            for codec in WIDE_FOR_UTF8:
                try:
                    t = m.group().encode(codec).decode("utf-8")
                except UnicodeError:
                    continue
                if len(t) < len(m.group()) or codec == "gbk":
                    return t
            return m.group()

        s = self.wide_run.sub(lambda m: self._wide_for_wide(m.group()), s)
        s = re.sub("[⺀-鿿가-힣]{2,}", run, s) if self._round_trip(s) or self.wide_in_latin.search(s) else s
        return self.wide_in_latin.sub(back, s)

    def _cyrillic(self, s: str) -> str:
        """Cyrillic words read with another Cyrillic decoder: those with a case that no word has, and the words beside them
        (with nothing but ASCII between) that are likelier, too, once read otherwise."""
        if not self.case_flip.search(s):
            return s

        def odd(word: str) -> float:  # the commonest letters of Russian, against capitals within a word
            return 2.0 * sum(b in CAPITALS for b in word[1:]) - sum(c in "оеаинтсрвл" for c in word)

        words = [(m.start(), m.end()) for m in self.cyrillic_word.finditer(s)]
        shown = [self.case_flip.search(s[a:b]) is not None for a, b in words]
        best, gain = s, 0.0
        for wrong in SINGLE_CYRILLIC:
            for true in SINGLE_CYRILLIC:
                if true == wrong:
                    continue
                read = [_try(s[a:b], wrong, true) for a, b in words]
                better = [odd(s[a:b]) - odd(t) for (a, b), t in zip(words, read)]
                take = [f and g > 0 for f, g in zip(shown, better)]
                for order in (range(1, len(words)), range(len(words) - 2, -1, -1)):
                    for i in order:
                        j = i - 1 if order.step > 0 else i + 1
                        if not take[i] and take[j] and better[i] > 0 and s[min(words[i][1], words[j][1]) : max(words[i][0], words[j][0])].isascii():
                            take[i] = True
                if (g := sum(x for x, t in zip(better, take) if t)) > gain:
                    out, upto = [], 0
                    for (a, b), t, some in zip(words, read, take):
                        if some:
                            out += [s[upto:a], t]
                            upto = b
                    best, gain = "".join([*out, s[upto:]]), g
        return best

    def restore(self, s: str | None) -> tuple[str | None, bool]:
        """The text before, as far as it can be told, and whether nothing garbled is left."""
        if not s or not self.is_garbled(s):
            return s, True
        t = s
        if "&" in t and self.entity.search(t):
            t = self.entity.sub(lambda m: html.unescape(m.group()), t)
        if 3 * sum(c > "\x7f" for c in t) < len(t):  # single accents and signs among plain text
            quick = t
            for _ in range(3):
                quick = self._images(self._sequences(quick))
                if not self.is_garbled(quick):
                    return quick, True
        for _ in range(3):
            before = t
            t = self._sequences(self._whole_runs(t))
            t = self._images(self._cyrillic(self._wide(t)))
            if t == before:
                break
        return t, not self.is_garbled(t)


def _try(text: str, wrong: str, true: str) -> str:
    try:
        return _encode(text, wrong).decode(true)
    except UnicodeError:
        return text


_garble: list[Garble] = []


def garble() -> Garble:
    """The tables of this worker; made once."""
    if not _garble:
        _garble.append(Garble())
    return _garble[0]


#: What a garbled text must hold; texts without it need not leave the JVM.
MAYBE = r"[^\x00-\x7F]|&#?[A-Za-z0-9]+;&|\?[a-z0-9]"


def as_fields(df: DataFrame, id_col: str, fields: list[str], *extra: str) -> DataFrame:
    """One row for each record and field: ``work_id, <extra>, field_name, value``; without nulls and empty texts."""
    pairs = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]
    rows = widen(df.select(id_col, *extra, *fields)).select(F.col(id_col).alias("work_id"), *extra, F.explode(F.array(*pairs)).alias("f"))
    return rows.select("work_id", *extra, "f.field_name", "f.value").where(F.length("value") > 0)


def garbled_fields(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``work_id, field_name, value, restored, complete`` of every garbled field, once for each distinct value."""
    rows = as_fields(df, id_col, fields).where(F.col("value").rlike(MAYBE))
    schema = T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType()), T.StructField("complete", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = garble()
        for b in batches:
            values = b.column(2).to_pylist()
            at = [i for i, v in enumerate(values) if g.is_garbled(v)]
            back = [g.restore(values[i]) for i in at]
            kept = b.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([t for t, _ in back], pa.string()), pa.array([c for _, c in back], pa.bool_())], schema=pa.schema([*kept.schema, ("restored", pa.string()), ("complete", pa.bool_())]))

    return rows.mapInArrow(run, schema).distinct()
