"""One consistent form for texts that look the same but differ in their characters (problem 6).

Method: invisible characters go, every space is one space, width forms, ligatures and letter-like signs become plain
letters, accents are composed. Then each token is spelled in one script. Every letter belongs to a class of letters of
the same look, and a class has a spelling in some of Latin, Cyrillic, Greek, Armenian and Cherokee; the sets of scripts are intersected over
the token. A token with one possible script is spelled in it (mixed-script confusables). A token with several (whole-script
confusables) takes the script of most one-script tokens of the same text, Latin if that doesn't decide. A token with
none is a real mixture and keeps the look of each letter. All choices depend on the look alone, so texts that look the
same get equal forms. Letter case, accents, digits, dashes, quotes, superscripts and fractions are left as they are.

Spaces at the ends and runs of spaces don't count. A null text has the form null, an empty or blank one the empty text,
and is no case. Repeated rows count once, extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import written

# Letters of the same look; position by position.
LATIN_C = "aeopcyxijshdqwlABEKMHOPCTXSIJYZNungDGLRUVW"
CYRILLIC = "аеорсухіјѕһԁԛԝӏАВЕКМНОРСТХЅІЈУ            "
GREEK = "  ο            ΑΒΕΚΜΗΟΡ ΤΧ Ι ΥΖΝ          "
ARMENIAN = "  օ     յ հ զ        Օ    Տ     սոց  Լ Ս  "
CHEROKEE = "               ᎪᏴᎬᏦᎷᎻ ᏢᏟᎢ Ꮪ ᎫᎩᏃ    ᎠᏀᏞᏒ ᏙᎳ"

#: classes whose Cyrillic letter belongs to few languages
RARE = "sjhdqwl"

INVISIBLE = dict.fromkeys([0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF])
SPACES = re.compile(r"[\s\x1c-\x1f\x85]+")
HYPHENS = {0x2010: "-", 0x2011: "-", 0xFE63: "-", 0xFF0D: "-", 0xB5: "μ"}
#: Width forms, ligatures of f, Roman numerals: their compatibility form has the same look.
SAME_LOOK = re.compile("[！-￮ﬀ-ﬆⅠ-ⅿ]")
TOKEN = re.compile(r"[^\W\d_]+")
SCRIPTS = ("latin", "cyrillic", "greek", "armenian", "cherokee")
#: A text of printable ASCII without outer or double spaces has itself as its form.
PLAIN = r"^(?:[\x21-\x7E]+(?: [\x21-\x7E]+)*)?$"


class Forms:
    def __init__(self) -> None:
        self.spell: dict[str, dict[str, str]] = {}  # prototype -> script -> letter
        self.proto: dict[str, str] = {}
        for letters in zip(LATIN_C, CYRILLIC, GREEK, ARMENIAN, CHEROKEE, strict=True):
            lat = letters[0]
            self.spell[lat] = {k: c for k, c in zip(SCRIPTS, letters) if c != " "}
            self.proto |= dict.fromkeys(self.spell[lat].values(), lat)
        self.foreign = re.compile("[Ͱ-ӿԀ-֏Ꭰ-ᏽ]")

    @staticmethod
    def _own(c: str) -> str | None:
        """Script of a letter that looks like no letter of another script."""
        if c <= "ɏ" or "Ḁ" <= c <= "ỿ":
            return "latin"
        if "Ѐ" <= c <= "ԯ":
            return "cyrillic"
        if "\u0530" <= c <= "\u058f":
            return "armenian"
        if "Ꭰ" <= c <= "ᏽ":
            return "cherokee"
        return "greek" if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" else None

    def _scripts(self, letters: str) -> set[str]:
        """Scripts in which all letters have a spelling; letters without a script take part in any."""
        left = set(SCRIPTS)
        for c in set(letters):
            if not unicodedata.combining(c):
                p = self.proto.get(c)
                left &= self.spell[p].keys() if p else {self._own(c)} if self._own(c) else left
        return left

    def canonical(self, text: str | None) -> str | None:
        if text is None:
            return None
        s = text.translate(INVISIBLE).translate(HYPHENS)
        if SAME_LOOK.search(s):
            s = SAME_LOOK.sub(lambda m: unicodedata.normalize("NFKC", m.group()), s).translate(HYPHENS)
        s = SPACES.sub(" ", unicodedata.normalize("NFC", s)).strip()
        if not self.foreign.search(s):
            return s
        # letters with accents are taken apart, so that an accent on either letter gives the same
        apart = unicodedata.normalize("NFD", s)
        tokens = [(m.start(), m.end(), self._scripts(m.group())) for m in re.finditer(r"(?:[^\W\d_][̀-ͯ]*)+", apart)]
        votes = {k: sum(scripts == {k} for _, _, scripts in tokens) for k in SCRIPTS}
        most = max(SCRIPTS, key=lambda k: votes[k])
        out, upto = [], 0
        for start, end, scripts in tokens:
            rare = any(self.proto.get(c, "") in RARE for c in apart[start:end])  # hardly a Cyrillic word: Latin, if it can be
            script = "latin" if rare and "latin" in scripts else most if most in scripts else next((k for k in SCRIPTS if k in scripts), None)
            out.append(apart[upto:start])
            for c in apart[start:end]:
                p = self.proto.get(c)
                out.append(c if p is None else self.spell[p].get(script, p) if script else p)
            upto = end
        return unicodedata.normalize("NFC", "".join([*out, apart[upto:]]))


_forms: list[Forms] = []


def forms() -> Forms:
    if not _forms:
        _forms.append(Forms())
    return _forms[0]


def with_form(df: DataFrame, text_col: str, name: str = "form") -> DataFrame:
    """``df`` with the consistent form of ``text_col``; plain ASCII texts never leave the JVM. A column of that name is replaced."""
    df = df.drop(name)
    plain = F.coalesce(F.col(text_col).rlike(PLAIN), F.lit(True))
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType(), True)])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forms()
        for b in batches:
            made = [f.canonical(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=schema.names)

    return df.where(plain).withColumn(name, F.col(text_col)).unionByName(df.where(~plain).mapInArrow(run, schema))


#: Works of one text in a part of the join that widens pairs to works.
PART = 2_000


def same_look_pairs(texts: DataFrame) -> DataFrame:
    """Pairs of works whose texts in the same field look the same but aren't equal.

    ``texts`` has (field_name, work_id, text). Of several texts of one form at most one is the form itself, so every
    group with two texts holds a changed one: only the forms of changed texts are looked up among the others. Pairs
    are made between distinct texts of a form, then each side is widened to its works, in parts if it has more than ``PART``;
    equal texts of a large group are never compared with each other.
    """
    rows = texts.where(F.col("work_id").isNotNull() & (F.length("text") > 0)).select("field_name", "work_id", "text")
    formed = with_form(rows, "text").where(F.col("form") != "")
    changed = written(formed.where(F.col("form") != F.col("text")).distinct(), "changed")  # a few per cent of the rows
    forms_ = changed.select("field_name", F.col("form").alias("text")).distinct()
    same = rows.join(forms_, ["field_name", "text"], "left_semi").distinct().withColumn("form", F.col("text"))
    members = written(changed.unionByName(same.select(*changed.columns)), "members")
    variants = members.select("field_name", "form", "text").distinct()
    x, y = variants.alias("x"), variants.alias("y")
    on = (F.col("x.field_name") == F.col("y.field_name")) & (F.col("x.form") == F.col("y.form")) & (F.col("x.text") < F.col("y.text"))
    pairs = x.join(y, on).select("x.field_name", F.col("x.text").alias("text"), F.col("y.text").alias("other"))
    parts = members.groupBy("field_name", "text").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    large = parts.where("parts > 1")  # few texts, if any, have so many works
    one = F.coalesce("parts", F.lit(1))
    salted = members.select("field_name", "text", "work_id").join(large, ["field_name", "text"], "left").withColumn("salt", F.pmod(F.xxhash64("work_id"), one).cast("int")).drop("parts")
    each = F.explode(F.sequence(F.lit(0), one - 1))

    def widened(rows: DataFrame) -> DataFrame:
        return rows.join(large, ["field_name", "text"], "left").withColumn("salt", each).drop("parts").join(salted, ["field_name", "text", "salt"])

    first = widened(pairs).select("field_name", F.col("other").alias("text"), F.col("work_id").alias("one"))
    both = widened(first).where(F.col("one") != F.col("work_id"))
    return both.select("field_name", F.least("one", "work_id").alias("work_id_a"), F.greatest("one", "work_id").alias("work_id_b")).distinct()
