import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveline.llm.residue import MARK, MAY_MARK, STYLES, TAG, WORDY, _filler, _tokens, make_lexicon, residue_evidence, residue_fields, span_scores

SCHEMA = "work_id string, title_display string, abstract_display string"
FIELDS = ["title_display", "abstract_display"]
PROSE = "Growth rose in all coastal towns during the wet years"


def corpus(*extra):
    """Prose in both fields, and two error templates that works hold in either field."""
    data = [(f"p{i}", f"Rain and {w} in towns", f"{PROSE} of {w} {i}. We measured {w} with gauges at many sites.") for i in range(60) for w in ("wheat", "rye", "barley")]
    data += [(f"e{i}", f"Please enable JavaScript on page {i}", PROSE) for i in range(6)] + [(f"f{i}", "Oats", f"{PROSE}. Please enable JavaScript on page {i}") for i in range(6)]
    return [*data, *extra]


def found(spark, data):
    return {tuple(r) for r in residue_fields(spark.createDataFrame(data, SCHEMA), "work_id", FIELDS).collect()}


def test_templates_are_aligned_whatever_they_say(spark):
    got = found(spark, corpus(("x", "Kindly enable JavaScript", None), ("q", "Please enable JavaScript?", None)))
    assert got == {(f"e{i}", "title_display") for i in range(6)} | {(f"f{i}", "abstract_display") for i in range(6)} | {("x", "title_display")}


def test_a_notice_running_on_in_a_long_segment(spark):
    long = f"{PROSE} " * 9 + "please enable JavaScript on page 3"
    assert len(long) > 466
    assert ("long", "abstract_display") in found(spark, corpus(("long", "Oats", long), ("head", "Oats", "Please enable JavaScript on page 7 " + f"{PROSE} " * 400)))
    assert ("head", "abstract_display") in found(spark, corpus(("head", "Oats", "Please enable JavaScript on page 7 " + f"{PROSE} " * 400)))


def test_forms_of_names(spark):
    data = corpus(*[(f"{i}{k}", t, "Hail") if k else (f"{i}{k}", "Hail", t) for i in range(3) for k in range(2) for t in ["<insert your name here>"]])
    data += [("1", "<page_title/>", None), ("2", "[page_title]", None), ("3", "%page_title%", None), ("4", "<body_text/>", None), ("5", "{{body_text}}", None), ("6", "@@body_text@@", None)]
    got = found(spark, data)
    assert {(k, "title_display") for k in "123456"} <= got and ("00", "abstract_display") in got and ("01", "title_display") in got


def test_names_learned_from_the_corpus(spark):
    data = [("1", "{{ summary }}", None), ("2", "A study. [summary]", "%summary%"), ("3", "Uptake of [tracer] in mice", "plain"), ("4", None, ""), (None, "${x_name}", None), ("5", "${summary}", None), ("1", "{{ summary }}", None), ("6", "Groups [A] and {A}", None)]
    assert found(spark, data) == {("1", "title_display"), ("2", "abstract_display"), ("2", "title_display"), ("5", "title_display")}


def test_frames_holding_the_fields_own_name(spark):
    data = [(f"{k}{i}", "Kindly supply the title" if k else "Ice", "Snow" if k else "Kindly supply the abstract") for i in range(4) for k in range(2)] + [("9", "How the title shapes reading", "rain")]
    got = found(spark, data)
    assert len(got) == 8 and all(w != "9" for w, _ in got)


def test_headings_and_copied_titles_are_no_templates(spark):
    prose = "Growth rose in all coastal towns."
    data = [("1", "Escriba aquí el resumen", prose), ("2", "Rain", "Escriba aquí el resumen"), ("3", "Snow", "Escriba aquí el resumen. It rained."), ("4", "Our shelves fell over (no 17)", "Hail"), ("5", "Our shelves fell over (no 4)", "Ice"), ("6", "Fog", f"{prose} | Our shelves fell over (no 233)")]
    data += [(f"c{i}", "Meeting of the society", "Meeting of the society") for i in range(4)]  # titles copied into their abstracts
    data += [(f"h{i}", f"Fog {i}", f"Materials and methods | {prose}") for i in range(40)] + [("t", "Materials and methods", "Dew")]
    assert found(spark, data) == {("1", "title_display"), ("2", "abstract_display"), ("3", "abstract_display"), ("4", "title_display"), ("5", "title_display"), ("6", "abstract_display")}


def test_filler_and_clean_texts():
    bad = ["blah blah blah", "rain fell. dummy text dummy text dummy text", "lorem ipsum dolor sit amet consectetur", "nostrud commodo consequat magna aliquip tempor"]
    clean = ["filler text and reading speed does pseudo latin matter ?", "a post hoc test gave p 0", "0 0 0 0", "et et al al al", ""]
    row, token, segment = _tokens(pa.array([[t] for t in bad + clean]))
    assert _filler(token, segment, len(row)).tolist() == [True] * len(bad) + [False] * len(clean)
    assert _filler(pa.array([], pa.string()), np.zeros(0, np.int64), 0).tolist() == []


def test_span_scores_against_brute_force():
    rng = np.random.default_rng(3)
    segment = np.sort(rng.integers(0, 40, 300))
    weight = rng.normal(size=300)
    whole, best = span_scores(weight, segment, 41)
    for k in range(41):
        w = weight[segment == k]
        assert (not len(w) and best[k] == -np.inf) or (np.isclose(whole[k], w.sum()) and np.isclose(best[k], max(max(w[:i].sum(), w[len(w) - i :].sum()) for i in range(4, len(w) + 1)) if len(w) > 3 else -np.inf))


def test_lexicon():
    lex = make_lexicon({"enable": 5, "the": 5}, {"enable": 5, "the": 500}, 12, 5000, (5, 600), ["the enable"])
    weight = dict(zip(lex.words, lex.weight))
    assert weight["enable"] > 3 > weight["the"] and lex.other <= -1 and lex.least > 4
    weigh = lex.weigher()
    alone, got = weigh(pa.array(["the", "enable", "enable", "the", "rain"]), np.array([0, 0, 0, 1, 1]))
    assert alone.tolist()[:2] == got.tolist()[:2] and got.tolist() == [weight["the"], weight["enable"], lex.other, min(lex.other, weight["the"]), lex.other]


def test_empty_long_clashing_names(spark):
    df = spark.createDataFrame([(k, "rain " * 20_000 + v, None, "c") for k, v in [("1", "${abstract}"), ("2", "%abstract%"), ("3", "[[abstract]]")]], f"{SCHEMA}, frames string")
    assert residue_fields(df, "work_id", ["title_display"]).count() == 3
    assert residue_fields(df.limit(0), "work_id", ["title_display"]).count() == 0
    assert residue_evidence(df, "work_id", ["abstract_display"]).count() == 0


def test_frames_are_matched_against_the_pattern_once(spark):
    """The counts and the last join read the hashes written with the frames."""
    plan = residue_evidence(spark.createDataFrame(corpus(), SCHEMA), "work_id", FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "hashes" in plan and "RLIKE" not in plan


def test_percentages_and_brackets_are_no_marks():
    texts = pa.array(["95 % of the 40 towns and 30% of the rest (p < 0.05)", "rain [12, 13] and {1, 2}", "an interval [0.4; 0.6]", "a % b"])
    assert pc.match_substring_regex(texts, MAY_MARK).to_pylist() == [False] * 4


PARTS = [x for a, b in STYLES for x in (a, b)] + ["a", "é", "²", "٣", "0", " ", "\xa0", "\x1f", "\n", "_", ".", "-", "|", "/", "$", "%s", "%1$s", "{0}", "</p>", "<b class='x'>", "name", "Titel der Arbeit"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=9).map("".join))
def test_texts_with_a_mark_or_a_tag_are_all_read(text):
    if MARK.search(text) or TAG.search(text):
        assert pc.match_substring_regex(pa.array([text]), MAY_MARK).to_pylist() == [True]


def test_the_lazy_pattern_finds_the_frames_of_the_greedy_one(spark):
    rng = np.random.default_rng(8)
    frames = [" ".join(rng.choice(["a", "ab", "abc", "é", "жук", "▢", "字", "0", "00", "?", "x1", "1ab"], rng.integers(1, 7))) for _ in range(3000)]
    greedy = WORDY.replace(".*? )??", ".* )?")
    assert greedy != WORDY and spark.createDataFrame([(f,) for f in frames], "frame string").where(F.col("frame").rlike(WORDY) != F.col("frame").rlike(greedy)).count() == 0
