import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from sieveline.llm.language import LANGS, START, Model, SuffixAutomaton, Tables, canonical_label, fit, label_segments, mislabelled, start_texts


@settings(max_examples=80, deadline=None)
@given(st.text("abc", max_size=30), st.text("abcd", max_size=20))
def test_phrases_against_brute_force(text, query):
    a = SuffixAutomaton(text)
    n = i = 0
    while i < len(query):
        j = i
        while j < len(query) and query[i : j + 1] in text:
            j += 1
        n += 1 if j > i else 2
        i = max(j, i + 1)
    assert a.phrases(query) == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=25), min_size=2, max_size=3), st.lists(st.text("abc", min_size=1, max_size=20), max_size=8))
def test_tables_parse_as_the_automata_do(texts, queries):
    automata = [SuffixAutomaton(t) for t in texts]
    tables = Tables(automata)
    joined = "".join(queries)
    end = np.cumsum([len(q) for q in queries]).astype(np.int64)
    begin = end - np.array([len(q) for q in queries], np.int64)
    codes = tables.code[np.array([ord(c) for c in joined], np.int64)]
    got = tables.phrases(codes, begin, end)
    for q, row in zip(queries, got):
        for t, k in zip(texts, row):
            n, i = 1, 0
            held = ""
            for c in q:
                if held + c in t:
                    held += c
                else:
                    n, held = n + 1, c if c in t else ""
            assert k == n


def test_the_start_shares_no_run_with_the_data():
    """Four words in a row, or eight letters where words aren't parted, of the start are in no title or abstract."""
    import os

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.01/bib_store.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    t = pq.read_table(path, columns=["title_display", "abstract_display"])
    corpus = " ".join(v.lower() for c in t.columns for v in c.to_pylist() if v)
    words = " ".join(re.findall(r"[^\W\d_]+", corpus))
    for lang, start in START.items():
        w = re.findall(r"[^\W\d_]+", start)
        runs = ["".join(w)[i : i + 8] for i in range(len("".join(w)) - 7)] if lang in ("ja", "zh") else [f" {' '.join(w[i : i + 4])} " for i in range(len(w) - 3)]
        assert [r for r in runs if r in (corpus if lang in ("ja", "zh") else words)] == []


@pytest.mark.parametrize("label,lang", [("en", "en"), ("EN", "en"), ("en_GB", "en"), ("pt-BR", "pt"), ("deu", "de"), ("ger", "de"), ("English", "en"), ("chi", "zh"), ("zh-CN", "zh"), ("la", None), ("mul", None), ("", None), (None, None), ("xx", None), ("en, fr", None), ("und", None)])
def test_labels(label, lang):
    assert canonical_label(label) == lang


HELD_OUT = {"en": "The harbour was closed because of the storm and the ships had to wait for two days.", "de": "Der Hafen wurde wegen des Sturms geschlossen und die Schiffe mussten zwei Tage warten.", "fr": "Le port a été fermé à cause de la tempête et les navires ont dû attendre deux jours.", "es": "El puerto fue cerrado por la tormenta y los barcos tuvieron que esperar dos días.", "pt": "O porto foi fechado por causa da tempestade e os navios tiveram de esperar dois dias.", "it": "Il porto è stato chiuso a causa della tempesta e le navi hanno dovuto aspettare due giorni.", "nl": "De haven werd gesloten vanwege de storm en de schepen moesten twee dagen wachten.", "pl": "Port został zamknięty z powodu burzy, a statki musiały czekać dwa dni.", "ru": "Порт был закрыт из-за шторма, и корабли должны были ждать два дня.", "ko": "폭풍 때문에 항구가 닫혀서 배들은 이틀을 기다려야 했다.", "ja": "嵐のために港は閉鎖され、船は二日間待たなければならなかった。", "zh": "由于暴风雨港口关闭，船只不得不等待两天。"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text("aé1. =/|()[]?!…。\n\"’_ß𝐀한语", max_size=30), st.text(max_size=20)), max_size=6), st.booleans())
def test_segments_are_those_of_the_patterns(texts, titles):
    from sieveline.llm.language import WORD, pieces

    texts = [t.replace("\x01", " ") for t in texts]
    number, cost, letters, words = SMALL.parse(texts, titles)
    want = [(k, len(WORD.findall(p.lower()))) for k, t in enumerate(texts) for p in pieces(t, titles)]
    assert list(zip(number.tolist(), words.tolist())) == want and len(cost) == len(letters) == len(want)


SMALL = Model(start_texts())


def test_codes_and_scripts_are_looked_up_with_the_kinds():
    """One lookup a character, as wide as the states that the codes are added to."""
    from sieveline.llm.language import CODE_AT, SCRIPT_AT

    latin = SMALL.latin
    for marks in SMALL.marks.values():
        assert marks.dtype == latin.code.dtype == latin.to.dtype and (marks >> CODE_AT == latin.code).all()
        assert [int(marks[ord(c)] >> SCRIPT_AT & 7) for c in "aéжо한語 1"] == [1, 1, 2, 2, 3, 4, 0, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aZé\x01\xad\u200b\u0301\uff21\ufb01\n α"), st.characters(min_codepoint=0x360, max_codepoint=0x540)), max_size=6))
def test_texts_that_change_are_all_made_plain(text):
    import pyarrow as pa
    import pyarrow.compute as pc

    from sieveline.llm.language import MAY_BE_ODD, _plain

    assert _plain(text) == text or pc.match_substring_regex(pa.array([text]), MAY_BE_ODD).to_pylist() == [True]


def test_held_out_sentences_with_the_start_alone():
    model = Model(start_texts())
    number, best, confidence, _, _ = model.label(list(HELD_OUT.values()), False)
    first = {}
    for n, b, c in zip(number, best, confidence):
        first.setdefault(int(n), LANGS[b] if b >= 0 else None)
    assert sum(first[i] == k for i, k in enumerate(HELD_OUT)) >= 11


def test_operator(spark, rows):
    en, de = HELD_OUT["en"], HELD_OUT["de"]
    data = [("1", en, None, "en", "x"), ("2", de, en + " " + de, "en", "x"), ("3", de, None, "DEU", "y"), ("4", None, "", None, None), ("5", "short", de * 300, "de", "z"), ("6", de.replace("ö", "Ã¶").replace("ü", "Ã¼"), None, "de_AT", "z"), (None, f"{en[:-1]} = {de[:-1]}", None, "de", ""), ("1", en, None, "en", "x")]
    df = spark.createDataFrame(data, "work_id string, title string, abstract string, language string, field_name string")
    words = fit(df, "language", ["title", "abstract"])
    got = rows(mislabelled(df, "work_id", ["title", "abstract"], "language", words))
    assert got == [("2", "abstract", ["en", "de"]), ("2", "title", ["de"]), (None, "title", ["en", "de"])]
    seg = label_segments(df, "work_id", ["title", "abstract"], words).where("work_id = '2' and field_name = 'abstract'").first()["segments"]
    assert [s["lang"] for s in seg] == ["en", "de"] and all(s["confidence"] > 0.9 for s in seg)
    assert mislabelled(df.limit(0), "work_id", ["title"], "language", fit(df.limit(0), "language", ["title"])).count() == 0
