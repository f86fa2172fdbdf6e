import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm.encoding import Garble, garbled_fields

G = Garble()
CLEAN = [
    "São Teravo – “naïve” façade, 5–12 °C ± 0.3 µg… §4", "INFORMAÇÃO CLÍNICA NÃO DISPONÍVEL EM TODAS AS REGIÕES", "Größere Höhenunterschiede in Göldern", "la città è già umida perché", "Średnia wartość wzrosła", "Результаты показывают, что рост зависит от воды", "수질이 뿌리 생장에 미치는 영향 (자료 RX-2156)", "読解力が根の成長に与える影響 (資料PC-22)", "物种多样性对睡眠时间的影响 [18F]", "诺里奥地区阅读能力与骨密度的长期观测报告 (资料AF-50248)", "Kraňov: α-helix and β-sheet, x ≥ 3, R²", "durée » et « été »", "Is it so? yes", "Hearing thresholds near Ångström", "http://x.org/?a=b", "", "plain",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay(text):
    assert not G.is_garbled(text) and G.restore(text) == (text, True)


SENTENCE = "La façade près de Göldern, São Teravo: “été” – naïve"


@pytest.mark.parametrize("wrong", ["cp1252", "latin_1", "cp437", "mac_roman", "cp850"])
def test_utf8_read_wrongly(wrong):
    from sieveline.llm.encoding import _decode

    bad = _decode(SENTENCE.encode(), wrong)
    assert G.is_garbled(bad) and G.restore(bad) == (SENTENCE, True)


def test_read_wrongly_twice_and_in_part():
    from sieveline.llm.encoding import _decode

    twice = _decode(_decode(SENTENCE.encode(), "cp1252").encode(), "cp1252")
    assert G.restore(twice)[0] == SENTENCE
    assert G.restore("Señaza and KraÅ\x88ov, GÃ¶ldern")[0] == "Señaza and Kraňov, Göldern"


@pytest.mark.parametrize("true,wrong,text", [("koi8_r", "cp1251", "Результаты показывают, что влажность почвы зависит"), ("cp1251", "latin_1", "О том, от чего зависит активность ферментов"), ("euc_kr", "latin_1", "통계 모형을 이용한 소르빅 지역"), ("utf-8", "cp1252", "数据说明水质随季节变化")])
def test_other_scripts(true, wrong, text):
    from sieveline.llm.encoding import _decode

    bad = _decode(text.encode(true), wrong)
    assert G.is_garbled(bad) and G.restore(bad)[0] == text


RIGHT = ["Результаты показывают, что качество воды", "Größere Höhenunterschiede in Göldern", "통계 모형을 이용한 지역", "その結果、根の成長は季節によって変わる", "La façade naïve"]


@pytest.mark.parametrize("right", RIGHT)
@pytest.mark.parametrize("true,wrong,text", [("utf-8", "cp1252", "São Teravo façade"), ("koi8_r", "cp1251", "Температура воды зависит от глубины"), ("cp1251", "koi8_r", "Температура воды зависит от глубины"), ("utf-8", "latin_1", "数据说明水质随季节变化"), ("utf-8", "mac_roman", "Łubrany and Señaza")])
def test_text_outside_the_spans_is_untouched(right, true, wrong, text):
    from sieveline.llm.encoding import _decode

    bad = _decode(text.encode(true), wrong)
    for whole, back in ((f"{right} / {bad}", f"{right} / "), (f"{bad} / {right}", f" / {right}")):
        got = G.restore(whole)[0]
        assert got.startswith(back) or got.endswith(back)


def test_every_run_is_examined():
    bad = "数据说明水质随季节变化".encode().decode("gbk", "ignore")
    long = "本研究用几个月的时间研究了土壤湿度的变化情况与水流速度之间的关系进行了比较"
    assert G.evidence(f"{long}。{bad}") and G.evidence(f"{bad}。{long}") and not G.evidence(long)


def test_evidence_is_named():
    assert [G.evidence(t) for t in ("GÃ¶ldern", "Br�ck", "le taux a augment‚ ou d‚jà", "тЕЪХМШФБФЩ", "clean")] == ["sequence", "lost", "image", "flip", None]


def test_single_byte_pair():
    assert G.restore("le taux a augment‚ de la p‚riode, les donn‚es")[0].count("é") >= 2


def test_beyond_repair():
    for bad in ("Br�cksee", "near Kra?ov, (?48 h)"):
        assert G.is_garbled(bad)
    assert G.restore("Br�cksee")[1] is False


@settings(max_examples=150, deadline=None)
@given(st.text("abcdefgh éèüöñçãåßøłńš ,.()-0123456789", min_size=1, max_size=80))
def test_round_trip(text):
    from sieveline.llm.encoding import _decode

    if not G.is_garbled(text) and any(c in "éèüöñçãåßø" for c in text):
        bad = _decode(text.encode(), "cp1252")
        assert G.is_garbled(bad) and G.restore(bad)[0] == text


def test_operator(spark, rows):
    data = [("1", "VÃ©lmar", None, "q"), ("1", "VÃ©lmar", None, "r"), (None, "clean", "Br�", ""), ("3", "", "x" * 50_000 + " Ã©", None)]
    df = spark.createDataFrame(data, "work_id string, title string, abstract string, value string")
    got = rows(garbled_fields(df, "work_id", ["title", "abstract"]), "work_id", "field_name", "complete")
    assert got == [("1", "title", True), ("3", "abstract", True), (None, "abstract", False)]
    assert garbled_fields(df.limit(0), "work_id", ["title"]).count() == 0


def test_runs_without_a_reading_cost_nothing(monkeypatch):
    asked = []
    cost = G._cost
    monkeypatch.setattr(G, "_cost", lambda s: asked.append(s) or cost(s))
    assert G._whole_runs("été, naïve façade") == "été, naïve façade" and asked == []
    assert G._whole_runs("Ã©tÃ©") == "été" and len(asked) == len(set(asked))
