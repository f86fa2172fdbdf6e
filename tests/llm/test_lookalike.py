import itertools

import pytest

from sieveline.llm.lookalike import Forms, same_look_pairs, with_form

F_ = Forms()
SAME = [("Kraňov", "Kraňov"), ("a b", "a b"), ("a b", "a　b"), ("a b", "a   b "), ("word", "wo​rd­"), ("ＡＢＣ：１２", "ABC:12"), ("efficient", "eﬃcient"), ("role", "rоlе"), ("TB-29", "ΤΒ-29"), ("part II", "part Ⅱ"), ("Ångström", "Ångström"), ("low-cost", "low‐cost"), ("сор", "cop"), ("é", "е́"), ("µg", "μg"), ("role ԼOՍD", "role LOUD"), ("BACH", "ᏴᎪᏟᎻ")]
OTHER = [("a", "A"), ("e", "é"), ("a–b", "a-b"), ("it's", "it’s"), ("x2", "x²"), ("10", "1O"), ("a.", "a"), ("ж", "x"), ("½", "1/2"), ("α", "a")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    assert F_.canonical(a) == F_.canonical(b)


@pytest.mark.parametrize("a,b", OTHER)
def test_other_look(a, b):
    assert F_.canonical(a) != F_.canonical(b)


def test_the_consistent_script_is_spelled():
    assert F_.canonical("sоil mоisture") == "soil moisture"
    assert F_.canonical("рост кopней") == "рост корней"  # Latin o and p in a Cyrillic word
    assert F_.canonical("Как растёт сор") == F_.canonical("Как растёт cop") == "Как растёт сор"
    assert F_.canonical(None) is None and F_.canonical(" ​") == ""
    for a, _ in SAME:
        assert F_.canonical(F_.canonical(a)) == F_.canonical(a)


@pytest.mark.parametrize("part", [2_000, 2])
def test_pairs_against_brute_force(spark, rows, monkeypatch, part):
    monkeypatch.setattr("sieveline.llm.lookalike.PART", part)
    texts = ["Editorial", "Editоrial", "Editorial", "Ｅｄｉｔｏｒｉａｌ", "News", "News ", "news", None, "", " ", "Göl", "Göl", "Editorial", "x" * 30_000, "x" * 30_000 + "​"]
    data = [("t", f"w{i % 13}", t, "form") for i, t in enumerate(texts)] + [("u", "w0", "Editоrial", ""), ("t", None, "Editоrial", ""), ("t", "w1", "Editоrial", "")]
    df = spark.createDataFrame(data, "field_name string, work_id string, text string, form string")
    want = set()
    for (f, w, t, _), (g, v, s, _) in itertools.permutations(data, 2):
        if f == g and w and v and t and s and w < v and t != s and F_.canonical(t) == F_.canonical(s) != "":
            want.add((f, w, v))
    assert set(rows(same_look_pairs(df))) == want
    assert same_look_pairs(df.limit(0)).count() == 0
    assert with_form(df, "text").count() == len(data)
