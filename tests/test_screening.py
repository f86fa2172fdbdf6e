from sieveline.functions import text
from sieveline.operators import audit, exclusion, flags, near_duplicates, ratios, status, strands

BIB = "work_id string, title_display string, abstract_display string, loaded_at timestamp, title string"
MEM = "work_id string, effective_nano_id bigint, nano_id string"


def tables(spark):
    import datetime as dt

    day = dt.datetime(2026, 1, 1)
    bib = spark.createDataFrame(
        [("1", "Editorial", None, day, "x"), ("1", "Editorial", None, day.replace(day=2), "x"), ("2", "News: rain", "a", day, None), ("3", None, "", day, None), ("4", "Correction of bias in radar", None, day, None), ("5", "Reply", None, day, None), ("6", "Commentary: salt", None, day, None), (None, "Reply", None, day, None)],
        BIB,
    )
    mem = spark.createDataFrame([("1", 10, "z"), ("1", 10, "z"), ("2", 10, ""), ("3", 10, None), ("4", 20, None), ("5", 20, None), ("6", 20, None), ("6", 10, None), ("7", 20, None), (None, 20, None), ("8", None, None)], MEM)
    return bib, mem


def test_flags_exclusion_and_ratios(spark, rows):
    bib, mem = tables(spark)
    m = flags.title_members(mem, bib)
    assert [r[0] for r in rows(m, "work_id")] == ["1", "2", "3", "4", "5", "6", "7"]
    v2, v3 = flags.v2_flags(m), flags.v3_flags(m)
    assert [r[0] for r in rows(v2, "work_id")] == ["1", "5"]
    assert rows(v3, "work_id", "junk_types") == [("2", ["news"]), ("5", ["reply"]), ("6", ["commentary"])]
    both = flags.combine_flags(v2, flags.demote(v3, spark.createDataFrame([("5",), ("6",), ("6",)], "work_id string")))
    assert rows(both, "work_id", "flag_source", "flag_only", "junk_types") == [("1", "v2", False, []), ("2", "v3", False, ["news"]), ("5", "v2", False, ["reply"]), ("6", "v3", True, ["commentary"])]
    retracted = m.where("work_id in ('5', '7')")
    x, y = exclusion.exclusion(both, retracted), exclusion.exclusion_by_anti_joins(both, retracted)
    assert rows(x, "work_id", "reason") == [("1", "junk_regex_v2"), ("2", "junk_regex_v3"), ("5", "retracted"), ("7", "retracted")]
    assert exclusion.symmetric_difference(x, y).count() == 0
    r = {q["nano_id"]: q for q in ratios.nano_ratios(m, x, bib.select("work_id")).collect()}
    assert (r[10]["members"], r[10]["jd"], r[10]["core_n"]) == (4, 2, 4) and r[10]["pct_mem_jd"] == 50.0
    assert (r[20]["jd"], r[20]["pct_mem_jd"]) == (0, 0.0)


def test_empty_tables(spark):
    bib, mem = (t.limit(0) for t in tables(spark))
    m = flags.title_members(mem, bib)
    both = flags.combine_flags(flags.v2_flags(m), flags.demote(flags.v3_flags(m), m))
    assert exclusion.exclusion(both, m).count() == 0
    assert ratios.ratio_summary(ratios.nano_ratios(m, exclusion.exclusion(both, m), m)).first()["nanos"] == 0
    assert audit.ordered_sample(audit.scan(m)).count() == 0
    assert near_duplicates.pairs(bib, "work_id", "abstract_display").count() == 0


def test_scalar_functions(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("Analyses of  the Studies & batches, glass",), ("Lithium",), (None,), ("\\alpha\\beta x",)], "t string")
    got = df.select(text.norm("t").alias("n"), text.term_key(text.norm("t")).alias("k"), text.uninformative_title("t").alias("u"), text.tokens_est("t").alias("e")).collect()
    assert got[0]["n"] == "analyses of the studies batches glass" and got[0]["k"] == "analysis of the study batch glass"
    assert [r["u"] for r in got] == [False, True, True, True] and got[2]["e"] == 0
    a = spark.createDataFrame([("<p>Abstract:  Click to increase image size one two</p>",), ("No abstract",), ("x" * 2000,)], "t string")
    got = a.select(text.clean_abstract("t").alias("c"), text.abstract_ok("t").alias("ok"), text.trunc(F.col("t")).alias("s")).collect()
    assert got[0]["c"] == "one two" and not got[1]["ok"] and len(got[2]["s"]) == 1203


def test_language_features_against_plain_counts():
    from sieveline.functions.text_udf import char_class, features

    assert [char_class(c) for c in "aµªβж1 한"] == ["l", "g" if False else char_class("µ"), "l", "g", "o", "x", "x", "o"]
    f = features("the cell and the nucleus are shown " * 20)
    assert f[0] == 0.0 and f[3] > 0.5 and f[4] == 0
    assert features(None) == (0.0, 0, 0, 0.0, 0, 0.0, 0.0)
    assert features("한국어 초록")[0] == 1.0


def test_near_duplicates_against_brute_force(spark, rows):
    import itertools
    import random

    rnd = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    base = [[rnd.choice(words) for _ in range(60)] for _ in range(12)]
    texts = []
    for b in base:
        for cut in (0, 1, 2, 6):
            c = b[:]
            for _ in range(cut):
                c[rnd.randrange(60)] = "z"
            texts.append(" ".join(c))
    texts += [texts[0].upper(), None, "", "short", "한글" * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {(a, b): s for a, b, s in rows(near_duplicates.pairs(df, "id", "text"))}
    def sh(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    want = {}
    for i, j in itertools.combinations(range(48), 2):
        a, b = sh(texts[i]), sh(texts[j])
        s = len(a & b) / len(a | b)
        if s >= 0.85 and texts[i] != texts[j]:
            want[i, j] = round(s, 6)
    assert got == want and want
    assert dict(rows(near_duplicates.classes(df, "id", "text")))[48] == 0


def test_proximity_against_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    data = [(int(i % 3), int(i), int(1 + i % 5), [float(x) for x in rng.normal(size=8)]) for i in range(30)] + [(9, 100, 4, [1.0] * 8), (1, 101, 3, None)]
    s = spark.createDataFrame(data, "nano_id bigint, cid bigint, n bigint, embedding array<float>")
    base = strands.baseline(s)
    mu, sd = base.first()
    v = {c: np.array(np.float32(e), float) / np.linalg.norm(np.array(np.float32(e), float)) for _, c, _, e in data if e}
    cos = np.array([[a @ b for b in v.values()] for a in v.values()])
    assert abs(mu - cos.mean()) < 1e-9 and abs(sd - cos.std()) < 1e-9
    got = {r["cid"]: r["prox"] for r in strands.proximity(s, base).collect()}
    for g in range(3):
        mine = [(c, n) for k, c, n, e in data if k == g and e]
        total = sum(n for _, n in mine)
        for c, _ in mine:
            ref = [(d, n / total) for d, n in mine if n >= 3 and d != c]
            want = sum(w * (v[c] @ v[d] - mu) / sd for d, w in ref) / sum(w for _, w in ref)
            assert abs(got[c] - want) < 1e-9
    assert 100 not in got and 101 not in got


def test_states(spark, rows):
    from pyspark.sql import functions as F

    data = [("a", 2, 0.5, "single", "dominated", False), ("b", 2, 0.5, "mixed", "review", False), ("c", 2, 0.5, None, "none", True), ("d", 0, 0.9, "single", "none", True), ("e", 2, None, None, "none", False), ("f", 2, 0.5, "uncertain", "review", True), ("g", 2, 0.1, "single", "none", True)]
    df = spark.createDataFrame(data, "k string, n int, share double, verdict string, flag string, mixed boolean")
    got = dict(rows(df.select("k", status.decide(*[F.col(c) for c in ("n", "share", "verdict", "flag", "mixed")], F.lit(False)))))
    assert got == {"a": "junk_core", "b": "junk_no_core", "c": "mixed_core_pending", "d": "mixed_no_core", "e": "normal", "f": "junk_core_review", "g": "mixed_no_core"}


def test_keyword_identity_attachment_and_fill(spark, rows):
    import datetime  # noqa: F401

    df = spark.createDataFrame([('{"term":"a","role":"r","variants":["x"]}',), ('{"role":"r","term":"a","variants":["x"]}',), ('{"term":"a","role":"r"}',), ("broken",), (None,), ('{"term":"a"}',)], "j string")
    got = [r["k"] for r in df.select(text.keyword_identity("j").alias("k")).collect()]
    assert got[0] == got[1] and got[0] != got[2] and got[3:] == [None, None, None]
    nanos = spark.createDataFrame([(1, 5, 10), (2, 0, 10), (3, None, 0), (4, 1, 100)], "nano_id int, attached_docs bigint, denom bigint")
    assert rows(strands.attachment(nanos, 0.1), "nano_id", "attach_frac", "attach_frac_low") == [(1, 0.5, False), (2, None, False), (3, None, False), (4, 0.01, True)]
    works = spark.createDataFrame([(n, f"w{i}", i % 3, i if i % 5 else None) for n in (1, 2) for i in range(60)], "nano_id int, work_id string, tier int, cites int")
    got = rows(audit.fill_members(works, 4))
    assert len(got) == 8 and {r[2] for r in got} == {0} and {r[3] for r in got if r[0] == 1} == {57, 54, 51, 48}


def test_verdicts_and_overrides(spark, rows):
    v = [("DC_1", "single", "h", None, "k", 1, 1, "a"), ("DC_1", "mixed", "h", None, "k", 2, 1, "b"), ("DC_2_k", "single", "h", None, "k", 1, 1, "a"), ("DC_3_old", "single", "h", None, "k", 1, 1, "a"), ("DC_4", "single", "h", "bad", "k", 1, 1, "a"), ("D_5", "single", "h", None, "k", 1, 1, "a")]
    df = spark.createDataFrame(v, "item_id string, verdict string, confidence string, format_error string, core_key string, priority int, seq int, source string")
    assert rows(status.resolve_verdicts(df), "nano_id", "verdict") == [(1, "mixed"), (2, "single")]
    s = spark.createDataFrame([(1, "junk_core"), (2, "normal")], "nano_id bigint, status string")
    o = spark.createDataFrame([("1", "normal", "r", "d", "b"), ("_2", "x", "r", "d", "b"), ("text", "x", "r", "d", "b")], "nano_key string, status string, reason string, date string, by string")
    assert rows(status.apply_overrides(s, o), "nano_id", "status_auto", "status", "override_reason") == [(1, "junk_core", "normal", "r (d, b)"), (2, "normal", "normal", None)]
    last = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b")], "k int, seq int, v string")
    assert rows(status.last_verdict(last, "k", "seq", "v")) == [(1, "c")]
