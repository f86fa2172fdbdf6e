import pytest

from sieveline import runtime
from sieveline.functions import rules, text
from sieveline.functions.dialect import matches
from sieveline.operators import audit, flags, near_duplicates, research, units


def test_no_rule_hits_an_empty_title(spark):
    df = spark.createDataFrame([("",), (" ",)], "t string")
    assert all(not any(r) for r in df.select(*[matches("t", p) for p in [rules.V2, *rules.V3.values()]]).collect())


def test_hits_are_those_of_all_members(spark, rows):
    import datetime as dt

    day = dt.datetime(2026, 1, 1)
    bib = spark.createDataFrame([("1", "Editorial", day), ("1", "Rain", day.replace(day=2)), ("2", "News: rain", day), ("3", None, day), ("4", "Reply", day), (None, "Reply", day)], "work_id string, title_display string, loaded_at timestamp")
    mem = spark.createDataFrame([("1", 5), ("2", 6), ("2", 4), ("3", 5), ("4", None), ("9", 5)], "work_id string, effective_nano_id bigint")
    hits = flags.hit_members(mem, bib)
    assert rows(hits, "work_id", "nano_id", "title") == [("2", 4, "News: rain")]
    all_ = flags.title_members(mem, bib)
    assert rows(flags.v3_flags(hits)) == rows(flags.v3_flags(all_)) and rows(audit.scan(hits)) == rows(audit.scan(all_))


def test_calls_recount_and_batches(spark, rows):
    key = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "work_id string, batch int")
    calls = spark.createDataFrame([("a", 1), ("b", 3), ("d", 1)], "work_id string, call_batch int")
    m = research.match_calls(key, calls)
    assert rows(m) == [(1, 1, 2, 1)]
    with pytest.raises(ValueError):
        research.assert_matched(m)
    research.assert_matched(research.match_calls(key.limit(1), calls.limit(1)))
    hits = spark.createDataFrame([("a", ["news", "reply"], "News, rain"), ("b", ["news"], "News—rain"), ("c", [], "x")], "work_id string, types array<string>, title_head string")
    assert rows(research.recount(hits, spark.createDataFrame([("news", 2), ("reply", 2), ("quiz", 1)], "type string, hits bigint"))) == [("quiz", 0, 1), ("reply", 1, 2)]
    assert rows(research.overlapping(hits, ["reply"]), "work_id") == [("a",)]
    from pyspark.sql import functions as F

    assert rows(research.attribution(hits.withColumn("v2_hit", F.lit(False)))) == [("news", 1, 1, 0), ("reply", 1, 0, 0)]
    b = research.batches(hits, 3)
    assert b.count() == 3 and rows(b) == rows(research.batches(hits.repartition(3), 3)) and all(0 <= r["batch"] < 3 for r in b.collect())
    many = spark.range(4000).select(F.col("id").cast("string").alias("id"))
    assert 120 < research.hash_sample(many, "id", 0.05).count() < 280


def test_words_forms_and_totals(spark, rows):
    df = spark.createDataFrame([("1", "In Brief"), ("2", "General meeting"), ("3", None)], "work_id string, title string")
    assert rows(research.forms(df, rules.AUDIT_FORMS)) == [("1", "news", "in_brief"), ("2", "abstracts_meeting", "general_meeting")]
    assert rows(research.forms_per_work(research.forms(df, {**rules.AUDIT_FORMS, ("x", "any"): "(?i)g"}))) == [("1", "in_brief"), ("2", "any,general_meeting")]
    assert df.select(research.content_words(text.norm("title")).alias("w")).collect()[1]["w"] == ["general", "meeting"]
    assert rows(research.expected_totals(spark.createDataFrame([("a", 2)], "reason string, documents bigint"), {"a": 2, "b": 1})) == [("a", 2, 2, True), ("b", 0, 1, False)]
    s = spark.createDataFrame([(1, i, i % 4) for i in range(9)], "nano_id int, cid int, n int")
    assert rows(research.largest(s, 2), "cid") == [(3,), (7,)] and research.largest(s, 0).count() == 9
    assert len(rules.CANDIDATES) == 19 and len(rules.AUDIT_FORMS) == 15 and len(rules.SUBFORMS) == 7 and not rules.CANDIDATES["editors_picks", "editors_picks"][1]


def test_contracts_raise(spark):
    from sieveline.operators import status

    members = spark.createDataFrame([("a", 1), ("b", 1)], "work_id string, nano_id int")
    packs = spark.createDataFrame([(1, 2)], "nano_id int, size bigint")
    status.assert_contract(status.size_contract(packs, members, members.limit(0)))
    with pytest.raises(ValueError):
        status.assert_contract(status.size_contract(packs, members, members.limit(1)))
    hits = spark.createDataFrame([("a", ["news"], False)], "work_id string, types array<string>, v2_hit boolean")
    assert audit.blind_audit(hits, [["news"]], 2).count() == 1
    with pytest.raises(ValueError):
        audit.blind_audit(hits, [["news"]], 2, strict=True)


def test_units(spark, rows):
    packs = spark.createDataFrame([(1, 10, True), (2, 10, False), (3, 4, False), (4, 9, False)], "nano_id bigint, size bigint, junk_candidate boolean")
    ratio = spark.createDataFrame([(1, 60.0), (2, 1.0), (3, 35.0)], "nano_id bigint, pct_mem_jd double")
    mixed = spark.createDataFrame([(1, "g", "high"), (2, "g", "high"), (4, "g", "high")], "nano_id bigint, `group` string, confidence string")
    u = units.base_units(packs, ratio, mixed, 50.0, 30.0)
    assert rows(u, "nano_id", "junk_flag", "in_mixed") == [(1, "dominated", True), (2, "none", True), (3, "review", False), (4, "none", True)]
    members = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 2), ("e", 3), ("f", 9)], "work_id string, nano_id bigint")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "work_id string") if x else spark.createDataFrame([], "work_id string")
    assert rows(units.basis_members(members, u, ids("d"), ids("b", "c"))) == [("a", 1, "junk"), ("c", 2, "mixed"), ("e", 3, "junk")]
    judged = spark.createDataFrame([(1, 5, 3, 0.6, False), (1, 6, 1, 0.4, True), (2, 5, 6, 0.6, False), (2, 7, 3, 0.4, False), (4, 5, 9, 1.0, False)], "nano_id bigint, cid bigint, n bigint, share double, far boolean")
    keys = {r["nano_id"]: r["core_key"] for r in units.core_keys(judged).collect()}
    v = [("DC_1", "single", "h", None, 1, 1, "old"), (f"DC_2_{keys[2]}", "uncertain", "h", None, 2, 1, "new"), ("DC_2_x", "mixed", "h", None, 9, 1, "stale"), ("D_4", "single", "m", None, 1, 1, "m"), ("DC_4", "mixed", "h", "bad", 1, 1, "old")]
    verdicts = spark.createDataFrame(v, "item_id string, verdict string, confidence string, format_error string, priority int, seq int, source string")
    snapshot = spark.createDataFrame([(1, keys[1]), (2, "other")], "nano_id bigint, core_key string")
    residue = spark.createDataFrame([(1, 5)], "nano_id bigint, n_residue bigint")
    unattached = spark.createDataFrame([(1, "z", 6), (1, "y", 5), (2, "x", 9)], "nano_id bigint, work_id string, cid bigint")
    overrides = spark.createDataFrame([("3", "normal", "r", "d", "b", None), ("_1", "x", "r", "d", "b", None), ("2", None, None, None, None, True)], "nano_key string, status string, reason string, date string, by string, rederive_ladder boolean")
    got = {r["nano_id"]: r for r in units.mapping_units(u, residue, judged, unattached, verdicts, snapshot, overrides).collect()}
    assert [(got[k]["status_auto"], got[k]["status"]) for k in (1, 2, 3, 4)] == [("junk_core", "junk_core"), ("mixed_core_review", "mixed_core_review"), ("junk_no_core", "normal"), ("normal", "normal")]
    assert (got[1]["far_docs"], got[1]["un_far_docs"], got[1]["n_unattached_margin"], got[1]["core_share"]) == (2, 1, 2, 0.6) and got[4]["mixed_cleared"]
    assert got[1]["core_rule"] == "prox_v1" and got[2]["core_rule"] is None
    low = {r["nano_id"]: r["status_auto"] for r in units.mapping_units(u, residue, judged, unattached, verdicts, snapshot, overrides, attach_min=2.0).collect()}
    assert low[1] == "junk_no_core" and low[2] == "mixed_no_core"


def test_a_shingle_that_leads_many_texts_is_split(spark, rows, monkeypatch):
    base = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, f"{base} end{i}") for i in range(40)], "id int, text string")
    whole = rows(near_duplicates.pairs(df, "id", "text"))
    monkeypatch.setattr(near_duplicates, "PART", 5)
    assert rows(near_duplicates.pairs(df, "id", "text")) == whole and len(whole) == 40 * 39 // 2


def test_written_folders_can_be_removed(spark, tmp_path):
    df = runtime.written(spark.range(3), "t")
    assert df.count() == 3 and runtime.forget(spark) >= 1 and runtime.forget(spark) == 0
