import random

from sieveline.llm import mixing

DOCS = "doc_id bigint, source string, n_tokens bigint, place string"
TARGETS = "mix_name string, source string, target_share double, max_repeats int"


def run(spark, docs, targets):
    d, t = spark.createDataFrame(docs, DOCS), spark.createDataFrame(targets, TARGETS)
    sel = mixing.select_mix(d, t)
    return sel.collect(), {(r["mix_name"], r["source"]): r for r in mixing.reached_shares(sel, t).collect()}


def corpus(seed=1):
    rnd = random.Random(seed)
    return [(i, rnd.choice("aaaaaabbc"), rnd.randint(1, 40), "x") for i in range(3000)] + [(9001, None, 10, ""), (9002, "a", 0, ""), (9003, "a", None, "")]


def test_shares_and_repeats(spark):
    docs = corpus()
    targets = [("m", "a", 0.5, 1), ("m", "b", 0.3, 2), ("m", "c", 0.2, 3), ("m", "gone", 0.1, 1), ("n", "a", 1.0, 1), ("n", "c", 3.0, 2), ("n", "b", 0.0, 5)]
    sel, shares = run(spark, docs, targets)
    by = {i: (s, n) for i, s, n, _ in docs}
    limit = {(m, s): r for m, s, _, r in targets}
    assert len({(r["mix_name"], r["doc_id"]) for r in sel}) == len(sel)
    for r in sel:
        assert by[r["doc_id"]] == (r["source"], r["n_tokens"]) and 1 <= r["repeats"] <= limit[r["mix_name"], r["source"]]
    size = {s: sum(n or 0 for _, t, n, _ in docs if t == s) for s in "abc"}
    for m, wanted in (("m", {"a": 0.5, "b": 0.3, "c": 0.2}), ("n", {"a": 0.25, "c": 0.75})):
        most = min(size[s] * limit[m, s] / w for s, w in wanted.items())
        total = sum(r["n_tokens"] * r["repeats"] for r in sel if r["mix_name"] == m)
        assert abs(total - most) <= 40 * len(wanted)  # within the rounding to whole documents
        for s, w in wanted.items():
            got = sum(r["n_tokens"] * r["repeats"] for r in sel if r["mix_name"] == m and r["source"] == s)
            assert abs(got - w * most) <= 40
            assert abs(shares[m, s]["reached_share"] - w) < 0.005
            reps = {r["repeats"] for r in sel if r["mix_name"] == m and r["source"] == s}
            assert max(reps) - min(reps) <= 1
    assert shares["m", "gone"]["reached_share"] == 0.0 and shares["n", "b"]["docs"] == 0


def test_threshold_against_a_sort(spark):
    """The documents below the bound are the first in order of their place: thresholds of several mixes are nested."""
    docs = corpus(2)
    sel, _ = run(spark, docs, [(f"m{k}", s, w, 1) for k, wa in enumerate((0.2, 0.5, 0.7)) for s, w in (("a", wa), ("b", 1 - wa))])
    sets = {(m, s): {r["doc_id"] for r in sel if (r["mix_name"], r["source"]) == (m, s)} for m in ("m0", "m1", "m2") for s in "ab"}
    for s in "ab":
        chain = sorted((sets[m, s] for m in ("m0", "m1", "m2")), key=len)
        assert chain[0] <= chain[1] <= chain[2]


def test_edges(spark):
    assert run(spark, [], [("m", "a", 1.0, 1)])[0] == []
    assert run(spark, [(1, "a", 5, "")], [])[0] == []
    sel, shares = run(spark, [(1, "a", 5, ""), (2, "b", 7, ""), (1, "a", 5, "")], [("m", "a", float("nan"), 1), ("m", "b", None, 1), ("m", "b", 2.0, None), ("z", "a", -1.0, 1)])
    assert [(r["mix_name"], r["doc_id"], r["repeats"]) for r in sel] == [("m", 2, 1)]
    assert shares["z", "a"]["reached_share"] == 0.0
