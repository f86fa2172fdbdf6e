import random
from pathlib import Path

from pyspark.sql import functions as F

from sieveline import runtime
from sieveline.functions import text, text_udf
from sieveline.operators import near_duplicates


def moved(spark) -> int:
    """Bytes shuffled so far and bytes in written folders."""
    shuffled = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(shuffled.apply(i).totalShuffleWrite() for i in range(shuffled.size())) + sum(p.stat().st_size for d in runtime._written for p in Path(d.removeprefix("file:")).rglob("*.parquet"))


def test_shingles_are_not_moved(spark, rows):
    rnd = random.Random(2)
    phrases = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(90)) for _ in range(14)) for _ in range(400)]
    texts = [" ".join(rnd.choice(phrases) for _ in range(9)) for _ in range(2_000)]
    texts += [t + " revised" for t in texts[:20]] + texts[20:40]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    runtime.forget(spark)
    before = moved(spark)
    got = rows(near_duplicates.pairs(df, "id", "text"), "class_a", "class_b")
    assert sorted(got) == [(i, 2_000 + i) for i in range(20)]
    # eight bytes of every shingle would be more than the text
    assert moved(spark) - before < 0.5 * sum(map(len, texts))


def test_shingles_of_batches_are_those_of_the_column(spark):
    texts = ["one two three four five six seven eight nine", "one two three four five six seven eight", "a " * 30, "한국어 텍스트는 열두 글자", "가나다라 마바사아 자차카", "abcdefghijk", "ﬁne_Ünï İs ǅ ① x—y z " * 3, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(F.coalesce(text.shingles(text_udf.nfkc_words("t")), F.array())).alias("n"))
    _, own = near_duplicates._distinct(*near_duplicates._shingles([text_udf.words_of(t) for t in texts]))
    assert [r["n"] for r in df.collect()] == [int((own == i).sum()) for i in range(len(texts))]


def test_few_counters_lose_no_pair(spark, rows, monkeypatch):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(60):
        b = [rnd.choice(words) for _ in range(rnd.choice([9, 30, 120]))]
        texts += [" ".join(b), " ".join([*b, "z"]), " ".join(b[1:])]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = rows(near_duplicates.pairs(df, "id", "text"))
    for name, value in (("LEAST_BITS", 2), ("MOST_BITS", 2), ("SLICE", 2), ("CHARS", 500), ("PART", 3), ("BROADCAST_IDS", 0)):
        monkeypatch.setattr(near_duplicates, name, value)
    assert rows(near_duplicates.pairs(df, "id", "text")) == whole and len(whole) >= 60
