"""Differences between two copies of a dataset (problem 3).

Method: a column-by-bucket checksum matrix. The rows of either copy fall into buckets by a hash of their key. For
every bucket and column the 64-bit hashes of (key, value) are added up, as two sums of 32-bit halves that cannot
overflow below 2**31 rows a bucket. Sums are combined map-side, so what is shuffled is the matrix, not the rows: about
one bucket for ``ROWS_A_BUCKET`` rows. Unequal cells of the two matrices locate the buckets and columns in which the
copies differ. Where most buckets are equal, the others are split by further bits of the hash and added up again, until
they are small or most of them differ; only the rows of those are then joined and compared value by value.

Null equals null and nothing else; the empty string is a value. A null key is a key of its own. Exact duplicate
rows count once: they are added as they are, so copies with other duplicates have unequal buckets, and are settled where
rows are compared. Several different rows of one key are compared as a set: a field differs if the values that the
key's distinct rows have there differ as multisets. Columns of one copy only are ignored. Two empty copies give an
empty result; all rows of the other copy are reported if one is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

LOW = 0xFFFFFFFF


def _h(*cols: Column) -> Column:
    """Hash that tells null from every value."""
    return F.xxhash64(*[x for c in cols for x in (c, c.isNull())])


def _bucket(key: str, buckets: int) -> Column:
    """Number of the key's bucket; of twice as many buckets either half of one is a bucket."""
    return F.pmod(_h(F.col(key)), F.lit(buckets))


def _halves(c: Column) -> tuple[Column, Column]:
    return c.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(c, 32)


def checksum_matrix(df: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """Per bucket: number of rows and, for the key and every column, the two halves of its additive hash."""
    hashed = df.select(_bucket(key, buckets).alias("bucket"), _h(F.col(key)).alias("h_key"), *[_h(F.col(key), F.col(c)).alias(f"h_{c}") for c in columns])
    names = ["h_key", *[f"h_{c}" for c in columns]]
    sums = [F.sum(half).alias(f"{n}_{i}") for n in names for i, half in enumerate(_halves(F.col(n)))]
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *sums)


def unequal_cells(a: DataFrame, b: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """Buckets in which the matrices differ: ``bucket, keys boolean, <column> boolean ...``; at most ``buckets`` rows."""
    ma, mb = (checksum_matrix(x, key, columns, buckets) for x in (a, b))
    x, y = ma.alias("x"), mb.alias("y")
    both = x.join(y, F.col("x.bucket") == F.col("y.bucket"), "full_outer")

    def differs(name: str) -> Column:
        return ~(F.col(f"x.{name}_0").eqNullSafe(F.col(f"y.{name}_0")) & F.col(f"x.{name}_1").eqNullSafe(F.col(f"y.{name}_1")))

    keys = ~F.col("x.n").eqNullSafe(F.col("y.n")) | differs("h_key")
    cells = both.select(F.coalesce("x.bucket", "y.bucket").alias("bucket"), keys.alias("keys"), *[differs(f"h_{c}").alias(f"c_{c}") for c in columns])
    return cells.where(" or ".join(["`keys`", *[f"`c_{c}`" for c in columns]]))


#: Rows that share a bucket of the first matrix, its least and most buckets, and into how many parts a bucket is split.
ROWS_A_BUCKET, LEAST_BUCKETS, MOST_BUCKETS, SPLIT = 64, 1 << 6, 1 << 16, 1 << 6
#: Up to so many buckets of 8 bytes are broadcast.
BROADCAST_BUCKETS = 1 << 20


def _within(df: DataFrame, key: str, cells: DataFrame, buckets: int, found: int) -> DataFrame:
    """The rows of ``df`` in the buckets of ``cells``."""
    hit = cells.select(F.col("bucket").alias("__bucket"))
    return df.join(F.broadcast(hit) if found <= BROADCAST_BUCKETS else hit, _bucket(key, buckets) == F.col("__bucket"), "left_semi")


def diff_copies(a: DataFrame, b: DataFrame, key: str, columns: list[str] | None = None, name_a: str = "a", name_b: str = "b", buckets: int | None = None) -> DataFrame:
    """Rows ``<key>, diff, field_name``: keys of one copy only, and each field whose values differ.

    The unequal cells are cut off with a checkpoint, since they are read twice: as one row that tells how many there are
    and the columns to read, and as the list of buckets.
    """
    columns = columns or [c for c in a.columns if c in set(b.columns) and c != key]
    a, b = a.select(key, *columns), b.select(key, *columns)
    rows = max(a.count(), b.count())
    buckets = buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (rows // ROWS_A_BUCKET).bit_length()))
    x, y, wanted, of = a, b, columns, buckets
    while True:
        cells = cut(unequal_cells(x, y, key, wanted, buckets))
        told = cells.agg(F.count(F.lit(1)).alias("__n"), F.max("keys").alias("keys"), *[F.max(f"c_{c}").alias(c) for c in wanted]).first()
        wanted, found = [c for c in wanted if told[c]], told["__n"]
        x, y = (_within(df.select(key, *wanted), key, cells, buckets, found) for df in (a, b))
        # splitting pays where most buckets were equal and those left are large
        if not found or 2 * found > of or rows // buckets <= ROWS_A_BUCKET:
            break
        buckets, of = buckets * SPLIT, found * SPLIT

    def side(df: DataFrame, is_a: bool) -> DataFrame:
        near = df.select(F.col(key).alias("__key"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(wanted)])
        return near.distinct().withColumn("__a", F.lit(is_a))

    aggs, tests = [F.max("__a").alias("in_a"), F.min("__a").alias("only_a")], []
    for i, _ in enumerate(wanted):
        v = F.col(f"v{i}")
        for s, mine in (("a", F.col("__a")), ("b", ~F.col("__a"))):
            low, high = _halves(F.when(mine, _h(v)))
            # a key's one row is compared by its value, several by their hashes, too; the hash tells null from every value
            aggs += [F.min(F.when(mine, v)).alias(f"{s}{i}_0"), F.sum(low).alias(f"{s}{i}_1"), F.sum(high).alias(f"{s}{i}_2")]
        same = [F.col(f"a{i}_{k}").eqNullSafe(F.col(f"b{i}_{k}")) for k in range(3)]
        tests.append(~(same[0] & same[1] & same[2]))
    per_key = side(x, True).unionByName(side(y, False)).groupBy("__key").agg(*aggs)
    found = F.when(F.col("only_a"), F.array(F.struct(F.lit(f"only_in_{name_a}").alias("diff"), F.lit("").alias("field_name")))).when(
        ~F.col("in_a"), F.array(F.struct(F.lit(f"only_in_{name_b}").alias("diff"), F.lit("").alias("field_name")))
    )
    values = [F.when(t, F.struct(F.lit("value").alias("diff"), F.lit(c).alias("field_name"))) for t, c in zip(tests, wanted)]
    found = found.otherwise(F.array_compact(F.array(*values)) if values else F.array().cast("array<struct<diff:string,field_name:string>>"))
    return per_key.select(F.col("__key").alias(key), F.explode(found).alias("f")).select(key, "f.diff", "f.field_name")
