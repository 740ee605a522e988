"""A corpus table keyed by id, for changes that touch few rows.

Rows lie in folders by a hash of their id: ``buckets=256/id_bucket=17``. The number of buckets is part of the path, so a
reader and a writer always agree on it. Every write replaces whole buckets and only those that hold a changed id, by
Spark's dynamic partition overwrite; files of other buckets stay as they are. Within a file rows are sorted by id and carry a
Bloom filter on it, so that lookups skip row groups as well.

Stored rows are moved once by a change: they are dealt to tasks by bucket, meet the change there and are written from there. The
overwrite writes all new files beside the table first, then moves them in. Each bucket is replaced as a whole; a run that
dies in between leaves every bucket either old or new, and running it again gives the same table, since all
changes are idempotent. One change at a time may run on a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comparo.operators.corpus_ops import backfill_metadata, upsert
from comparo.session import materialize, settings

BUCKET_ROWS = 200_000    # rows of a bucket, about
MOST_BUCKETS = 1 << 16
NUMBER, BUCKET = "buckets", "id_bucket"
FILES = {"parquet.bloom.filter.enabled#id": "true", "compression": "zstd"}
BY_BUCKET = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}  # sides dealt by bucket are joined on bucket and id as they lie


def bucket_of(id_col: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def bucket_count(rows: int) -> int:
    return max(1, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with their bucket, all of a bucket in one task. A join of two such tables on bucket and id moves
    neither again (with ``BY_BUCKET``)."""
    return rows.withColumn(BUCKET, bucket_of(F.col("id"), buckets)).repartition(BUCKET)


def _write(dealt: DataFrame, path: str, buckets: int, mode: str) -> None:
    (dealt.withColumn(NUMBER, F.lit(buckets)).sortWithinPartitions(BUCKET, "id").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").options(**FILES).partitionBy(NUMBER, BUCKET).parquet(path))


def create(corpus: DataFrame, path: str, buckets: int | None = None) -> str:
    """Write ``corpus`` (column id, no null ids) as a new keyed table; by default the number of buckets follows from its rows."""
    buckets = buckets or bucket_count(corpus.count())
    _write(_dealt(corpus, buckets), path, buckets, "errorifexists")
    return path


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    table = spark.read.parquet(path)
    first = table.select(NUMBER).first()
    if first is None:
        raise ValueError(f"no keyed table with rows at {path}")
    return table, first[0]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a keyed table without its folder columns."""
    return spark.read.parquet(path).drop(NUMBER, BUCKET)


def rows_near(spark: SparkSession, path: str, ids: DataFrame) -> tuple[DataFrame, list[int], int]:
    """(stored rows of the buckets that ``ids`` (column id) fall in, these buckets, the number of all buckets). The list has at
    most one number for each bucket; other buckets' files are not opened."""
    table, buckets = _stored(spark, path)
    hit = sorted(r[0] for r in ids.select(bucket_of(F.col("id"), buckets)).distinct().collect() if r[0] is not None)
    return table.where(F.col(BUCKET).isin(hit)).drop(NUMBER, BUCKET), hit, buckets


def missing(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The ``rows`` whose id is not stored. Only the ids of hit buckets are read. The ids that are missing are found on ids
    alone and written out, so that the planner knows how many they are: rows with their texts move for many of them only."""
    near, _, _ = rows_near(spark, path, rows)
    ids = materialize(rows.select("id").distinct().join(near.select("id"), "id", "left_anti"), "missing_ids")
    return rows.join(ids.withColumnRenamed("id", "__id"), F.col("id").eqNullSafe(F.col("__id")), "left_semi")


def upsert_rows(spark: SparkSession, path: str, new: DataFrame) -> list[int]:
    """S10 in place: ``new`` rows replace stored rows of the same id, others are added. Returns the buckets rewritten.
    Columns that ``new`` lacks are NULL in its rows."""
    new = materialize(new, "upsert_new", compression="zstd")
    near, hit, buckets = rows_near(spark, path, new)
    if hit:
        merged = upsert(_dealt(near, buckets), _dealt(new, buckets), [BUCKET, "id"])
        with settings(spark, BY_BUCKET):
            _write(merged.select(*near.columns, BUCKET), path, buckets, "overwrite")
    return hit


def update_rows(spark: SparkSession, path: str, changes: DataFrame) -> list[int]:
    """S13 in place: the columns of ``changes`` (id, unique, and some columns of the table) replace those of the stored rows.
    Ids that are not stored are ignored. Returns the buckets rewritten."""
    table = spark.read.parquet(path)
    columns = [c for c in changes.columns if c != "id"]
    unknown = set(columns) - set(table.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    changes = materialize(changes.select("id", F.struct(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in columns])
                                         .alias("changed")), "changes")
    near, _, _ = rows_near(spark, path, changes)
    known = materialize(changes.join(near.select("id"), "id", "left_semi"), "known_changes")
    near, hit, buckets = rows_near(spark, path, known)
    if hit:
        found = F.col("changed").isNotNull()
        merged = _dealt(near, buckets).join(_dealt(known, buckets), [BUCKET, "id"], "left").select(*[
            F.when(found, F.col(f"changed.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in near.columns], BUCKET)
        with settings(spark, BY_BUCKET):
            _write(merged, path, buckets, "overwrite")
    return hit


def backfill_rows(spark: SparkSession, path: str, strict: bool = True) -> list[int]:
    """P19 in place: rows without metadata get it; buckets without such rows stay as they are. What a row lacks follows from the
    row itself, so rows of unique ids are filled as they are read and written from there, without a shuffle."""
    filled = backfill_metadata(read(spark, path), strict).where("backfilled").select("id", "length", "tld", "has_numbers")
    if not filled.where("id IS NOT NULL").groupBy("id").count().where("count > 1").isEmpty():
        return update_rows(spark, path, filled)
    known = F.col("id").isNotNull()  # rows without an id are left as they are
    near, hit, buckets = rows_near(spark, path, filled.where(known))
    if hit:
        columns = ["length", "tld", "has_numbers"]
        stored = near.select("*", *[F.col(c).alias(f"__was_{c}") for c in columns])
        rows = backfill_metadata(stored, strict).select(*[
            F.when(known, F.col(c)).otherwise(F.col(f"__was_{c}")).cast(near.schema[c].dataType).alias(c) if c in columns
            else F.col(c) for c in near.columns], bucket_of(F.col("id"), buckets).alias(BUCKET))
        _write(rows, path, buckets, "overwrite")
    return hit
