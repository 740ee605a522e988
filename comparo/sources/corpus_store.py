"""Corpus storage: scan, count, flat export, JSON backup and restore.

Writes never replace data in place. Each write goes to a fresh path under the
target folder and the new path is returned, so a failed write or restore
leaves the previous corpus readable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, IntegerType, StringType, StructField,
                               StructType)

METADATA_FIELDS = ["domain", "tld", "length", "price", "platform", "date", "primary_category",
                   "secondary_category", "desc_index", "has_numbers"]

METADATA_TYPE = StructType([
    StructField("domain", StringType()), StructField("tld", StringType()), StructField("length", IntegerType()),
    StructField("price", DoubleType()), StructField("platform", StringType()), StructField("date", StringType()),
    StructField("primary_category", StringType()), StructField("secondary_category", StringType()),
    StructField("desc_index", IntegerType()), StructField("has_numbers", BooleanType())])

PACKED_ROWS = 50_000    # records in a compressed file of a backup, which one task reads
MANIFEST = "_manifest"  # readers of the records pass over names that begin with an underscore

# One backup record: {id, content, metadata, embedding}.
BACKUP_SCHEMA = StructType([
    StructField("id", StringType()), StructField("content", StringType()), StructField("metadata", METADATA_TYPE),
    StructField("embedding", ArrayType(FloatType()))])


def scan_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The stored corpus; later selects and filters are pruned and pushed into the scan."""
    return spark.read.parquet(path)


def corpus_count(corpus: DataFrame) -> DataFrame:
    """One row with the number of documents and an empty flag."""
    return corpus.agg(F.count(F.lit(1)).alias("n_documents")).withColumn(
        "is_empty", F.col("n_documents") == 0)


def to_records(corpus: DataFrame) -> DataFrame:
    """Curated columns -> {id, content, metadata, embedding} records."""
    meta = F.struct(*[(F.col("sale_date") if f == "date" else F.col(f)).cast(METADATA_TYPE[f].dataType).alias(f)
                      for f in METADATA_FIELDS])
    return corpus.select("id", F.col("document").alias("content"), meta.alias("metadata"),
                         F.col("embedding").cast("array<float>").alias("embedding"))


def from_records(records: DataFrame) -> DataFrame:
    """{id, content, metadata, embedding} records -> curated columns."""
    cols = [F.col(f"metadata.{f}").alias("sale_date" if f == "date" else f) for f in METADATA_FIELDS]
    return records.select("id", F.col("content").alias("document"), *cols, "embedding")


def export_flat(corpus: DataFrame, path: str) -> str:
    """Parquet with the metadata flattened to columns: id, document, metadata..., embedding."""
    recs = to_records(corpus)
    recs.select("id", F.col("content").alias("document"), "metadata.*", "embedding") \
        .write.mode("errorifexists").parquet(path)
    return path


def backup_name(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return "backup_" + now.strftime("%Y%m%d_%H%M%S")


def _fingerprint(spark: SparkSession, path: str) -> tuple[int, str]:
    """(number, order-free checksum) of the lines of a backup."""
    total = F.coalesce(F.sum(F.xxhash64("value").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    n, checksum = spark.read.text(path).agg(F.count(F.lit(1)), total).first()
    return n, str(checksum)


def backup_json(corpus: DataFrame, folder: str, now: _dt.datetime | None = None, compression: str | None = None) -> str:
    """JSON Lines records under ``{folder}/backup_%Y%m%d_%H%M%S``; returns that path. A manifest beside them has the number
    of lines and their checksum, read back from what was written. ``compression`` ("gzip") packs the files, ``PACKED_ROWS``
    records at most in each; they are read and restored like plain ones."""
    path = f"{folder.rstrip('/')}/{backup_name(now)}"
    options = {"compression": compression, "maxRecordsPerFile": PACKED_ROWS} if compression else {}
    to_records(corpus).write.mode("errorifexists").options(**options).json(path)
    spark = corpus.sparkSession
    manifest = spark.createDataFrame([_fingerprint(spark, path)], "n_lines long, checksum string")
    manifest.coalesce(1).write.json(f"{path}/{MANIFEST}")
    return path


def latest_backup(spark: SparkSession, folder: str) -> str:
    """The backup with the greatest name (names sort by time)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(st.getPath().getName() for st in fs.listStatus(hpath)
                   if st.getPath().getName().startswith("backup_"))
    if not names:
        raise FileNotFoundError(f"no backup under {folder}")
    return f"{folder.rstrip('/')}/{names[-1]}"


def read_backup(spark: SparkSession, path: str) -> DataFrame:
    """Backup records with a fixed schema (no inference). A malformed line raises when it is read."""
    return spark.read.schema(BACKUP_SCHEMA).option("mode", "FAILFAST").json(path)


def verify_backup(spark: SparkSession, path: str) -> bool:
    """Raise if the lines of a backup are not those that its manifest counts. False if it has no manifest."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    if not hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath):
        return False
    written = tuple(spark.read.schema("n_lines long, checksum string").json(f"{path.rstrip('/')}/{MANIFEST}").first())
    found = _fingerprint(spark, path)
    if written != found:
        raise ValueError(f"backup {path} has {found[0]} lines (checksum {found[1]}), its manifest {written[0]} ({written[1]})")
    return True


def restore(spark: SparkSession, backup_path: str, target_folder: str) -> str:
    """S9 (+ S12): the restored corpus is written to a new path under ``target_folder``; ids are kept.

    The backup is verified first: one that lost or changed lines raises and nothing is written. Lines that are no
    record, or have no id, are left out and kept as text in a ``quarantine_`` folder beside the restored corpus."""
    verify_backup(spark, backup_path)
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    path = f"{target_folder.rstrip('/')}/restored_{stamp}"
    broken = StructType([*BACKUP_SCHEMA.fields, StructField("broken_line", StringType())])
    parsed = F.from_json("value", broken, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_line"})
    lines = spark.read.text(backup_path).where(F.trim("value") != "").withColumn("record", parsed)
    good = F.col("record.broken_line").isNull() & F.col("record.id").isNotNull()
    good_rows = from_records(lines.where(good).select("record.*").drop("broken_line"))
    good_rows.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    bad = lines.where(~good).select("value")
    if not bad.isEmpty():
        bad.write.mode("errorifexists").text(f"{target_folder.rstrip('/')}/quarantine_{stamp}")
    return path


LAYOUT = "corpus_family"  # folder column of the stored corpus: the TLD family, "other" for unknown TLDs
SPREAD = 16               # a family's rows are written by up to this many tasks


def laid_out(corpus: DataFrame) -> DataFrame:
    """``corpus`` with its folder column, dealt so that each folder gets a few files, however many tasks wrote before:
    a hot family is spread by a hash of the id."""
    from comparo.operators.suffix import tld_family

    rows = corpus.withColumn(LAYOUT, tld_family(F.col("tld")))
    return rows.repartition(LAYOUT, F.pmod(F.xxhash64("id"), F.lit(SPREAD)))


def append_corpus(corpus: DataFrame, path: str) -> str:
    """Add rows to the corpus table at ``path`` (made if there is none), one folder per TLD family. The build and the
    stream both write by this layout; the neighbour search reads only the families that its inputs ask for."""
    laid_out(corpus).write.mode("append").option("compression", "zstd").partitionBy(LAYOUT).parquet(path)
    return path


def write_corpus(corpus: DataFrame, folder: str) -> str:
    """Write the curated corpus to a new path under ``folder``; returns the path."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    return append_corpus(corpus, f"{folder.rstrip('/')}/corpus_{stamp}")
