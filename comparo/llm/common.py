"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from comparo import session
from comparo.sources.tables import read_table

__all__ = ["Recent", "append_columns", "components", "documents", "drop", "first_by_hash", "free", "job_conf", "labelled", "map_rows", "materialize", "remainder", "slices"]


class Recent(dict):
    """A table of ``make(key)`` for the keys asked for. When ``size`` keys are in it they become the old generation,
    which keeps those asked for again, and the older one goes."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


HUB = 64  # places that the edges of one node are dealt to
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def job_conf(spark: SparkSession, conf: dict[str, str] | None = None):
    """Settings that hold inside; the shuffle files of a job that ends inside go with it."""
    wanted = {CLEANUP: "true"} | (conf or {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, name: str, conf: dict[str, str] | None = None, **options) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffle files of the job go when it has ended. ``conf`` holds
    for this job alone, ``options`` go to the writer."""
    with job_conf(df.sparkSession, conf):
        return session.materialize(df, name, **options)


def drop(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` has written, when nothing reads them any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def free(df: DataFrame, prefix: str) -> str:
    """``prefix``, with more underscores before it if a column of ``df`` begins with it."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, training, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, y, text) of the documents with a label for which ``training`` holds. Texts of other documents are
    not moved."""
    marks = (labels.where(F.col(label).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.max(F.col(label).cast("int")).alias("y")))
    rows = docs.where(training).select(F.col(id_col).cast("long").alias("id"),
                                       F.col(text_col).cast("string").alias("text"))
    # labels grow with the documents, so neither side is broadcast at any size
    return rows.join(marks.hint("merge"), "id").select("id", "y", "text")


def first_by_hash(rows: DataFrame, sample: int) -> DataFrame:
    """One row of each equal (id, text), those that come first in the order of a hash of both, ``sample`` of them (all if
    there are no more). Only hashes are ordered; rows beyond the sample stay where they are."""
    order = F.xxhash64("id", "text")
    last = rows.select(order.alias("h")).distinct().orderBy("h").limit(sample).agg(F.count("h"), F.max("h")).first()
    return (rows if last[0] < sample else rows.where(order <= last[1])).dropDuplicates(["id", "text"])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Parts of ``rows`` rows, so that a worker holds Python objects of few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, list]], dict[str, Iterable]]],
             ) -> DataFrame:
    """Arrow map over the partitions: ``make()`` runs once per task and returns a function from the columns of
    one batch (lists) to the output columns, which may have more or fewer rows."""
    target = to_arrow_schema(StructType.fromDDL(schema))
    names = target.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in slices(batches):
            out = fn({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=target.field(n).type) for n in names],
                                             schema=target)

    return df.mapInArrow(run, schema)


def append_columns(df: DataFrame, inputs: dict[str, str], schema: str,
                   make: Callable[[], Callable[[dict[str, list]], dict[str, Iterable]]]) -> DataFrame:
    """``df`` with the columns of ``schema`` added, one value per row, as ``make()`` works them out from the columns
    named in ``inputs`` (its name for each -> column of ``df``). All columns of ``df`` pass through as they are."""
    added = StructType.fromDDL(schema)
    target = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in slices(batches):
            out = fn({k: batch.column(batch.schema.get_field_index(c)).to_pylist() for k, c in inputs.items()})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(out[n], type=target.field(n).type) for n in target.names)],
                names=[*batch.schema.names, *target.names])

    return df.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))


def _edges(df: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges (u > v), written out, with their number and an order-free checksum."""
    e = (df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialize(e, "edges")
    state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return e, tuple(state)


def _meet_lowest(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with m, the smallest v of each u. Minima are taken in two steps and joined back by u and a hash of v, so
    the edges of a hub are dealt to ``HUB`` places."""
    salted = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(HUB)).cast("int"))
    parts = salted.groupBy("u", "s").agg(F.min("v").alias("m"))
    low = parts.groupBy("u").agg(F.min("m").alias("m"))
    return salted.join(parts.select("u", "s").join(low, "u"), ["u", "s"]).select("u", "v", "m")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of links (a, b) of longs by alternating large-star and small-star rounds.

    Returns (node, root), root being the smallest node reachable, for the nodes that have a link. Every round
    is written to the shared folder; a node's neighbours are only reduced to their minimum and met by it again, dealt by
    node and a hash of the neighbour, so a hub is never gathered in one task. Only a count and a checksum come to the
    driver.
    """
    edges, state = _edges(links.select(F.col(a).alias("u"), F.col(b).alias("v")))
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _meet_lowest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        star = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        met = _meet_lowest(star)
        small = (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(star.groupBy("u").agg(F.min("v").alias("v"))))
        edges, after = _edges(small)
        if after == state:
            break
        state = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
