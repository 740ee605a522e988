"""Near-duplicate vectors by Euclidean p-stable hashing and an exact cosine check.

Vectors are brought to length one, so cosine c is distance sqrt(2 - 2c). A table hashes a vector by ``hashes`` random
projections, each quantised to cells of ``CELL`` with a random shift; vectors that agree in all cells of a
table share its bucket. Every pair of a bucket is checked by cosine in double precision.

The number of hashes grows with the logarithm of the number of vectors, so that a bucket holds about ``CROWD`` unrelated
vectors at any size; the number of tables follows from it, so that a pair at the threshold itself meets in some
table with probability ``recall`` (closer pairs more surely). A copy of a vector per table is what costs, comparing the vectors
of a bucket is cheap, so buckets are crowded and tables few. Nothing else is left out:

* Equal vectors are one class with a count, so copies are never compared with each other.
* A bucket of more than ``TILE`` classes is cut into blocks, and each pair of blocks is a group of its own; no task
  holds more than two blocks, however many vectors share a bucket. Only such buckets are listed: up to ``BROADCAST_BUCKETS``
  are broadcast, so that vectors leave the scan with their block; more are joined by a shuffle.
* A pair that meets in several tables counts in the first of them only. Its earlier keys are worked out again, for pairs
  that link: vectors and projections are rounded to so few bits for hashing that their products are exact in any order, so
  a vector has the same keys wherever they are worked out. Groups return sums per class and star edges, not pairs.

Defined results: a vector that is null, zero, empty or holds a null or a non-finite component links with nothing.
So does a row whose id is null; its component is null and it is not kept. Vectors of different dimension do not link.
Repeated rows are vectors of their own. Other columns (labels) are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import components, materialize

CELL = 2.5
CROWD = 1024
TILE = 2048
BROADCAST_BUCKETS = 1_000_000  # rows of some 30 bytes


def same_cell(distance: float, cell: float = CELL) -> float:
    """Probability that one quantised projection puts two points at ``distance`` into the same cell."""
    t = cell / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan_tables(count: int, threshold: float, recall: float) -> tuple[int, int]:
    """(hashes per table, tables) for ``count`` distinct vectors."""
    near, far = same_cell(math.sqrt(2 - 2 * threshold)), same_cell(math.sqrt(2))
    hashes = max(4, math.ceil(math.log(max(count, 2) / CROWD) / -math.log(far)))
    return hashes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** hashes)))


class Projections:
    """The seeded projections of all tables for vectors of one dimension."""

    def __init__(self, dim: int, hashes: int, tables: int):
        rng = np.random.Generator(np.random.PCG64([dim, hashes, tables]))
        self.matrix = np.round(rng.standard_normal((dim, tables * hashes)) * 2**16) / 2**16
        self.shift = rng.uniform(0, CELL, tables * hashes)
        self.mix = rng.integers(1, 1 << 62, hashes, dtype=np.int64) * 2 + 1
        self.shape = (tables, hashes)

    def keys(self, unit: np.ndarray, tables: int | None = None) -> np.ndarray:
        """One 32-bit bucket key per row and table, of the first ``tables``."""
        tables, hashes = self.shape[0] if tables is None else tables, self.shape[1]
        width = tables * hashes
        rows = np.round(unit * 2**20) / 2**20
        cells = np.floor((rows @ self.matrix[:, :width] + self.shift[:width]) / CELL).astype(np.int64)
        mixed = (cells.reshape(-1, tables, hashes) * self.mix).sum(axis=2)
        mixed ^= mixed >> 31
        return (mixed * np.int64(0x2545F4914F6CDD1D) >> 32).astype(np.int32)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows brought to length one in double precision, without overflow of the squares."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(classes: DataFrame, hashes: int, tables: int, width: str, vectors: bool) -> DataFrame:
    """A row per class and table: dim, tab, key, and with ``vectors`` cls, n, vec."""
    kind = np.float32 if width == "float" else np.float64
    schema = "dim int, tab int, key int" + ", cls long, n long, vec binary" * vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projections = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                x = rows.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
                if dim not in projections:
                    projections[dim] = Projections(dim, hashes, tables)
                for at in range(0, len(x), 256):
                    part = x[at:at + 256]
                    keys = projections[dim].keys(unit_rows(part))
                    columns = [pa.array(np.full(keys.size, dim, dtype=np.int32)),
                               pa.array(np.tile(np.arange(tables, dtype=np.int32), len(part))), pa.array(keys.ravel())]
                    if vectors:
                        columns += [pa.array(np.repeat(rows.column(c).to_numpy()[at:at + 256], tables)) for c in ("cls", "n")]
                        columns.append(pa.array([v.tobytes() for v in part for _ in range(tables)], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=["dim", "tab", "key", "cls", "n", "vec"][:len(columns)])

    return classes.mapInArrow(run, schema)


def group_links(x: np.ndarray, projections: Projections, block: np.ndarray, table: int, threshold: float):
    """Index pairs of one group that link and whether they did not meet in an earlier table. Rows of two blocks are
    compared across the blocks only, rows of one block with each other."""
    unit = unit_rows(x)
    two = block.max() != block.min()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    near = unit[left] @ unit[right].T >= threshold
    if not two:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    met = np.zeros(len(i), dtype=bool)
    if table and len(i):
        some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
        keys = np.concatenate([projections.keys(unit[some[at:at + 256]], table) for at in range(0, len(some), 256)])
        left, right = np.split(place, 2)
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            met[part] = (keys[left[part]] == keys[right[part]]).any(axis=1)
    return i, j, ~met


def _check(tiles: DataFrame, hashes: int, tables: int, threshold: float, width: str) -> DataFrame:
    """Rows (a, b, n): n links of class a counted in a group, or a star edge to class b."""
    kind = np.float32 if width == "float" else np.float64
    group = ["dim", "tab", "key", "low", "high"]
    dealt = tiles.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        projections = {}

        def links(rows: pa.RecordBatch | pa.Table):
            if rows.num_rows < 2:
                return
            get = lambda name: rows.column(name).to_numpy()
            cls, n, block = get("cls"), get("n"), get("block")
            if get("low")[0] != get("high")[0] and block.min() == block.max():
                return
            x = np.frombuffer(b"".join(rows.column("vec").to_pylist()), dtype=kind).reshape(len(cls), -1)
            dim = x.shape[1]
            if dim not in projections:
                projections[dim] = Projections(dim, hashes, tables)
            i, j, new = group_links(x, projections[dim], block, int(get("tab")[0]), threshold)
            if not len(i):
                return
            count = np.zeros(len(cls), dtype=np.int64)
            np.add.at(count, i[new], n[j[new]])
            np.add.at(count, j[new], n[i[new]])
            some = np.flatnonzero(count)
            yield cls[some], None, count[some]
            label = np.arange(len(cls))
            while True:
                before = label.copy()
                np.minimum.at(label, i, label[j])
                np.minimum.at(label, j, label[i])
                label = label[label]
                if (label == before).all():
                    break
            member = np.flatnonzero(label != np.arange(len(cls)))
            yield cls[member], cls[label[member]], None

        def record(found):
            for a, b, n in found:
                empty = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(a), empty if b is None else pa.array(b),
                                                  empty if n is None else pa.array(n)], schema=schema)

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.column_stack([table.column(c).to_numpy() for c in group])
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            starts = [0, *cuts]
            for a, b in zip(starts, cuts):
                if b - a > 1:
                    yield from record(links(table.slice(a, b - a).combine_chunks()))
            rest = table.slice(starts[-1])  # this group may go on in the next batch
        if rest is not None:
            yield from record(links(rest.combine_chunks()))

    return dealt.mapInArrow(run, "a long, b long, n long")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                    recall: float = 0.999, tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``table``."""
    kind = dict(table.dtypes)[vec_col]
    width = "float" if kind == "array<float>" else "double"
    vec = F.col(vec_col).cast(f"array<{width}>")
    usable = (F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
              & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
              & F.exists(vec, lambda v: v != 0))
    rows = table.select(F.col(id_col).cast("long").alias("id"),
                        F.when(F.coalesce(usable, F.lit(False)), vec).alias("vec"))
    classes = (rows.where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
               .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")))
    classes = materialize(classes, "vector_classes")
    hashes, tables = plan_tables(classes.count(), threshold, recall)
    bucket = ["dim", "tab", "key"]
    crowded = (_hashed(classes, hashes, tables, width, False).groupBy(bucket).agg(F.count(F.lit(1)).alias("size"))
               .where(F.col("size") > tile).select(*bucket, F.ceil(F.col("size") / tile).cast("int").alias("blocks")))
    crowded = materialize(crowded, "buckets")
    listed = F.broadcast(crowded) if crowded.count() <= BROADCAST_BUCKETS else crowded.hint("merge")
    placed = (_hashed(classes, hashes, tables, width, True).join(listed, bucket, "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    placed = (placed.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
              .drop("blocks", "other"))
    found = materialize(_check(placed, hashes, tables, threshold, width), "vector_links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null"), "a", "b")
    rooted = (classes.join(counts, "cls", "left").join(roots, classes.cls == roots.node, "left")
              .select("vec", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("root", "cls").alias("root")))
    rooted = materialize(rooted, "vector_roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("vec", "n_links", "component_id")
    out = rows.join(named, "vec", "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
