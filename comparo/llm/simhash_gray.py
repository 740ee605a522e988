"""SimHash near-duplicates over a hierarchical index in Gray order.

A document's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its word shingles. Distinct
fingerprints are linked when they differ in at most ``max_bits`` bits:

* The upper nodes of the index are masked bit patterns (a mask and the bits under it). With ``max_bits`` + 1
  disjoint masks, two fingerprints that link agree under one mask at least, so each fingerprint is dealt to one
  node per mask and nodes are searched on their own. A node with more than ``leaf`` members is replaced by
  its children, whose masks add one of ``max_bits`` + 1 parts of the bits still free; the same argument holds
  again, so no link is lost and no task gets more than ``leaf`` fingerprints of a node.
* Within a node the fingerprints are sorted by Gray rank, so neighbours share bits. Runs of eight are
  factored into parents that hold the bits common to all members, and so on up. The search walks pairs of
  parents downwards and drops a pair of groups as soon as the common bits differ in more than ``max_bits``
  places.
* A node returns star edges to the smallest member of each of its groups, not all pairs; the components of those edges
  are the components of the links.

Null text counts as empty; a text without words has fingerprint zero and links like any other. Repeated rows
each get a result. A null id takes part; component_id is the smallest id that is not null. Columns other than the id
and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import components, free, map_rows, materialize

LEAF = 2048
FANOUT = 8


def shingles(text: str | None, size: int) -> list[bytes]:
    """Word shingles of the A-Z lower-cased text; the whole sequence if it is shorter, none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return []
    if len(words) < size:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint(text: str | None, size: int = 3) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half the shingle hashes."""
    import xxhash
    grams = shingles(text, size)
    if not grams:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), dtype="<u8", count=len(grams))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp) for every row of ``docs``, fp as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def make():
        def run(cols):
            fps = np.array([fingerprint(t, size) for t in cols["text"]], dtype=np.uint64)
            return {"id": cols["id"], "fp": fps.view(np.int64)}
        return run

    return map_rows(rows, "id long, fp long", make)


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each fingerprint (uint64) in the Gray sequence."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def linked_pairs(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of ``fps``, sorted by Gray rank, that differ in at most ``max_bits`` bits."""
    ones, zeros = [fps], [~fps]  # per level: bits set in all members, bits clear in all members
    while len(ones[-1]) > FANOUT:
        starts = np.arange(0, len(ones[-1]), FANOUT)
        ones.append(np.bitwise_and.reduceat(ones[-1], starts))
        zeros.append(np.bitwise_and.reduceat(zeros[-1], starts))
    top = len(ones[-1])
    i, j = np.triu_indices(top)
    for level in range(len(ones) - 1, -1, -1):
        one, zero = ones[level], zeros[level]
        differ = np.bitwise_count((one[i] & zero[j]) | (zero[i] & one[j]))
        near = differ <= max_bits
        i, j = i[near], j[near]
        if level:
            below, child = len(ones[level - 1]), np.arange(FANOUT)
            i = (i[:, None] * FANOUT + np.repeat(child, FANOUT)).ravel()
            j = (j[:, None] * FANOUT + np.tile(child, FANOUT)).ravel()
            inside = (i < below) & (j < below) & (i <= j)
            i, j = i[inside], j[inside]
    apart = i < j
    return i[apart], j[apart]


def node_stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked member of one node to the first member (in Gray order) of its group."""
    fps = fps[np.argsort(gray_rank(fps))]
    i, j = linked_pairs(fps, max_bits)
    label = np.arange(len(fps))
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(fps)))
    return fps[member], fps[label[member]]


def child_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` runs of its free bits added, for each run (the free bits dealt evenly)."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    runs = [free[k * len(free) // parts:(k + 1) * len(free) // parts] for k in range(parts)]
    return sorted({mask | sum(1 << b for b in run) for run in runs if run})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(fps: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Rows (fp, mask, key) for each child of the row's mask."""
    spark = fps.sparkSession
    table = spark.createDataFrame([(_signed(m), _signed(c)) for m, cs in masks.items() for c in cs],
                                  "mask long, child long")
    # fixed table: (max_bits + 1) ** level rows, whatever the data
    return (fps.join(F.broadcast(table), "mask").select("fp", F.col("child").alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))


def _search(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Star edges (a, b) of every node; ``nodes`` has at most LEAF rows per (mask, key)."""
    dealt = nodes.repartition("mask", "key").sortWithinPartitions("mask", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        rest = np.empty((0, 3), dtype=np.int64)

        def edges(rows: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            found = [node_stars(np.ascontiguousarray(g[:, 2]).view(np.uint64), max_bits)
                     for g in np.split(rows, cuts) if len(g) > 1]
            a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.uint64)
            b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for batch in batches:
            rows = np.column_stack([batch.column(n).to_numpy() for n in ("mask", "key", "fp")])
            rows = np.concatenate([rest, rows])
            if not len(rows):
                continue
            last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0  # the last node may go on in the next batch
            rest = rows[cut:]
            if cut:
                yield edges(rows[:cut])
        if len(rest):
            yield edges(rest)

    return dealt.select("mask", "key", "fp").mapInArrow(run, "a long, b long")


def hamming_links(fps: DataFrame, max_bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """Star edges (a, b) whose components are those of "differs in at most ``max_bits`` bits" on the distinct
    fingerprints ``fps`` (column fp)."""
    masks = {0: child_masks(0, max_bits + 1)}
    rows = _deal(fps.withColumn("mask", F.lit(0).cast("long")), masks)
    links = None
    while True:
        rows = materialize(rows, "gray_nodes")
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
        split = {m: child_masks(m, max_bits + 1) for cs in masks.values() for m in cs}
        split = {m: cs for m, cs in split.items() if m != (1 << 64) - 1}
        sized = rows.join(sizes.where("n > 1"), ["mask", "key"])
        found = _search(sized.where(F.col("n") <= leaf), max_bits)
        links = found if links is None else links.unionByName(found)
        if sizes.where(F.col("n") > leaf).isEmpty():
            return links
        rows, masks = _deal(sized.where(F.col("n") > leaf).select("fp", "mask"), split), split


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``."""
    rows = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "fp_classes")
    linked = components(hamming_links(classes.select("fp"), max_bits), "a", "b")
    rooted = (classes.join(linked, classes.fp == linked.node, "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    rooted = materialize(rooted, "fp_roots")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
             max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, the one of smallest id (a null id counts as the largest,
    any of equal ids), with its own columns.

    The rows get numbers and are written out, so that rows with equal ids can be told apart."""
    row = free(docs, "__simhash_row")
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows, row, text_col, size, max_bits)
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "id"))
    first = (groups.join(rows.select(F.col(row).alias("id"), F.col(id_col).cast("long").alias("key")), "id")
             .groupBy("component_id").agg(least.alias("first")))
    return rows.join(first.select(F.col("first.id").alias(row)), row, "left_semi").select(*docs.columns)
