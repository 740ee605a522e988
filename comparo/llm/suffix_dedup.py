"""Removal of repeated byte windows by a depth-limited radix order of suffixes.

Every suffix of every text is ordered only through its first ``width`` bytes, by most-significant-digit passes;
suffixes that are still equal after the last digit start the same window, so the groups left at full depth are
exactly the repeated windows, and every member but the earliest is removed. The digits are taken where they
carry most:

* First digit: the window's anchor, the ``gram``-byte string in it with the least hash (leftmost of equals). It
  depends on the window's bytes alone, so equal windows always meet. Neighbouring windows share their anchor,
  and such a run of windows goes through the passes as one row: one row for some thirty bytes of text.
* Second digit: all bytes of the run. Runs with equal bytes repeat window by window; all but the earliest are removed
  whole. A bucket of the first digit with a single class of runs is finished, as in any MSD pass.
* Third digit: the earliest runs of buckets that hold several classes (a change or the edge of a passage falls into
  them) are cut into parts of ``PART`` windows by their distance from the anchor, and the same two steps are taken
  with the bytes that all windows of a part share, and all bytes of the part.
* Last digit: what is still open is spelt out window by window and grouped by the full ``width`` bytes.

Equality of runs is that of two 64-bit hashes, of windows that of a 128-bit hash. Every task first keeps the earliest of
equal rows in its batch, so a passage in a third of all documents sends one row per batch and class into the
shuffle. Per document only its own spans are gathered.

Defined results: a null text is empty; texts shorter than ``width`` keep all bytes. The order of documents is
that of the ids, a null id first. Rows with equal ids and different texts are documents of their own, ordered by a hash
of the text; rows equal in both count as one document and each returns its result. Columns other than the id and the
text are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comparo.llm.common import append_columns, free, materialize

WIDTH = 100
GRAM = 32
BLOCK = 1 << 20    # windows handled at once; long texts are cut into such blocks, which overlap by a window
PLACE = np.uint64((1 << 24) - 1)
NO_ID = -(1 << 63)  # stands for a null id inside the operator
PART = 8           # windows that go through the third digit as one row
ROWS = "h long, span long, id long, tag long, lo int, hi int, at int, done boolean"


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers of an odd base and of its inverse modulo 2**64, for rolling hashes."""
    base = 0x9E3779B97F4A7C15
    step = np.full(BLOCK + 4096, base, dtype=np.uint64)
    step[0] = 1
    back = np.full(BLOCK + 4096, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    values = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
    return values, np.multiply.accumulate(step), np.multiply.accumulate(back)


def gram_hashes(data: np.ndarray, gram: int, constants) -> np.ndarray:
    """64-bit hash of each ``gram`` consecutive bytes."""
    values, power, inverse = constants
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[:len(data)], out=total[1:])
    g = (total[gram:] - total[:-gram]) * inverse[:len(data) - gram + 1]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(29)
    return g


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def runs(data: bytes, width: int, gram: int, constants) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, first window, last window, anchor) of the runs of windows that share an anchor."""
    whole = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(whole) - width + 1, BLOCK):
        part = whole[at:at + BLOCK + width - 1]
        g = gram_hashes(part, gram, constants)
        keyed = (g & ~PLACE) | np.arange(len(g), dtype=np.uint64)
        place = (sliding_min(keyed, width - gram + 1) & PLACE).astype(np.int64)
        cut = np.flatnonzero(place[1:] != place[:-1]) + 1
        lo = np.concatenate([[0], cut])
        hi = np.concatenate([cut - 1, [len(place) - 1]])
        yield g[place[lo]], lo + at, hi + at, place[lo] + at


def _emit(h, span, lo, hi, at, doc, ids, tags, width) -> pa.RecordBatch:
    """Rows of one batch: the earliest of equal (h, span) as they are; the spans of the others as done, joined
    where they touch. ``doc`` indexes ids and tags, which are in order of (id, tag)."""
    order = np.argsort(h ^ (span << np.uint64(1)), kind="stable")
    later = np.zeros(len(h), dtype=bool)
    a, b = order[:-1], order[1:]
    later[b] = (h[a] == h[b]) & (span[a] == span[b])
    first = ~later
    out = [(h[first], span[first], doc[first], lo[first], hi[first], at[first], np.zeros(first.sum(), dtype=bool))]
    if later.any():
        d, l, r = doc[later], lo[later], hi[later]
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (l[1:] > r[:-1] + width)
        start = np.flatnonzero(new)
        stop = np.concatenate([start[1:], [len(d)]]) - 1
        d, l, r = d[start], l[start], r[stop]
        spread = (d.astype(np.uint64) << np.uint64(32) | l.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((spread ^ ids[d].view(np.uint64), spread, d, l, r, l, np.ones(len(d), dtype=bool)))
    h, span, d, lo, hi, at, done = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(span.view(np.int64)), pa.array(ids[d]), pa.array(tags[d]),
         *(pa.array(x.astype(np.int32)) for x in (lo, hi, at)), pa.array(done)],
        names=["h", "span", "id", "tag", "lo", "hi", "at", "done"])


def _ordered(batch: pa.RecordBatch):
    """Distinct documents of a batch in order: ids, tags, and the row of each."""
    ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
    order = np.lexsort((tags, ids))
    if len(order):
        ids, tags = ids[order], tags[order]
        keep = np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
        ids, tags, order = ids[keep], tags[keep], order[keep]
    return ids, tags, order


def _run_rows(data: bytes, spans, width: int, gram: int, constants):
    """h, span, lo, hi, at of a text's runs."""
    from xxhash import xxh3_64_intdigest as digest
    if len(data) < width:
        return None
    h, lo, hi, at = (np.concatenate(x) for x in zip(*runs(data, width, gram, constants)))
    span = [digest(data[a:b]) for a, b in zip(lo.tolist(), (hi + width).tolist())]
    return h, np.array(span, dtype=np.uint64), lo, hi, at


def _part_rows(data: bytes, spans, width: int, gram: int, constants):
    """The same of the parts of the runs in ``spans``: part k has the windows that start 8k to 8k+7 bytes before the
    anchor."""
    from xxhash import xxh3_64_intdigest as digest
    rows = []
    for s in spans:
        lo, hi, at = s["lo"], s["hi"], s["at"]
        for k in range((at - hi) // PART, (at - lo) // PART + 1):
            core, first, last = at - PART * k, max(lo, at - PART * k - PART + 1), min(hi, at - PART * k)
            rows.append((first, last, at, digest(data[core:core + width - PART + 1]), digest(data[first:last + width])))
    *places, h, span = zip(*sorted(rows))
    return np.array(h, dtype=np.uint64), np.array(span, dtype=np.uint64), *map(np.array, places)


def _window_rows(data: bytes, spans, width: int, gram: int, constants):
    """The same of the single windows in ``spans``; h and span are the halves of a 128-bit hash."""
    from xxhash import xxh3_128_digest as digest
    places = np.unique(np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in spans]))
    both = np.frombuffer(b"".join(digest(data[p:p + width]) for p in places.tolist()), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1], places, places, places


def _spell(rows_of, width: int, gram: int):
    """mapInArrow function: documents to the rows that ``rows_of`` makes of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        constants = _constants()
        for batch in batches:
            ids, tags, order = _ordered(batch)
            texts = batch.column("text")
            spans = batch.column("spans") if "spans" in batch.schema.names else None
            found = []
            for d, row in enumerate(order.tolist()):
                columns = rows_of(texts[row].as_buffer().to_pybytes(), spans and spans[row].as_py(), width, gram,
                                  constants)
                if columns is not None:
                    found.append((*columns, np.full(len(columns[0]), d)))
            if found:
                yield _emit(*(np.concatenate(x) for x in zip(*found)), ids, tags, width)
    return run


def with_key(docs: DataFrame, id_col: str, text_col: str, prefix: str = "") -> DataFrame:
    """``docs`` with id, tag and text (bytes), their names behind ``prefix``; tag tells rows with equal ids apart and is
    zero where ids do not repeat."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    repeats = docs.select(key.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tag = F.lit(0).cast("long") if repeats.isEmpty() else F.xxhash64(text)
    return docs.withColumns({f"{prefix}id": key, f"{prefix}tag": tag, f"{prefix}text": text.cast("binary")})


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, text) only."""
    prefix = free(docs.select(id_col, text_col), "__key_")
    return (with_key(docs.select(id_col, text_col), id_col, text_col, prefix)
            .select(*(F.col(prefix + c).alias(c) for c in ("id", "tag", "text"))))


def _earliest(rows: DataFrame, name: str) -> DataFrame:
    """The rows that are settled as repeats (open false) or need a further digit (open true)."""
    same = Window.partitionBy("h", "span").orderBy("id", "tag", "lo")
    first = (F.rank().over(same) == 1) & ~F.col("done")  # repeated rows tie
    rows = (rows.repartition("h").withColumn("open", first)
            .withColumn("classes", F.sum(F.col("open").cast("int")).over(Window.partitionBy("h"))))
    return materialize(rows.where("not open or classes > 1").select("id", "tag", "lo", "hi", "at", "open"), name)


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(id, tag, lo, hi): windows lo..hi (first bytes) of documents that also start earlier. ``docs`` comes from
    :func:`keyed`. Spans may overlap."""
    passed = _earliest(docs.where(F.length("text") >= width).mapInArrow(_spell(_run_rows, width, gram), ROWS), "runs")
    settled = passed.where("not open")
    for rows_of, name in ((_part_rows, "parts"), (_window_rows, "windows")):
        spans = (passed.where("open").groupBy("id", "tag")
                 .agg(F.collect_list(F.struct("lo", "hi", "at")).alias("spans")))
        passed = _earliest(docs.join(spans, ["id", "tag"]).mapInArrow(_spell(rows_of, width, gram), ROWS), name)
        settled = settled.unionByName(passed.where("not open"))
    return settled.select("id", "tag", "lo", "hi")


def _cut(width: int):
    def make():
        def run(cols):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "removed": []}
            for data, spans in zip(cols["text"], cols["spans"]):
                at, kept, removed = 0, [], []
                for lo, hi in sorted((s["lo"], s["hi"] + width) for s in spans or ()):
                    if removed and lo <= removed[-1][1]:
                        removed[-1][1] = max(removed[-1][1], hi)
                    else:
                        removed.append([lo, hi])
                for lo, hi in removed:
                    kept.append(data[at:lo])
                    at = hi
                kept.append(data[at:])
                kept = b"".join(kept)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(removed))
                out["kept"].append(kept)
                out["removed"].append([{"start": a, "stop": b} for a, b in removed])
            return out
        return run
    return make


CUT = ("n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<start:int,stop:int>>")


def _gathered(rows: DataFrame, width: int, gram: int) -> DataFrame:
    return (repeated_spans(rows, width, gram).groupBy("id", "tag")
            .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   gram: int = GRAM) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, removed) for every row of ``docs``: kept holds the bytes left, removed the
    maximal removed runs as (start, stop)."""
    rows = keyed(docs, id_col, text_col)
    found = append_columns(rows.join(_gathered(rows, width, gram), ["id", "tag"], "left"),
                           {"text": "text", "spans": "spans"}, CUT, _cut(width))
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "n_bytes", "n_removed", "n_spans",
                        "kept", "removed")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text, its other columns as they are. Parts of a
    character that a cut leaves over are dropped; a text of nothing but repeats becomes empty; null stays null."""
    prefix = free(docs, "__repeat_")
    spans = _gathered(keyed(docs, id_col, text_col), width, gram)
    spans = spans.select(*(F.col(c).alias(prefix + c) for c in ("id", "tag", "spans")))
    whole = with_key(docs, id_col, text_col, prefix).join(spans, [f"{prefix}id", f"{prefix}tag"], "left")

    def make():
        cut = _cut(width)()

        def run(cols):
            kept = cut({"text": [(t or "").encode("utf-8") for t in cols["text"]], "spans": cols["spans"]})["kept"]
            return {f"{prefix}kept": [None if t is None else k.decode("utf-8", "ignore")
                                      for t, k in zip(cols["text"], kept)]}
        return run

    whole = whole.drop(f"{prefix}text").withColumn(text_col, F.col(text_col).cast("string"))
    left = append_columns(whole, {"text": text_col, "spans": f"{prefix}spans"}, f"{prefix}kept string", make)
    return left.withColumn(text_col, F.col(f"{prefix}kept")).select(*docs.columns)
