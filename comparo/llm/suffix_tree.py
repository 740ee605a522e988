"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are the words of the A-Z lower-cased text and one end per text. The tree's states are contexts of up to ``depth``
words. It is grown level by level:

* A context is a candidate if it was seen ``LEAST`` times in training, whatever the size of the corpus, so candidates and
  states grow with it. ``least_share`` asks for a share of the training tokens on top; by default there is none.
* The next tokens of each candidate are counted. A next token has an entry if its count diverges from what the suffix's
  distribution q expects: c * ln((c / n) / q) must exceed ln(n) / 2, n being the context's count. A candidate is
  retained if its whole distribution diverges: n * KL must exceed ln(n) / 2 for each entry and one for the rest, which is
  pooled. Suffixes of retained contexts stay in the tree.
* A next token seen once after a candidate has no entry, also where it would pass that test (q far below 1 / n); a next token
  seen more often that does not pass it has none either. Both are scored with the mass left, through the suffix.
* Distributions are smoothed: entries are counts less ``DISCOUNT``, the mass left goes to the distribution of the
  suffix, down to the root, which has (c + 0.5) / (N + 0.5 (V + 1)).

A text is scored token by token with the longest suffix of its past that is a state; contexts do not cross texts.

Texts are read once: a task packs them into blocks of about ``BLOCK`` bytes, each one row with its distinct
tokens (as 64-bit hashes), their training counts and the texts as numbers into them. All later passes work on blocks with
whole-array operations. A context is a 64-bit hash of its words, which a block works out by itself, so states are rows of
tables like their next tokens: they are never broadcast and never pass through the driver. A block asks for the states
and the pairs of state and token that it has, and for its tokens, each once and by one hash. What it asks is sorted and sent as one
compressed row to each bucket of the hashes, entries are packed by the same buckets (about ``KEYS`` each, so there are more
on a larger corpus), and a group of a bucket answers with the values in the order asked. Blocks are scored in
``WAVES`` parts, whose answers go before the next part asks.

So that blocks do not send every context they have, they look it up in a Bloom filter of the candidates, states or entries
first. It has at most ``FILTER_BITS`` bits (32 MB) on any corpus. It loses nothing: what it lets through by mistake goes in
the join behind it, so on a larger corpus more is moved and the results are the same.

Defined results: a null text is empty and has its end only; a null id counts as the empty text for the split and its
row is returned; repeated rows each get a row. Without training texts every probability is the root's with
N = V = 0. Other columns are ignored. Two different words, or
contexts, are taken for one if their 64-bit hashes are equal.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import drop, materialize, remainder, slices

BLOCK = 4 << 20
DEPTH = 3
LEAST_SHARE = 0.0
LEAST = 8
DISCOUNT = 0.75
END = 0x7E4D
ROOT = 0       # the empty context
REST = 0x7E57  # stands for a token in the row that has a state's mass left
KEYS = 1 << 20   # keys of a bucket, about
WAVES = 4        # parts of the blocks that are scored one after the other
FILTER_BITS, SEGMENT_BITS, KEY_BITS, PROBES = 1 << 28, 1 << 20, 12, 4
BLOCKS = "block long, ids array<long>, held binary, stops binary, codes binary, hashes binary, counts binary"


# blocks are large rows: a batch of Arrow's default size would hold many
FEW_BLOCKS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BLOCK // 2)}
# Packed values are not compressed again: a codec keeps buffers as large as a page outside the heap. Sizes are looked at from the
# first row on (by default from the hundredth), so that row groups are of about a block and readers hold one at a time
PACKED = {"compression": "uncompressed", "parquet.block.size": str(BLOCK // 2), "parquet.block.size.row.check.min": "1",
          "parquet.page.size.row.check.min": "1"}


def packed(x: np.ndarray) -> bytes:
    """An array compressed, all first bytes of its items before all second ones and so on."""
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


class Codes(dict):
    """Numbers for tokens, in the order in which they are met."""

    def __missing__(self, token):
        self[token] = number = len(self)
        return number


def _block(number: int, rows: list[tuple]) -> pa.RecordBatch:
    from xxhash import xxh3_64_intdigest as digest
    codes = Codes()
    codes[b"\n"]  # the end; no word holds a line break
    stream, stops, ids, held = array("i"), [], [], []
    for key, out, text in rows:
        stream.extend(map(codes.__getitem__, (text or "").encode("utf-8", "replace").lower().split()))
        stream.append(0)
        stops.append(len(stream))
        ids.append(key)
        held.append(out)
    hashes = np.fromiter(map(digest, codes), dtype=np.uint64, count=len(codes)).view(np.int64).copy()
    hashes[0] = END
    stream = np.array(stream, dtype=np.int32)
    training = np.repeat(~np.array(held), np.diff(stops, prepend=0))
    counts = np.bincount(stream[training], minlength=len(codes))
    held, stops = np.array(held, dtype=np.uint8), np.array(stops, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
         *(pa.array([packed(x)], pa.binary()) for x in (held, stops, stream, hashes, counts.astype(np.int32)))],
        names=["block", "ids", "held", "stops", "codes", "hashes", "counts"])


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as blocks (see above), written out; held marks the texts that are not learnt from."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (remainder(id_col, 5) == 1).alias("held"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, size, kept = TaskContext.get().partitionId() << 32, 0, []
        for batch in slices(batches):
            for row in zip(*(batch.column(n).to_pylist() for n in ("id", "held", "text"))):
                kept.append(row)
                size += len(row[2] or "")
                if size >= BLOCK:
                    yield _block(number, kept)
                    number, size, kept = number + 1, 0, []
        if kept:
            yield _block(number, kept)

    return materialize(rows.mapInArrow(run, BLOCKS), "token_blocks", FEW_BLOCKS, **PACKED)


class Block:
    """One row of :func:`blocks` as arrays."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        value = lambda name: batch.column(batch.schema.get_field_index(name))[at]
        read = lambda name, kind: unpacked(value(name).as_buffer(), kind)
        self.number, self.ids = value("block").as_py(), value("ids")
        self.held, self.stops = read("held", np.uint8).astype(bool), read("stops", np.int64)
        self.codes, self.hashes, self.counts = read("codes", np.int32), read("hashes", np.int64), read("counts", np.int32)
        self.starts = np.concatenate([[0], self.stops[:-1]])
        self.training = np.repeat(~self.held, self.stops - self.starts)


def _over_blocks(table: DataFrame, make, schema: str, columns: list[str]) -> DataFrame:
    """mapInArrow over blocks: ``make(block)`` returns int64 arrays of the columns of ``schema``."""
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                arrays = make(Block(batch, at))
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], names=columns)

    return table.mapInArrow(run, schema)


def extended(state: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of the contexts made of a context and the token after it."""
    x = state.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + token.view(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(33))).view(np.int64)


def _extend(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with each of ``columns`` extended by the column token."""
    def run(batches):
        for batch in batches:
            value = lambda n: batch.column(batch.schema.get_field_index(n)).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(extended(value(n), value("token"))) if n in columns else batch.column(n)
                 for n in batch.schema.names], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


class Filter:
    """A Bloom filter of ``count`` segments; a key has all its bits in one."""

    def __init__(self, keys: int):
        self.count = min(-(-KEY_BITS * keys // SEGMENT_BITS) or 1, FILTER_BITS // SEGMENT_BITS)
        self.words = None  # broadcast

    def place(self, keys: np.ndarray, probe: int) -> np.ndarray:
        """One of the bits of each key."""
        k = keys.view(np.uint64)
        segment = (k >> np.uint64(44)) % np.uint64(self.count) * np.uint64(SEGMENT_BITS)
        step = (k >> np.uint64(20)) | np.uint64(1)
        return segment + ((k + np.uint64(probe) * step) & np.uint64(SEGMENT_BITS - 1))

    def has(self, keys: np.ndarray) -> np.ndarray:
        """The places of the ``keys`` that may be in the filter."""
        bits, at = self.words.value, np.arange(len(keys))
        for probe in range(PROBES):
            place = self.place(keys[at], probe)
            at = at[(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return at


def filter_of(keys: DataFrame, column: str) -> Filter:
    """A filter of the longs in ``column``. Each segment is made in one group; the driver gets no more than the filter's bits."""
    made = Filter(keys.count())
    count = made.count

    def segment(rows: pa.Table) -> pa.Table:
        bits = np.zeros(SEGMENT_BITS, dtype=bool)
        number = rows.column("segment")[0].as_py()
        keys = rows.column("key").to_numpy()
        for probe in range(PROBES):
            bits[made.place(keys, probe) & np.uint64(SEGMENT_BITS - 1)] = True
        return pa.table({"segment": pa.array([number], pa.int64()),
                         "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    key = F.col(column)
    rows = keys.select(key.alias("key"), F.pmod(F.shiftrightunsigned(key, 44), F.lit(count)).cast("long").alias("segment"))
    size = SEGMENT_BITS // 8
    words = np.zeros(count * size, dtype=np.uint8)
    for r in rows.groupBy("segment").applyInArrow(segment, "segment long, bits binary").collect():
        words[r.segment * size:(r.segment + 1) * size] = np.frombuffer(r.bits, dtype=np.uint8)
    made.words = keys.sparkSession.sparkContext.broadcast(words)
    return made


def first_contexts(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For contexts of one word: the places of the tokens that such a context goes before, the context's number there, and the
    hashes by number, which are the codes' own."""
    at = np.flatnonzero(block.codes[:-1]) + 1
    return at, block.codes[at - 1], extended(np.zeros_like(block.hashes), block.hashes)


def next_tokens(block: Block, at: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of a context and the token after it: the number of the pair at each of the places, and by number its
    context and its token. A pair is the context of one word more that goes before the token after it. Hashes are worked out,
    looked up and sorted once a pair, not once a place."""
    kinds = len(block.hashes)
    pairs, number = np.unique(context * np.int64(kinds) + block.codes[at], return_inverse=True)
    return number.astype(np.int32), *np.divmod(pairs, kinds)


def in_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key (64 unsigned bits): equal ranges in the keys' order, so sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bucket_column(key: Column, buckets: int) -> Column:
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 32) * F.lit(buckets).cast("long"), 32)


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, its slice) of sorted bucket numbers."""
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def _next_counts(table: DataFrame, candidates: DataFrame, level: int, total: int) -> DataFrame:
    """(state, token, c) of the candidates of a level, for next tokens seen twice or more in training. A block sends one row
    of packed pairs to each of the buckets of the pairs' hashes, so a group has about ``KEYS`` pairs on any corpus."""
    known, buckets = filter_of(candidates, "state"), -(-total // KEYS) or 1
    schema = pa.schema([("bucket", pa.int64()), ("states", pa.binary()), ("tokens", pa.binary()), ("c", pa.binary())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                at, context, state = first_contexts(block)
                keep = block.training[at]
                at, context = at[keep], context[keep]
                for _ in range(level - 1):
                    goes_on = block.codes[at] != 0
                    at, context = at[goes_on], context[goes_on]
                    number, own, code = next_tokens(block, at, context)
                    at, context, state = at + 1, number, extended(state[own], block.hashes[code])
                keep = np.zeros(len(state), dtype=bool)
                keep[known.has(state)] = True
                keep = keep[context]
                number, own, code = next_tokens(block, at[keep], context[keep])
                state, token = state[own], block.hashes[code]
                c = np.bincount(number, minlength=len(own)).astype(np.int32)
                bucket = in_buckets(extended(state, token).view(np.uint64), buckets)
                order = np.lexsort((state, bucket))  # equal states side by side pack well
                for number, part in _parts(bucket[order]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int64()),
                         *(pa.array([packed(x[order[part]])], pa.binary()) for x in (state, token, c))], schema=schema)

    def summed(rows: pa.Table) -> pa.Table:
        state, token, c = (np.concatenate([unpacked(v.as_buffer(), kind) for v in rows.column(n)])
                           for n, kind in (("states", np.int64), ("tokens", np.int64), ("c", np.int32)))
        _, first, number = np.unique(extended(state, token), return_index=True, return_inverse=True)
        c = np.bincount(number, weights=c, minlength=len(first)).astype(np.int64)
        twice = c > 1
        first = first[twice]
        return pa.table({"state": state[first], "token": token[first], "c": c[twice]})

    rows = table.mapInArrow(pairs, "bucket long, states binary, tokens binary, c binary")
    counts = rows.groupBy("bucket").applyInArrow(summed, "state long, token long, c long")
    return materialize(counts, "next_counts", FEW_BLOCKS)


def _level(counts: DataFrame, candidates: DataFrame, below: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Smoothed next-token table (state, parent, token, c, entry, prob) of one level and (state, keep, rest) of its states
    that have entries; ``below`` (state, token, prob) has the distributions of the suffixes."""
    rows = counts.join(candidates, "state").join(
        below.select(F.col("state").alias("parent"), "token", F.col("prob").alias("q")), ["parent", "token"])
    rows = materialize(rows, "expected")
    drop(counts)
    p = F.col("c") / F.col("size")
    diverges = F.col("c") * F.log(p / F.col("q")) > 0.5 * F.log("size")
    seen = rows.where(diverges).groupBy("state", "size").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("c"), F.sum("q").alias("q"),
        F.sum(p * F.log(p / F.col("q"))).alias("gain"))
    rest, rest_q = 1 - p, F.greatest(1 - F.col("q"), F.lit(1e-12))
    gain = F.col("gain") + F.when(F.col("c") < F.col("size"), rest * F.log(rest / rest_q)).otherwise(0.0)
    found = materialize(seen.select(
        "state", (F.col("size") * gain > 0.5 * (F.col("kinds") + 1) * F.log("size")).alias("keep"),
        (1 - (F.col("c") - DISCOUNT * F.col("kinds")) / F.col("size")).alias("rest")), "left")
    entry = F.when(diverges, (F.col("c") - DISCOUNT) / F.col("size")).otherwise(0.0)
    out = (rows.join(found.select("state", "rest"), "state", "left").withColumn("entry", entry)
           .withColumn("prob", F.col("entry") + F.coalesce("rest", F.lit(1.0)) * F.col("q")))
    grown = materialize(out.select("state", "parent", "token", "c", "entry", "prob"), "next_tokens")
    drop(rows)
    return grown, found


def _keyed(rows: DataFrame, state: Column, token: Column, value: Column, *others: str) -> DataFrame:
    """(others, key, value): ``value`` under the hash of a state and a token, or ``REST``."""
    rows = rows.select(*others, state.cast("long").alias("key"), token.cast("long").alias("token"), value.alias("value"))
    return _extend(rows, ["key"]).drop("token")


def learn(table: DataFrame, depth: int = DEPTH, least_share: float = LEAST_SHARE) -> dict:
    """The tree of the training texts of ``table``: totals, the table ``entries`` (key, value) and a filter of its keys. It
    has the entries of every state and, for ``REST``, its mass left; ``roots`` has the token counts for the root."""
    def pairs(block: Block):
        at = np.flatnonzero(block.counts)
        return block.hashes[at], block.counts[at]

    counts = _over_blocks(table, pairs, "token long, c long", ["token", "c"])
    counts = materialize(counts.groupBy("token").agg(F.sum("c").alias("c")), "token_counts", FEW_BLOCKS)
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(LEAST, math.ceil(least_share * total))
    grown = counts.select(
        F.lit(ROOT).cast("long").alias("state"), F.lit(ROOT).cast("long").alias("parent"), "token", "c",
        ((F.col("c") + 0.5) / F.lit(total + 0.5 * (kinds + 1))).alias("prob"))
    levels = []
    for level in range(1, depth + 1):
        longer = grown.where((F.col("c") >= least) & (F.col("token") != END)).select(
            "state", "parent", "token", F.col("c").alias("size"))
        # the suffix of one word is the root
        candidates = _extend(longer, ["state", "parent"] if level > 1 else ["state"]).drop("token")
        candidates = materialize(candidates, "candidates")
        if candidates.isEmpty():
            break
        below, (grown, found) = grown, _level(_next_counts(table, candidates, level, total), candidates, grown)
        if level > 1:
            drop(below)
        own = _keyed(grown.where("entry > 0"), F.col("state"), F.col("token"), F.col("entry"), "state")
        levels.append((candidates, materialize(own, "own_entries"), found))
    if levels:
        drop(grown)
    roots = _keyed(counts, F.lit(ROOT), F.col("token"), F.col("c").cast("double"))
    entries, above = roots.limit(0), None
    for candidates, own, found in reversed(levels):
        kept = found.where("keep").select("state")
        if above is not None:  # suffixes stay in the tree
            kept = kept.unionByName(above.select(F.col("parent").alias("state"))).distinct()
        above = materialize(candidates.join(kept, "state").join(found, "state", "left").select(
            "state", "parent", F.coalesce("rest", F.lit(1.0)).alias("rest")), "states")
        entries = (entries.unionByName(_keyed(above, F.col("state"), F.lit(REST), F.col("rest")))
                   .unionByName(own.join(above.select("state"), "state", "left_semi").drop("state")))
    entries = materialize(entries, "entries")
    for tables in levels:
        drop(*tables)
    return {"roots": roots, "entries": entries, "filter": filter_of(entries, "key"), "depth": len(levels),
            "total": int(total), "kinds": int(kinds)}


def _asked(block: Block, depth: int, known: Filter) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """The keys a block asks for, those of its tokens at the root first, their values where there is no answer, and per
    level (places of tokens with a context that may be a state, place of its mass left among the keys, place of the entry,
    -1 for none). The suffix of a state is a state, so a longer context is looked up only where its suffix may be one."""
    at, context, state = first_contexts(block)
    keys, values, levels, count = [state], [np.zeros(len(state))], [], len(state)

    def places(hashes: np.ndarray, which: np.ndarray, value: float) -> np.ndarray:
        """The place among the keys by number, -1 for those that are not in ``which`` or the filter."""
        nonlocal count
        asked = np.zeros(len(hashes), dtype=bool)
        asked[which] = True
        asked = np.flatnonzero(asked)
        asked = asked[known.has(hashes[asked])]
        keys.append(hashes[asked])
        values.append(np.full(len(asked), value))
        out = np.full(len(hashes), -1, dtype=np.int32)
        out[asked] = count + np.arange(len(asked))
        count += len(asked)
        return out

    for level in range(depth):
        # what is no state leaves all its mass
        rest = places(extended(state, np.full(len(state), REST)), context, 1.0)[context]
        is_state = np.zeros(len(block.codes) + 1, dtype=bool)
        is_state[at[rest >= 0]] = True
        used = is_state[at]
        # pairs of a state and a token, and those that are the context of one word more after a suffix that may be a state
        need = used | is_state[at + 1] if level + 1 < depth else used
        rest, used, at = rest[used], used[need], at[need]
        number, own, code = next_tokens(block, at, context[need])
        state = extended(state[own], block.hashes[code])
        entry = places(state, number[used], 0.0)[number[used]]
        levels.append((at[used].astype(np.int32), rest, entry))
        longer = is_state[at + 1]
        at, context = at[longer] + 1, number[longer]
    return np.concatenate(keys), np.concatenate(values), levels


def score(table: DataFrame, model: dict) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all texts of ``table``."""
    total, norm, depth = model["total"], model["total"] + 0.5 * (model["kinds"] + 1), model["depth"]
    known = model["filter"]

    entries = model["entries"].unionByName(model["roots"])
    n_keys, n_blocks = entries.count(), table.count()
    buckets = -(-n_keys // KEYS) or 1
    # a block asks for about a sixth of its bytes; a group answers some 4 KEYS questions
    salts = max(1, min(n_blocks, n_blocks * BLOCK // 6 // (4 * KEYS * buckets)))

    def packed_entries(rows: pa.Table) -> pa.Table:
        key, value = rows.column("key").to_numpy().view(np.uint64), rows.column("value").to_numpy()
        order = np.argsort(key)
        return pa.table({"bucket": rows.column("bucket").slice(0, 1).combine_chunks(),
                         "keys": pa.array([packed(np.diff(key[order], prepend=np.uint64(0)))], pa.binary()),
                         "found": pa.array([packed(value[order])], pa.binary())})

    held = (entries.withColumn("bucket", bucket_column(F.col("key"), buckets)).groupBy("bucket")
            .applyInArrow(packed_entries, "bucket long, keys binary, found binary"))
    held = materialize(held, "packed_entries", FEW_BLOCKS, **PACKED)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row)
                keys = np.sort(_asked(block, depth, known)[0].view(np.uint64))
                for bucket, part in _parts(in_buckets(keys, buckets)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.number], pa.int64()), pa.array([bucket], pa.int64()),
                         pa.array([packed(np.diff(keys[part], prepend=np.uint64(0)))], pa.binary())],
                        names=["block", "bucket", "asked"])

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        """The value of every key asked for, NaN where there is none. No key is in the entries twice."""
        out = {"block": left.column("block"), "bucket": left.column("bucket"), "values": []}
        if right.num_rows:
            keys = np.cumsum(unpacked(right.column("keys")[0].as_buffer(), np.uint64), dtype=np.uint64)
            found = unpacked(right.column("found")[0].as_buffer(), np.float64)
        for asked in left.column("asked"):
            own = np.cumsum(unpacked(asked.as_buffer(), np.uint64), dtype=np.uint64)
            values = np.full(len(own), np.nan)
            if right.num_rows:
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[place] == own
                values[hit] = found[place[hit]]
            out["values"].append(packed(values))
        return pa.table(out, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("values", pa.binary())]))

    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")
    spread = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def answers_to(part: DataFrame) -> DataFrame:
        asked = part.mapInArrow(wanted, "block long, bucket long, asked binary").withColumn("salt", salt)
        found = (asked.groupBy("bucket", "salt").cogroup(spread.groupBy("bucket", "salt"))
                 .applyInArrow(answered, "block long, bucket long, values binary"))
        return materialize(found, "answers", FEW_BLOCKS, **PACKED)  # the shuffles behind it go before the blocks are dealt

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in ("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")}
        for row in range(left.num_rows):
            block = Block(left, row)
            keys, found, levels = _asked(block, depth, known)
            by_bucket = sorted(zip(right.column("bucket").to_pylist(), range(right.num_rows)))
            values = np.concatenate([unpacked(right.column("values")[k].as_buffer(), np.float64) for _, k in by_bucket])
            order = np.argsort(keys.view(np.uint64))
            known_values = ~np.isnan(values)
            found[order[known_values]] = values[known_values]
            seen = found[:len(block.hashes)]
            root = (seen + 0.5) / norm
            prob = root[block.codes]
            base = np.log10(root)[block.codes]
            for at, rest, entry in levels:
                prob[at] = np.where(entry >= 0, found[entry], 0.0) + found[rest] * prob[at]
            sums = lambda x: np.add.reduceat(x, block.starts).tolist()
            ids = block.ids.as_py()
            out["id"] += ids
            out["held_out"] += block.held.tolist()
            out["n_tokens"] += (block.stops - block.starts).tolist()
            out["n_known"] += sums((seen > 0)[block.codes].astype(np.int64))
            out["train_tokens"] += [total] * len(ids)
            out["base_score"] += sums(base)
            out["score"] += sums(np.log10(prob))
        return pa.table(out, schema=pa.schema([
            ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]))

    waves, scored = max(1, min(WAVES, n_blocks)), None
    for wave in range(waves):
        part = table.where(F.pmod(F.xxhash64("block"), F.lit(waves)) == wave)
        answers = answers_to(part)
        found = (part.groupBy("block").cogroup(answers.groupBy("block"))
                 .applyInArrow(meet, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                     "base_score double, score double"))
        found = materialize(found, "scores", FEW_BLOCKS)
        drop(answers)
        scored = found if scored is None else scored.unionByName(found)
    return scored


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                    least_share: float = LEAST_SHARE) -> DataFrame:
    """Learn from the texts that are not held out and score all."""
    table = blocks(docs, id_col, text_col)
    return score(table, learn(table, depth, least_share))
