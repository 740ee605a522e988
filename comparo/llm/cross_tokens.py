"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked token pairs by minimal perfect hashing.

A text is encoded by vocabulary A (byte-level BPE) and vocabulary B (pieces with byte fallback). Tokens of both are ranges of the
same bytes. Where tokens of both end, a group ends; an A token and a B token are linked if their ranges overlap. The count
of a pair of ids is the number of documents that hold it linked.

1. :func:`blocks` encodes each text once and writes blocks of about ``BLOCK`` bytes of text: both id streams, the digests
   of the groups, and the block's distinct pairs with their document counts. All later passes are array operations on blocks.
2. The distinct pairs of the corpus are dealt by a hash into segments of about ``SEGMENT`` pairs. One task makes a segment's
   :class:`Perfect` hash: levels of bits, about four a pair, that number n pairs 0 to n - 1. The pairs in the order of
   their numbers are kept beside it.
3. Every task adds its blocks' counts into dense vectors with the hash as the index, after comparing each pair with the key
   kept at its number. Vectors are cut into pieces and summed in two steps of a tree, each in constant memory.
4. A second pass aligns the blocks' documents again and looks up the counts, keys compared again.

Hashes, keys and counts are broadcast for ``WAVE`` segments at a time (some 70 MB), however many pairs there are: more segments
take more waves over the blocks, and what waves find of a document is added. The highest count of each A id has one number for
each id of the vocabulary.

Defined results: a text that is null or empty, or that either vocabulary cannot give back byte by byte (space and text), has
no tokens: zeros and the digest ''. Strings of special tokens are plain text. Repeated rows are documents of their
own. A null id is kept. Very long texts are blocks of their own. Other columns are ignored. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.bpe_prefix import Vocabulary
from comparo.llm.common import drop, materialize, slices
from comparo.llm.suffix_tree import packed, unpacked

BLOCK = 2 << 20
SEGMENT = 1 << 20   # pairs of a segment, about
WAVE = 4            # segments whose hashes, keys and counts are broadcast at a time
PIECE = 1 << 15     # numbers of a piece of a count vector
FAN = 64            # branches of the first step of the tree
MANY = 1 << 20      # pairs that a task gathers before it passes them on
BLOCKS = ("block long, ids array<long>, n_a binary, n_b binary, n_groups binary, digests binary, a binary, b binary, "
          "pairs binary, documents binary")
RESULT = ("block long, place int, id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
FEW = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


# --------------------------------------------------------------------------- vocabularies

def public_vocabularies() -> tuple[str, str, str]:
    """Ranks of vocabulary A, its splitting pattern and the model of vocabulary B."""
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
            public_tokenizers.path("piece_bpe_32k.model"))


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Pair:
    """The two encoders with the bytes of their tokens; ``width`` is the number of B ids."""

    def __init__(self, ranks: str, pattern: str, model: str):
        import sentencepiece
        import tiktoken
        known = Vocabulary.ranks_of(ranks)
        self.first = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            self.a_bytes[rank] = token
        self.width = self.second.get_piece_size()
        self.b_bytes = [piece_bytes(self.second.id_to_piece(i), self.second.is_byte(i)) for i in range(self.width)]
        self.a_size = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        # decimal ids as fixed-width bytes, with one place for the separator
        names = [b"%d" % i for i in range(max(len(self.a_bytes), self.width))]
        self.digits = np.array(list(map(len, names)), dtype=np.int64)
        self.names = np.array(names).view(np.uint8).reshape(len(names), -1)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by A and B, none where they do not give its bytes back."""
        none = np.zeros(0, dtype=np.int64)
        given = [t or "" for t in texts]
        a_ids = [self.first.encode_to_numpy(" " + t).astype(np.int64) if t else none for t in given]
        b_ids = [np.array(x, dtype=np.int64) for x in self.second.encode(given, num_threads=1)]
        for k, t in enumerate(given):
            data = b" " + t.encode() if t else b""
            if (b"".join(map(self.a_bytes.__getitem__, a_ids[k].tolist())) != data
                    or b"".join(map(self.b_bytes.__getitem__, b_ids[k].tolist())) != data):
                a_ids[k] = b_ids[k] = none
        return a_ids, b_ids


@lru_cache(maxsize=1)
def pair(ranks: str, pattern: str, model: str) -> Pair:
    return Pair(ranks, pattern, model)


# --------------------------------------------------------------------------- alignment

class Aligned:
    """Links and groups of documents that stand one after the other: ``a``, ``b`` ids, ``n_a``, ``n_b`` of each document.

    Between two neighbouring ends of tokens there is one A token and one B token, and each overlapping pair of tokens
    meets in one such place, so places are links.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, vocabularies: Pair):
        self.a, self.b, self.n_a, self.n_b, self.vocabularies = a, b, n_a, n_b, vocabularies
        a_ends, b_ends = np.cumsum(vocabularies.a_size[a]), np.cumsum(vocabularies.b_size[b])
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, dtype=np.uint8)
        marks[a_ends] |= 1
        marks[b_ends] |= 2
        places = np.flatnonzero(marks)
        self.marks = marks[places]
        in_a, in_b = (self.marks & 1).astype(np.int64), (self.marks >> 1).astype(np.int64)
        self.at_a, self.at_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        self.group_ends = self.marks == 3
        # documents end at ends of both, so their links are those up to their last A token
        last = np.flatnonzero(in_a)
        stops = np.concatenate([[0], last + 1])[np.cumsum(n_a)]
        self.n_links = np.diff(stops, prepend=0)
        self.n_groups = n_a + n_b - self.n_links

    def keys(self) -> np.ndarray:
        """Each link's pair of ids as one number."""
        return self.a[self.at_a] * self.vocabularies.width + self.b[self.at_b]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each document."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        stops = np.cumsum(self.n_links)
        return total[stops] - total[stops - self.n_links]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs in order and the number of documents that hold each."""
        count = len(self.n_a)
        held = np.sort(self.keys() * count + np.repeat(np.arange(count), self.n_links))
        held = held[np.concatenate([[True], held[1:] != held[:-1]])] // count if len(held) else held
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else held
        return held[first], np.diff(np.append(first, len(held)))

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        group = np.cumsum(self.group_ends) - self.group_ends
        ends_a, ends_b = (self.marks & 1) > 0, (self.marks & 2) > 0
        group_a, group_b = group[ends_a], group[ends_b]
        # A tokens stand behind the B tokens of earlier groups, B tokens behind the A tokens of groups up to theirs
        place_a = np.arange(len(self.a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(self.b)) + np.searchsorted(group_a, group_b, "right")
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        after = np.empty(len(ids), dtype=np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        after[place_a] = np.where(self.group_ends[ends_a], ord("|"), ord(","))
        after[place_b] = np.where(self.group_ends[ends_b], ord(";"), ord(","))
        # the last A token of a group is the one that ends it, so a group's A ids end in a bar
        text, digits = self.vocabularies.names[ids], self.vocabularies.digits[ids]
        cells = np.zeros((len(ids), text.shape[1] + 1), dtype=np.uint8)
        cells[:, :-1] = text
        cells[np.arange(len(ids)), digits] = after
        flat = cells[np.arange(cells.shape[1]) <= digits[:, None]].tobytes()
        stops = np.concatenate([[0], np.cumsum(digits + 1)])[np.cumsum(self.n_a + self.n_b)].tolist()
        return [flat[a:max(a, z - 1)] for a, z in zip([0, *stops], stops)]


def _block(number: int, rows: list[tuple], vocabularies: Pair) -> pa.RecordBatch:
    ids = [r[0] for r in rows]
    n_a, n_b = (np.array([len(r[k]) for r in rows], dtype=np.int64) for k in (1, 2))
    a, b = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
    found = Aligned(a, b, n_a, n_b, vocabularies)
    digests = b"".join(hashlib.sha256(g).digest() for g in found.groups())
    keys, documents = found.distinct()
    values = [packed(x) for x in (n_a, n_b, found.n_groups)] + [digests] + [packed(x.astype(np.int32)) for x in (a, b)]
    values += [packed(np.diff(keys, prepend=0)), packed(documents.astype(np.int32))]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                                       *(pa.array([v], pa.binary()) for v in values)],
                                      names=[part.split()[0] for part in BLOCKS.split(", ")])


def blocks(docs: DataFrame, files: tuple[str, str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as encoded blocks (see above), written out."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        vocabularies = pair(*files)
        number, size, kept = TaskContext.get().partitionId() << 32, 0, []
        for batch in slices(batches, 64):
            texts = batch.column("text").to_pylist()
            for row in zip(batch.column("id").to_pylist(), *vocabularies.encode(texts), texts):
                kept.append(row[:3])
                size += len(row[3] or "")
                if size >= BLOCK or len(kept) >= 1 << 16:
                    yield _block(number, kept, vocabularies)
                    number, size, kept = number + 1, 0, []
        if kept:
            yield _block(number, kept, vocabularies)

    return materialize(rows.mapInArrow(run, BLOCKS), "aligned_blocks", FEW, **{"parquet.block.size": str(8 << 20)})


def _cell(batch: pa.RecordBatch, name: str, at: int):
    return batch.column(batch.schema.get_field_index(name))[at]


def _numbers(batch: pa.RecordBatch, name: str, at: int, kind=np.int64) -> np.ndarray:
    return unpacked(_cell(batch, name, at).as_buffer(), kind)


def align_documents(docs: DataFrame, files: tuple[str, str, str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, groups) with the groups themselves, an array of (a, b) id lists, for every document."""
    files = files or public_vocabularies()
    schema = "id long, groups array<struct<a:array<int>,b:array<int>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = pair(*files)
        for batch in slices(batches, 64):
            a, b = vocabularies.encode(batch.column("text").to_pylist())
            groups = []
            for x, y in zip(a, b):
                text = Aligned(x, y, np.array([len(x)]), np.array([len(y)]), vocabularies).groups()[0].decode()
                groups.append([dict(zip("ab", ([int(i) for i in side.split(",")] for side in g.split("|"))))
                               for g in text.split(";") if g])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(groups, pa.list_(pa.struct([("a", ints), ("b", ints)])))], names=["id", "groups"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------------------- minimal perfect hashing

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys, -1) % np.uint64(segments)).astype(np.int64)


class Perfect:
    """A minimal perfect hash of distinct longs. A level sets a bit where one key alone falls and passes the others on; a
    key's number is the count of bits before its own, over all levels."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = []  # words of 64 bits, and the bits before each word
        before = 0
        for words in levels:
            ranks = before + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, ranks[:-1]))
            before = int(ranks[-1])
        self.size = before

    @classmethod
    def of(cls, keys: np.ndarray) -> Perfect:
        levels, rest = [], keys
        while len(rest):
            words = len(rest) // 32 + 1  # two bits a key
            place = mixed(rest, len(levels)) % np.uint64(64 * words)
            alone = np.bincount(place.astype(np.int64), minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            rest = rest[~alone[place.astype(np.int64)]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for what is no key."""
        out, at = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (words, ranks) in enumerate(self.levels):
            place = mixed(keys[at], level) % np.uint64(64 * len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            own = words[word]
            here = (own >> bit) & np.uint64(1) > 0
            below = own[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[at[here]] = ranks[word[here]] + np.bitwise_count(below)
            at = at[~here]
            if not len(at):
                break
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *(len(w) for w, _ in self.levels)], dtype=np.int64)
        return sizes.tobytes() + b"".join(w.tobytes() for w, _ in self.levels)

    @classmethod
    def load(cls, data: bytes) -> Perfect:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, count, 8).tolist()
        words = np.frombuffer(data, np.uint64, offset=8 * (count + 1))
        return cls(np.split(words, np.cumsum(sizes)[:-1])) if count else cls([])


def pair_functions(table: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, int]:
    """(segment, function, keys) over the distinct pairs of all blocks, and the number of segments."""
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(kept)))], names=["key"])
        for batch in batches:
            for at in range(batch.num_rows):
                kept.append(np.cumsum(_numbers(batch, "pairs", at)))
                size += len(kept[-1])
                if size >= MANY:
                    kept = [np.unique(np.concatenate(kept))]
                    size = len(kept[0])
                    if size >= MANY // 2:
                        yield out()
                        kept, size = [], 0
        if kept:
            yield out()

    keys = materialize(table.select("pairs").mapInArrow(gathered, "key long").distinct(), "pairs", FEW)
    segments = -(-keys.count() // segment) or 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(segment_of(batch.column(0).to_numpy(), segments))],
                                             names=["key", "segment"])

    def built(rows: pa.Table) -> pa.Table:
        own = rows.column("key").to_numpy()
        function = Perfect.of(own)
        order = np.empty_like(own)
        order[function.numbers(own)] = own
        return pa.table({"segment": pa.array([rows.column("segment")[0].as_py()], pa.int64()),
                         "function": pa.array([function.dump()], pa.binary()), "keys": pa.array([order.tobytes()], pa.binary())})

    functions = (keys.mapInArrow(dealt, "key long, segment long").groupBy("segment")
                 .applyInArrow(built, "segment long, function binary, keys binary"))
    functions = materialize(functions, "pair_functions", FEW)
    drop(keys)
    return functions, segments


class Wave:
    """The functions, keys and, once counted, counts of some segments."""

    def __init__(self, rows: list, segments: int, counts: dict[int, np.ndarray] | None = None):
        self.segments, self.counts = segments, counts
        self.parts = {r.segment: (bytes(r.function), np.frombuffer(bytes(r.keys), np.int64)) for r in rows}

    def __getstate__(self):
        return self.segments, self.parts, self.counts

    def __setstate__(self, state):
        self.segments, parts, self.counts = state
        self.parts = {s: (Perfect.load(f), keys) for s, (f, keys) in parts.items()}

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(segment, places among ``keys``, their numbers), every key verified."""
        segment = segment_of(keys, self.segments)
        for own, (function, known) in self.parts.items():
            at = np.flatnonzero(segment == own)
            numbers = function.numbers(keys[at])
            if (numbers < 0).any() or (known[numbers] != keys[at]).any():
                raise ValueError("a pair is not among the keys")
            yield own, at, numbers


def _waves(functions: DataFrame, segments: int, wave: int) -> Iterator[list]:
    for low in range(0, segments, wave):
        yield functions.where(F.col("segment").between(low, low + wave - 1)).collect()


def _tree_sum(vectors: DataFrame) -> DataFrame:
    """(segment, piece, sums) of rows (segment, piece, branch, sums), in two steps; a task holds one sum at a time."""
    def step(rows: DataFrame, keys: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, total = None, None
            out = lambda: pa.RecordBatch.from_arrays(
                [*(pa.array([k], pa.int64()) for k in now), pa.array([packed(total)], pa.binary())], names=[*keys, "sums"])
            for batch in batches:
                places = [batch.schema.get_field_index(k) for k in keys]
                for at in range(batch.num_rows):
                    key = tuple(batch.column(p)[at].as_py() for p in places)
                    sums = _numbers(batch, "sums", at)
                    if key == now:
                        total += sums
                        continue
                    if now is not None:
                        yield out()
                    now, total = key, sums.copy()
            if now is not None:
                yield out()

        dealt = rows.select(*keys, "sums").repartition(*keys).sortWithinPartitions(*keys)
        return dealt.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", sums binary")

    return step(step(vectors, ["segment", "piece", "branch"]), ["segment", "piece"])


def _counted(table: DataFrame, rows: list, segments: int) -> DataFrame:
    """(segment, piece, sums) of the segments in ``rows``, written out."""
    wave = table.sparkSession.sparkContext.broadcast(Wave(rows, segments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known = wave.value
        vectors = {s: np.zeros(len(keys), dtype=np.int64) for s, (_, keys) in known.parts.items()}
        for batch in batches:
            for at in range(batch.num_rows):
                documents = _numbers(batch, "documents", at, np.int32)
                for own, places, numbers in known.find(np.cumsum(_numbers(batch, "pairs", at))):
                    vectors[own][numbers] += documents[places]  # a block has each pair once
        branch = TaskContext.get().partitionId() % FAN
        for own, vector in vectors.items():
            for piece, low in enumerate(range(0, len(vector), PIECE)):
                part = vector[low:low + PIECE]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([x], pa.int64()) for x in (own, piece, branch)), pa.array([packed(part)], pa.binary())],
                        names=["segment", "piece", "branch", "sums"])

    vectors = table.select("pairs", "documents").mapInArrow(run, "segment long, piece long, branch long, sums binary")
    return materialize(_tree_sum(vectors), "pair_counts", FEW)


def _counts(rows: list, counted: DataFrame) -> dict[int, np.ndarray]:
    out = {r.segment: np.zeros(len(bytes(r.keys)) // 8, dtype=np.int64) for r in rows}
    for r in counted.collect():
        sums = unpacked(bytes(r.sums), np.int64)
        out[r.segment][r.piece * PIECE:r.piece * PIECE + len(sums)] = sums
    return out


def _looked_up(table: DataFrame, files: tuple[str, str, str], wave: Wave, best: np.ndarray) -> DataFrame:
    """Rows of ``RESULT``; n_best and count_sum over the pairs of the wave."""
    known, highest = (table.sparkSession.sparkContext.broadcast(x) for x in (wave, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = pair(*files)
        for batch in batches:
            for at in range(batch.num_rows):
                n_a, n_b, n_groups = (_numbers(batch, n, at) for n in ("n_a", "n_b", "n_groups"))
                a, b = (_numbers(batch, n, at, np.int32).astype(np.int64) for n in "ab")
                found = Aligned(a, b, n_a, n_b, vocabularies)
                keys = np.cumsum(_numbers(batch, "pairs", at))
                count = np.zeros(len(keys), dtype=np.int64)
                for own, places, numbers in known.value.find(keys):
                    count[places] = known.value.counts[own][numbers]
                is_best = (count > 0) & (count == highest.value[keys // vocabularies.width])
                link = np.searchsorted(keys, found.keys())
                digests = _cell(batch, "digests", at).as_py()
                size = len(n_a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, _cell(batch, "block", at).as_py())), pa.array(np.arange(size, dtype=np.int32)),
                     _cell(batch, "ids", at).values, *map(pa.array, (n_a, n_b, n_groups, found.n_links)),
                     pa.array(found.per_document(is_best[link])), pa.array(found.per_document(count[link])),
                     pa.array([digests[32 * k:32 * k + 32].hex() if n else "" for k, n in enumerate(n_a.tolist())])],
                    names=[part.split()[0] for part in RESULT.split(", ")])

    return table.mapInArrow(run, RESULT)


def pair_counts(docs: DataFrame, files: tuple[str, str, str] | None = None, **columns) -> DataFrame:
    """(a, b, documents): the count of every linked pair of ids."""
    files = files or public_vocabularies()
    table = blocks(docs, files, **columns)
    functions, segments = pair_functions(table)
    counts = None
    width = pair(*files).width
    for rows in _waves(functions, segments, WAVE):
        counted = _counted(table, rows, segments)
        counts = counted if counts is None else counts.unionByName(counted)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, total = np.frombuffer(left.column("keys")[0].as_py(), np.int64), np.zeros(0, dtype=np.int64)
        for piece, sums in sorted(zip(right.column("piece").to_pylist(), right.column("sums").to_pylist())):
            total = np.concatenate([total, unpacked(sums, np.int64)])
        return pa.table({"a": (keys // width).astype(np.int32), "b": (keys % width).astype(np.int32), "documents": total})

    return (functions.select("segment", "keys").groupBy("segment").cogroup(counts.groupBy("segment"))
            .applyInArrow(run, "a int, b int, documents long"))


def score_documents(docs: DataFrame, files: tuple[str, str, str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", segment: int = SEGMENT, wave: int = WAVE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document (written out)."""
    files = files or public_vocabularies()
    table = blocks(docs, files, id_col, text_col)
    functions, segments = pair_functions(table, segment)
    vocabularies = pair(*files)
    best, counted = np.zeros(len(vocabularies.a_bytes), dtype=np.int64), []
    for rows in _waves(functions, segments, wave):
        counted.append(_counted(table, rows, segments))
        counts = _counts(rows, counted[-1])
        for r in rows:
            np.maximum.at(best, np.frombuffer(bytes(r.keys), np.int64) // vocabularies.width, counts[r.segment])
    found = None
    for rows, own in zip(_waves(functions, segments, wave), counted):
        part = materialize(_looked_up(table, files, Wave(rows, segments, _counts(rows, own)), best), "looked_up", FEW)
        found = part if found is None else found.unionByName(part)
    drop(table, functions, *counted)
    same = ["id", "n_a", "n_b", "n_groups", "n_links"]
    if len(counted) > 1:
        found = found.groupBy("block", "place").agg(
            *(F.max(c).alias(c) for c in [*same, "groups_sha256"]), *(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    return found.select(*same, "n_best", "count_sum", "groups_sha256")
