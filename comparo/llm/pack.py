"""Packing of token pieces into sequences by bounded-space online best fit.

Documents are encoded, closed with an end token and cut into pieces of at most ``limit`` tokens. Full pieces are
sequences of their own. The others are dealt into groups of about ``GROUP`` pieces by a hash of their document, place,
length, checksum and a number written with them, so that rows with one repeated or null id spread over the groups, and
packed group by group, one piece after the other, into a fixed number of open bins: bins stand in lists by
free space, and a bit set (one integer, bit s for free space s) tells which lists are not empty, so the
tightest bin that still holds a piece is the lowest set bit at or above its length. When a piece fits none and all
bins are open, the fullest bin closes. A bin that is full closes by itself.

Only (id, piece, length, checksum) rows are shuffled, never tokens or texts. The state of a task is its open bins. A
sequence number is its group's number times 2**33 plus the bin's number, so groups never meet.

The word vocabulary drops white space, and no match of its pattern reaches over white space, so texts are
encoded run by run between ASCII white space, and a worker keeps the ids of the runs it met last in a table of
bounded size.

Defined results: a null text is empty and packs as its end token alone; rows with equal ids are packed as
documents of their own; a null id is packed like any other. The string of a special token in a text is that token, as in the library.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import Recent, map_rows, materialize

LIMIT = 4096
OPEN_BINS = 256
GROUP = 100_000
CACHE = 1 << 19


def public_vocabulary() -> str:
    """Path of the public word vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable bytes for themselves, the others for
    letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers.

    A run of printable Latin characters goes straight to the vocabulary's merges: lower case and the splitting pattern
    are all that the library does to it before. Any other run goes through the whole tokenizer. The strings of special tokens
    are cut out first and have their own ids, as in the library."""
    import re
    import struct

    import regex
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    special = {t.content: struct.pack("<I", i) for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")" if special else "(?!)").split
    tokenizer.encode_special_tokens = True  # what is left between them holds none
    merge, letters = tokenizer.model.tokenize, byte_letters()
    # fixed values: the splitting pattern of the vocabulary, in general and for lower-case printable ASCII
    ascii_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
    words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
    ascii_run, latin_run = re.compile(r"[!-~]+").fullmatch, re.compile("[!-~\xa1-\u02ff]+").fullmatch
    spaces = re.compile(r"[\t-\r ]+")

    def ids(part: str) -> bytes:
        if ascii_run(part):
            found = [t.id for w in ascii_words(part.lower()) for t in merge(w)]
        elif latin_run(part):
            found = [t.id for w in words(part.lower())
                     for t in merge(w.encode("utf-8").decode("latin-1").translate(letters))]
        else:
            found = tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    known = Recent(ids, CACHE)

    def plain(text: str) -> bytes:
        return b"".join([known[part] for part in spaces.split(text) if part])

    def encode(text: str) -> bytes:
        if not any(s in text for s in special):
            return plain(text)
        return b"".join(special[part] if part in special else plain(part) for part in at_special(text))

    return encode


def pieces(docs: DataFrame, path: str, limit: int = LIMIT, end_token: int = 1, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document; ids as the bytes of 32-bit integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def make():
        encode, end = encoder(path), np.array([end_token], dtype="<u4").tobytes()

        def run(cols):
            out = {n: [] for n in ("id", "piece", "start", "length", "ids_crc32", "ids")}
            for key, text in zip(cols["id"], cols["text"]):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    values = key, k, at // 4, len(part) // 4, zlib.crc32(part), part
                    for column, value in zip(out.values(), values):
                        column.append(value)
            return out
        return run

    return map_rows(rows, schema, make)


class OpenBins:
    """The open bins of one group."""

    def __init__(self, limit: int = LIMIT, bins: int = OPEN_BINS):
        self.limit, self.bins = limit, bins
        self.free = 0                                            # bit s: some open bin has s tokens free
        self.at: dict[int, list[int]] = {}                       # free space -> bins
        self.open = self.opened = 0

    def _take(self, space: int) -> int:
        stack = self.at[space]
        number = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``length`` tokens. A full piece is a closed bin of its own."""
        if length == self.limit:
            self.opened += 1
            return self.opened - 1, 0
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, number = self.limit, self.opened
            self.opened += 1
        left = space - length
        if left:
            self.at.setdefault(left, []).append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.limit - space


def pack(parts: DataFrame, limit: int = LIMIT, bins: int = OPEN_BINS, group: int = GROUP) -> DataFrame:
    """``parts`` (id, piece, length and whatever else, as :func:`pieces` returns them) with sequence_id and offset.

    ``parts`` is written out first: the number of groups follows the counted pieces, and a rerun of a lost task
    packs the same rows in the same order."""
    columns = parts.dtypes
    # the number tells equal pieces apart
    parts = materialize(parts.withColumn("__salt", F.monotonically_increasing_id()), "pieces")
    count = parts.count()
    groups = max(1, -(-count // group))
    rows = parts.withColumn("grp", F.pmod(F.xxhash64("id", "piece", "length", "ids_crc32", "__salt", F.lit(17)),
                                          F.lit(groups)).cast("int")).drop("__salt")
    rows = (rows.repartition(groups, "grp")
            .sortWithinPartitions("grp", F.xxhash64("id", "piece"), "id", "piece", "length", "start", "ids_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            sequence, offset = [], []
            for grp, length in zip(batch.column("grp").to_pylist(), batch.column("length").to_pylist()):
                if grp != current:
                    current, state = grp, OpenBins(limit, bins)
                number, place = state.put(length)
                sequence.append((grp << 33) + number)
                offset.append(place)
            keep = [i for i, n in enumerate(batch.schema.names) if n != "grp"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in columns) + ", sequence_id long, offset long"
    return rows.mapInArrow(run, schema)
