"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every byte prefix of a piece there is exactly one token that can end its encoding: the one among the tokens
that are suffixes of the prefix whose left part's own last token may stand before it. Two tokens may stand side by
side if undoing their merges, latest first, never meets a pair across the border that the merge order would
have joined earlier. Storing that last token for each prefix gives

* the encoding, read backwards from the end;
* exact appends: new bytes only add prefixes;
* exact edits: prefixes before the edit stay, and the rest can be taken over as soon as as many prefixes in a row as
  the longest token has bytes agree with the old ones.

:class:`Vocabulary` holds the ranks; :class:`PrefixTable` is one piece's table; :func:`encoder` encodes whole
texts, each match of the splitting pattern separately. Texts repeat their words, so a worker keeps the ids
of the pieces it met last, in a table of bounded size; results do not depend on it. A piece that is itself a
token gets that token, as in the tiktoken library.

Defined results: a null text is empty and has no ids; a null id is passed through; repeated rows each get a row.
Lone surrogates cannot occur in Spark strings. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import Recent, append_columns, map_rows

CACHE = 1 << 18  # entries of a worker's table of runs, pieces, pairs or prefixes
SHORT = 10        # prefixes of at most so many bytes are kept
# White space as the splitting pattern of the vocabulary means it (fixed value, Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Vocabulary:
    """Ranks of byte tokens with what the prefix method needs of them; ``merged`` has the tokens that merges lead
    to."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.longest = max(self.size.values())
        self.starts: dict[bytes, int] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.merged = {t: r for t, r in ranks.items() if self.halves(r)}
        self.reach: dict[bytes, int] = {}  # longest token that ends in three bytes
        for t in self.merged:
            if len(t) > 2:
                self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 0))

    @staticmethod
    def ranks_of(path: str) -> dict[bytes, int]:
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(cls.ranks_of(path))

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into ``token``; itself twice for a single byte; None if no merges lead to it."""
        if token not in self._halves:
            text = self.tokens[token]
            found = (token, token) if len(text) == 1 else None
            for cut in range(1, len(text)):
                a, b = self.ranks.get(text[:cut], token), self.ranks.get(text[cut:], token)
                if a < token and b < token and self.halves(a) and self.halves(b) and self._apart(a, b, token):
                    found = (a, b)
                    break
            self._halves[token] = found
        return self._halves[token]

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether merges of rank below ``limit`` keep a border between a and b."""
        while True:
            if self.ranks.get(self.tokens[a] + self.tokens[b], limit) < limit:
                return False
            # of the two tokens at the border the one of higher rank was made last; equal ranks: the left one first
            if len(self.tokens[a]) == 1 and len(self.tokens[b]) == 1:
                return True
            if a > b and len(self.tokens[a]) > 1 or len(self.tokens[b]) == 1:
                limit, a = min(limit, a), self.halves(a)[1]
            else:
                limit, b = min(limit, b + 1), self.halves(b)[0]

    def adjacent(self, a: int, b: int) -> bool:
        """Whether b can follow a in an encoding."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            found = self.pairs[key] = self._apart(a, b, 1 << 62)
        return found


class PrefixTable:
    """Last token of each prefix of one piece. The start of a piece is looked up among the short prefixes of pieces
    met before (``vocabulary.starts``): a prefix has the same last token in every piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self._extend(len(self.data))

    def _extend(self, stop: int) -> None:
        v, data, last = self.vocabulary, self.data, self.last
        find, reach, pairs, starts = v.merged.get, v.reach.get, v.pairs, v.starts
        for end in range(len(last) + 1, stop + 1):
            token = starts.get(data[:end]) if end <= SHORT else None
            if token is None:
                for start in range(max(0, end - reach(data[end - 3:end], 2)) if end > 3 else 0, end):
                    token = find(data[start:end])
                    if token is not None:
                        if not start:
                            break
                        key = last[start - 1] << 32 | token
                        fits = pairs.get(key)
                        if fits or fits is None and v.adjacent(key >> 32, token):
                            break
                else:
                    raise ValueError("a byte has no token")
                if end <= SHORT:
                    if len(starts) > CACHE:
                        starts.clear()
                    starts[data[:end]] = token
            last.append(token)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in the place of bytes start..stop; returns the number of prefixes worked out anew."""
        old, rest = self.last[stop:], self.data[stop:]
        self.data, self.last = self.data[:start] + data + rest, self.last[:start]
        edited, equal = start + len(data), 0
        while len(self.last) < len(self.data):
            self._extend(len(self.last) + 1)
            token = self.last[-1]
            at = len(self.last) - 1 - edited
            equal = equal + 1 if at >= 0 and old[at] == token else 0
            if equal >= self.vocabulary.longest:
                done = len(self.last) - start
                self.last += old[at + 1:]
                return done
        return len(self.last) - start

    def ids(self) -> list[int]:
        out, end, size = [], len(self.data), self.vocabulary.size
        while end:
            out.append(self.last[end - 1])
            end -= size[out[-1]]
        return out[::-1]


def encode_piece(vocabulary: Vocabulary, piece: bytes) -> list[int]:
    whole = vocabulary.ranks.get(piece)
    return [whole] if whole is not None else PrefixTable(vocabulary, piece).ids()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tuple[Callable[[str], bytes], Vocabulary]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers, and the vocabulary.

    White space separates the matches of ``pattern``: a run of other characters with the space before it holds
    whole matches, whatever stands around it, so the ids of such runs can be kept.
    """
    import re
    import struct

    import regex
    vocabulary = Vocabulary.load(path)
    coarse = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
    fine = regex.compile(pattern)

    def ids(part: str) -> bytes:
        letters = part.isascii() and part.removeprefix(" ").isalpha()  # is one match as it stands
        return pieces[part] if letters else b"".join([pieces[m] for m in fine.findall(part)])

    def piece_ids(piece: str) -> bytes:
        found = encode_piece(vocabulary, piece.encode("utf-8"))
        return struct.pack(f"<{len(found)}I", *found)

    known, pieces = Recent(ids, CACHE), Recent(piece_ids, CACHE)

    def encode(text: str) -> bytes:
        return b"".join(map(known.__getitem__, coarse.findall(text)))

    return encode, vocabulary


def public_vocabulary() -> tuple[str, str]:
    """Path and splitting pattern of the public multilingual vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     decode: bool = False) -> DataFrame:
    """(id, n_tokens, ids[, decoded]): ids as the bytes of little-endian unsigned 32-bit integers; with ``decode``, the
    bytes that these ids stand for, from the ids alone."""
    schema = "id long, n_tokens long, ids binary" + ", decoded binary" * decode

    def make():
        encode, vocabulary = encoder(path, pattern)
        decoded = decoder(vocabulary)

        def run(cols):
            ids = [encode(t) for t in cols["text"]]
            out = {"id": cols["id"], "n_tokens": [len(i) // 4 for i in ids], "ids": ids}
            return out | {"decoded": list(map(decoded, ids))} if decode else out
        return run

    return map_rows(_rows(docs, id_col, text_col), schema, make)


def decoder(vocabulary: Vocabulary) -> Callable[[bytes], bytes]:
    """A function from ids (bytes of 32-bit integers) to the bytes they stand for."""
    table = [vocabulary.tokens.get(i, b"") for i in range(max(vocabulary.tokens) + 1)]
    return lambda ids: b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def decode_documents(encoded: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of the ids in ``column``."""
    def make():
        decoded = decoder(Vocabulary.load(path))
        return lambda cols: {"decoded": list(map(decoded, cols["ids"]))}

    return append_columns(encoded, {"ids": column}, "decoded binary", make)


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_tokens) only."""
    return encode_documents(docs, path, pattern, id_col, text_col).select("id", "n_tokens")
