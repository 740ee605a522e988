"""Quality rules from tokeniser fertility.

Each word is encoded on its own with a public vocabulary that falls back to bytes. A text then has three measures: code
points of its words per token, the share of tokens that are byte fall-backs, and the entropy of its tokens in bits.
Text of another kind than the vocabulary was made for, shouting, symbol noise and binary rests need many
tokens for their characters or many bytes; repetition, listings and noise between words have little entropy for their
length. Each measure has a band,
given per language, else per script (the script of most letters), and a text outside a band is rejected.

Beside the verdict there are counts by plain rules (words, symbols, repeated lines and words) and the base rule over
them. :func:`rules` returns all columns and the verdict, :func:`keep_good` filters.

The word's ids depend on the word alone, so a task keeps those it met last in a table of bounded size. Every row is
judged by itself: there is no shuffle.

Defined results: a null text has no words; a text without words has null measures, fails the base rule and is
not kept. Unknown or null languages use the script's band, unknown scripts the widest one. Null ids pass through,
repeated rows each get a row, other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comparo.llm.common import Recent, append_columns, free

CACHE = 1 << 18
SYMBOLS = "#*$%&|<>"

# A text's entropy grows with its length: the least entropy is the band's floor plus GROWTH bits for each doubling of its
# tokens, up to FULL tokens, from where on it hardly grows.
GROWTH, FULL = 0.28, 3000
# Bands of (least, most characters per token), most byte share, floor of the entropy in bits. The least
# characters per token of the four languages are 0.05 below the least of the clean labelled texts of sf0.1 that are not held
# out (1.850, 2.063, 1.654, 1.798), rounded down to hundredths.
BANDS = {
    "en": (1.80, 8.0, 0.05, 3.5),
    "de": (2.01, 8.0, 0.05, 3.3),
    "fr": (1.60, 8.0, 0.05, 3.25),
    "es": (1.74, 8.0, 0.05, 3.35),
    "Latin": (1.30, 8.0, 0.15, 3.0),
    "Cyrillic": (1.00, 8.0, 0.15, 3.0),
    "Greek": (0.60, 6.0, 0.30, 2.8),
    "Arabic": (0.50, 6.0, 0.40, 2.8),
    "Hebrew": (0.50, 6.0, 0.40, 2.8),
    "Devanagari": (0.30, 6.0, 0.80, 2.0),
    "Thai": (0.30, 6.0, 0.80, 2.0),
    "Hangul": (0.25, 4.0, 0.90, 2.0),
    "Kana": (0.25, 4.0, 0.80, 2.0),
    "Han": (0.25, 4.0, 0.90, 2.0),
    "other": (0.20, 8.0, 1.00, -9.0),
}
# First code point of a range, and its script ("other" ends the range before it).
RANGES = [(0x41, "Latin"), (0x250, "other"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "other"), (0x590, "Hebrew"),
          (0x600, "Arabic"), (0x780, "other"), (0x900, "Devanagari"), (0x980, "other"), (0xE00, "Thai"),
          (0xE80, "other"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
          (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"),
          (0xAC00, "Hangul"), (0xD7B0, "other")]


def public_vocabulary() -> str:
    """Path of the public vocabulary with byte fall-back."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=1)
def model_of(path: str):
    """The vocabulary's model, and for each id whether it is a byte."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def word_table(path: str) -> tuple[Recent, np.ndarray]:
    """Table from a word to its ids (bytes of 32-bit integers), and for each id whether it is a byte."""
    model, is_byte = model_of(path)
    return Recent(lambda word: np.array(model.encode(word), dtype="<u4").tobytes(), CACHE), is_byte


def script_of(text: str) -> str:
    """The script of most letters of a text."""
    import regex
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else "other"
    points = np.frombuffer("".join(regex.findall(r"\p{L}+", text)).encode("utf-32-le"), dtype="<u4")
    if not len(points):
        return "other"
    place = np.searchsorted(np.array([a for a, _ in RANGES]), points, side="right") - 1
    votes = Counter()
    for k, n in enumerate(np.bincount(place[place >= 0], minlength=len(RANGES)).tolist()):
        votes[RANGES[k][1]] += n
    return max(votes, key=lambda s: (votes[s], s))


def plain_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    repeat = 0
    if len(times) < len(windows):
        covered = -1  # last word counted
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeat += i + 2 - max(covered, i - 1)
                covered = i + 2
    return sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat


COLUMNS = {"script": "string", "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "n_tokens": "long", "chars_per_token": "double", "byte_share": "double",
           "entropy": "double"}


def measured(docs: DataFrame, path: str, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``COLUMNS``, their names behind ``prefix``."""
    def make():
        import re
        find = re.compile(r"[^ \t-\r]+").findall
        table, is_byte = word_table(path)

        def run(cols):
            found = []
            for text in cols["text"]:
                text = text or ""
                words = find(text)
                plain = plain_counts(text, words)
                ids = np.frombuffer(b"".join(map(table.__getitem__, words)), dtype="<u4")
                measures = (None, None, None)
                if len(ids):
                    times = np.bincount(ids)
                    bytes_share = float(times[is_byte[:len(times)]].sum() / len(ids))
                    share = times[times > 0] / len(ids)
                    measures = (plain[0] / len(ids), bytes_share, float(-(share * np.log2(share)).sum()))
                found.append((script_of(text), len(words), *plain, len(ids), *measures))
            return dict(zip((prefix + c for c in COLUMNS), zip(*found) if found else [[] for _ in COLUMNS]))
        return run

    return append_columns(docs, {"text": text_col}, ", ".join(f"`{prefix}{c}` {t}" for c, t in COLUMNS.items()), make)


def _band(bands: dict, place: int, lang: Column, script: Column) -> Column:
    table = F.create_map(*[x for k, v in bands.items() for x in (F.lit(k), F.lit(float(v[place])))])
    return F.coalesce(table[lang], table[script], table[F.lit("other")])


def verdict(lang: Column, bands: dict[str, tuple[float, float, float, float]] = BANDS,
            prefix: str = "") -> tuple[Column, Column]:
    """(base_failed, reasons) over the columns of :func:`measured`; reasons names the bands left."""
    col = lambda name: F.col(prefix + name)
    band = lambda place: _band(bands, place, lang, col("script"))
    base = (col("n_words") < 50) | (100 * col("n_repeat_words") > 50 * col("n_words"))
    floor = band(3) + GROWTH * F.log2(F.least(col("n_tokens"), F.lit(FULL)))
    reasons = F.array_compact(F.array(
        F.when(col("chars_per_token") < band(0), "few characters per token"),
        F.when(col("chars_per_token") > band(1), "many characters per token"),
        F.when(col("byte_share") > band(2), "byte fall-back"),
        F.when(col("entropy") < floor, "little entropy")))
    return base, reasons


def _language(docs: DataFrame, lang_col: str) -> Column:
    return F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")


def rules(docs: DataFrame, path: str, bands: dict = BANDS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """(id, lang, the columns of ``COLUMNS``, base_failed, reasons, kept) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _language(docs, lang_col).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    base, reasons = verdict(F.col("lang"), bands)
    return (measured(rows, path).withColumn("base_failed", base).withColumn("reasons", reasons)
            .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)).drop("text"))


def keep_good(docs: DataFrame, path: str, bands: dict = BANDS, text_col: str = "text",
              lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    prefix = free(docs, "__fertility_")
    base, reasons = verdict(_language(docs, lang_col), bands, prefix)
    return (measured(docs, path, text_col, prefix).where(~base & (F.size(reasons) == 0))
            .drop(*(prefix + c for c in COLUMNS)))
