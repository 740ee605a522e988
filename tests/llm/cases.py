"""Small tables with awkward rows, and brute-force versions of the operators' contracts."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

LONG = "long text goes on and on " * 9000
PASSAGE = ("In every corpus there is a passage that many documents share, and it is longer than one hundred bytes, so that "
           "windows of it repeat across documents and are removed from all but the first.")
TEXTS = [
    (1, "The cat sat on the mat and looked at the moon. " * 3),
    (2, "The cat sat on the mat and looked at the moon. " * 3),
    (3, None), (4, ""), (5, " \t\n\v "), (6, "one"), (7, "One  TWO\nthree"),
    (8, PASSAGE + " First ending."), (9, "Another start. " + PASSAGE), (9, "Another start. " + PASSAGE),
    (10, "Another start with the same id. " + PASSAGE), (10, "same id, other text " + PASSAGE),
    (None, "a row without id " + PASSAGE), (None, None), (None, "a row without id " + PASSAGE),
    (11, LONG), (12, LONG + "x"), (13, "éÀ ñandú ß İ   日本語 😀 don't 's 12345 !!\r\n%%%"), (14, "a" * 5000),
    (15, "x\ny\nx\n\nx\n"), (-5, "negative id"), (2**62, "large id"),
]


def documents(spark, rows=TEXTS):
    """The rows with columns whose names clash with those that operators use inside."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, id string, fp string, tag string, "
              "spans string, score string, component_id string, label string, n_tokens string, kept string")
    return spark.createDataFrame(
        [(i, t, "en" if i else None, None, len(t or ""), *["clash"] * 9) for i, t in rows], schema)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --------------------------------------------------------------------------- contracts, row by row

def links(vectors, threshold):
    """{id: (n_links, component_id)} of vectors {key: (id, vector or None)}."""
    scaled = {k: np.array(v, dtype=np.float64) / np.abs(v).max() for k, (_, v) in vectors.items() if v is not None}
    unit = {k: v / np.linalg.norm(v) for k, v in scaled.items()}
    near = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold]
            for k in unit}
    return {k: (len(near.get(k, ())), min(vectors[j][0] for j in reach(k, near))) for k in vectors}


def reach(start, near):
    found, queue = {start}, [start]
    while queue:
        for j in near.get(queue.pop(), ()):
            if j not in found:
                found.add(j)
                queue.append(j)
    return found


def base_rules(text):
    w = words(text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = collections.Counter(windows)
    covered = {p for k, x in enumerate(windows) if times[x] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def removed(docs, width=100):
    """{key: (n_bytes, n_removed, n_spans, sha256)} of texts by ordered keys; equal keys are one document."""
    out, seen = {}, set()
    for key in sorted(docs):
        data = (docs[key] or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - width + 1):
            window = data[p:p + width]
            if window in seen:
                covered[p:p + width] = b"\1" * width
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for p, c in enumerate(covered) if c and not (p and covered[p - 1]))
        out[key] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def simhash(text, size=3):
    import xxhash
    w = words(lower(text))
    grams = [" ".join(w[k:k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows):
    """Component of each of the (id, text) rows, as sets of row numbers."""
    prints = [simhash(t) for _, t in rows]
    near = {k: [j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for k, p in enumerate(prints)}
    return {frozenset(reach(k, near)) for k in near}


def held_out(key, modulus):
    return zlib.crc32(("" if key is None else str(key)).encode()) % modulus == 1


def base_scores(docs):
    """[(id, held_out, n_tokens, n_known, N, base_score)] of (id, text) rows."""
    tokens = [(i, words(lower(t)) + ["\n"]) for i, t in docs]
    counts = collections.Counter(w for i, ws in tokens if not held_out(i, 5) for w in ws)
    total, norm = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    return [(i, held_out(i, 5), len(ws), sum(w in counts for w in ws), total,
             sum(math.log10((counts[w] + 0.5) / norm) for w in ws)) for i, ws in tokens]
