"""Alignment of two tokenizers against the libraries, link by link."""

import collections
import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import cases
from comparo.llm import cross_tokens, queries
from conftest import SF_SMALL

AWKWARD = [(20, "a▁b"), (21, "\x00 nul"), (22, "<|endoftext|> <s>x</s> <unk> <0x41>"), (23, " "), (24, "\n\n"), (25, "ﬁ ℌ ①"),
           (26, "x" * 3000 + " " * 3000), (27, "the the the the"), (27, "the the the the"), (28, "é" * 50), (29, "　全角")]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as public
    first = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    table = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    a_bytes = lambda i: bytes(table[c] for c in first.id_to_token(i))
    b_bytes = lambda i: (bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                         else second.id_to_piece(i).replace("▁", " ").encode())
    return first, second, a_bytes, b_bytes


def aligned(text, libraries):
    """(a, b, groups, links) of a text, token by token; None without tokens."""
    first, second, a_bytes, b_bytes = libraries
    if not text:
        return None
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    data = b" " + text.encode()
    if b"".join(map(a_bytes, a)) != data or b"".join(map(b_bytes, b)) != data:
        return None
    spans = []
    for ids, size in ((a, a_bytes), (b, b_bytes)):
        at, own = 0, []
        for i in ids:
            own.append((at, at + len(size(i)), i))
            at = own[-1][1]
        spans.append(own)
    links, low = [], 0
    for s, e, i in spans[0]:
        while spans[1][low][1] <= s:
            low += 1
        k = low
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, spans[1][k][2]))
            k += 1
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, start = [], 0
    ends = [collections.defaultdict(list) for _ in spans]
    for own, by_cut in zip(spans, ends):
        k = 0
        for s, e, i in own:
            while e > cuts[k]:
                k += 1
            by_cut[k].append(i)
    groups = [(ends[0][k], ends[1][k]) for k in range(len(cuts))]
    return a, b, groups, links


def expected(rows, libraries):
    found = [aligned(t, libraries) for _, t in rows]
    count = collections.Counter(p for f in found if f for p in set(f[3]))
    best = collections.Counter()
    for (i, _), c in count.items():
        best[i] = max(best[i], c)
    out = []
    for (key, _), f in zip(rows, found):
        if f is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr), count


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_awkward_rows(spark, libraries):
    rows = cases.TEXTS + AWKWARD
    got = cross_tokens.score_documents(cases.documents(spark, rows).repartition(3))
    assert cases.rows_of(got, "id", *COLUMNS) == expected(rows, libraries)[0]


def test_many_segments_and_waves_give_the_same(spark, libraries, monkeypatch):
    monkeypatch.setattr(cross_tokens, "BLOCK", 3000)
    rows = cases.TEXTS + AWKWARD
    got = cross_tokens.score_documents(cases.documents(spark, rows).repartition(3), segment=100, wave=2)
    assert cases.rows_of(got, "id", *COLUMNS) == expected(rows, libraries)[0]


def test_pair_counts(spark, libraries):
    rows = cases.TEXTS + AWKWARD
    got = cross_tokens.pair_counts(cases.documents(spark, rows))
    want = expected(rows, libraries)[1]
    assert {(r.a, r.b): r.documents for r in got.collect()} == dict(want)


def test_groups_themselves(spark, libraries):
    rows = [(1, "The cat's   mat"), (2, None), (3, "日本語 don't"), (4, "a▁b")]
    got = {r.id: [(g.a, g.b) for g in r.groups] for r in cross_tokens.align_documents(cases.documents(spark, rows)).collect()}
    assert got == {i: (f[2] if (f := aligned(t, libraries)) else []) for i, t in rows}


def test_empty_tables(spark):
    assert cross_tokens.score_documents(cases.documents(spark, [])).count() == 0
    got = cross_tokens.score_documents(cases.documents(spark, [(1, None), (2, "")]))
    assert cases.rows_of(got, "id", *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_text_of_several_megabytes(spark, libraries):
    rng = np.random.default_rng(3)
    words = ["alpha", "über", "naïve", "x" * 30, "日本", "12345", "\n", "don't"]
    text = " ".join(words[k] for k in rng.integers(0, len(words), 400_000))
    got = cross_tokens.score_documents(cases.documents(spark, [(1, text), (2, "alpha über")]))
    assert cases.rows_of(got, "id", *COLUMNS) == expected([(1, text), (2, "alpha über")], libraries)[0]


TEXT = st.lists(st.sampled_from(["a", " ", "  ", "\n", "é", "日本", "don't", "12", "!!", "▁", "the", "\x00", "😀", "ing", "<s>",
                                 "<|endoftext|>", " ", "\xa0", "K"]), max_size=25).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_links_and_groups_of_any_texts(texts):
    files = cross_tokens.public_vocabularies()
    vocabularies = cross_tokens.pair(*files)
    a, b = vocabularies.encode(texts)
    found = cross_tokens.Aligned(np.concatenate(a), np.concatenate(b), np.array(list(map(len, a))), np.array(list(map(len, b))),
                                 vocabularies)
    stops = np.cumsum(found.n_links)
    keys = found.keys()
    for k, text in enumerate(texts):
        want = aligned(text, _LIBRARIES[0])
        own = keys[stops[k] - found.n_links[k]:stops[k]].tolist()
        links = [] if want is None else want[3]
        assert own == [x * vocabularies.width + y for x, y in links]
        groups = "" if want is None else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want[2])
        assert found.groups()[k].decode() == groups
        assert found.n_groups[k] == (0 if want is None else len(want[2]))


_LIBRARIES = []


@pytest.fixture(autouse=True, scope="module")
def _share(libraries):
    _LIBRARIES.append(libraries)


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 200_000])
def test_perfect_hash_is_minimal_and_loads(count):
    keys = np.unique(np.random.default_rng(count).integers(0, 1 << 40, count))
    function = cross_tokens.Perfect.load(cross_tokens.Perfect.of(keys).dump())
    assert sorted(function.numbers(keys).tolist()) == list(range(len(keys)))
    assert sum(8 * len(w) for w, _ in function.levels) <= len(keys) + 8 * 64  # eight bits a key at most


def test_foreign_key_is_refused():
    row = type("Row", (), {})()
    keys = np.arange(0, 1000, 2, dtype=np.int64)
    function = cross_tokens.Perfect.of(keys)
    order = np.empty_like(keys)
    order[function.numbers(keys)] = keys
    row.segment, row.function, row.keys = 0, function.dump(), order.tobytes()
    wave = cross_tokens.Wave([], 1)
    wave.parts = {0: (function, order)}
    assert [n.tolist() for _, _, n in wave.find(keys)] == [function.numbers(keys).tolist()]
    with pytest.raises(ValueError):
        list(wave.find(np.array([3], dtype=np.int64)))


def test_query_agrees_with_brute_force(spark, libraries):
    got = queries.op11(spark, SF_SMALL)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert cases.rows_of(got, "doc_id", *COLUMNS) == expected(rows, libraries)[0]
