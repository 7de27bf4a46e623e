"""Byte-level BPE, token counts and packing against the libraries and against brute force."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import awkward, nothing, package  # noqa: F401
from tokenizers import Tokenizer

from starmill.llm import bpe, packing, token_counts

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = {"<|endoftext|>": 50256}


def library(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


MULTI_LIBRARY = library(MULTI)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_bpe_is_the_library(text):
    own = bpe.codec(MULTI, public_tokenizers.PATTERN)
    ids = own.encode(text)
    assert ids == MULTI_LIBRARY.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_bpe_of_a_long_piece():
    random.seed(3)
    text = "".join(random.choice("abcdefgh") for _ in range(20_000))
    assert bpe.codec(MULTI, public_tokenizers.PATTERN).encode(text) == MULTI_LIBRARY.encode_ordinary(text)


def test_merge_takes_the_leftmost_of_equal_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"aaa": 301}
    assert bpe.merge(b"aaaaa", ranks) == [300, 301]


def test_rank_file_without_a_byte_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        bpe.load_ranks(str(path))


def test_encode_and_decode_rows(awkward, nothing):
    rows = bpe.encode(awkward, MULTI, public_tokenizers.PATTERN)
    texts = sorted((r.text or "") for r in awkward.collect())
    out = rows.collect()
    assert sorted(bytes(r.decoded).decode() for r in out) == texts
    assert sorted(map(tuple, (r.ids for r in out))) == sorted(tuple(MULTI_LIBRARY.encode_ordinary(t)) for t in texts)
    again = bpe.decode(rows, MULTI, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in again) == texts
    assert bpe.encode(nothing, MULTI, public_tokenizers.PATTERN).count() == 0


def test_counts_are_the_library(awkward, nothing):
    tokenizer = Tokenizer.from_file(JSON)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False)))
                  for r in awkward.collect())
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(awkward, JSON).collect())
    assert got == want
    assert token_counts.count_tokens(nothing, JSON).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" ab'1\n.é　\x1c", max_size=60), max_size=6), st.integers(1, 20))
def test_parts_count_as_the_whole(texts, most):
    tokenizer = Tokenizer.from_file(JSON)
    for text in texts:
        cut = token_counts.parts(text, most)
        assert "".join(cut) == text
        assert sum(len(tokenizer.encode(p, add_special_tokens=False)) for p in cut) == len(
            tokenizer.encode(text, add_special_tokens=False))


def test_counts_of_another_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["hello there", "", "x" * 50_000]
    assert token_counts.count_texts(texts, path) == [len(model.encode(t)) for t in texts]
    with pytest.raises(ValueError):
        token_counts.count_texts(["a"], "tokens.txt")


@pytest.mark.parametrize("n, want", [(0, []), (1, [(0, 1)]), (4, [(0, 4)]), (5, [(0, 1), (1, 4)]), (8, [(0, 4), (4, 4)])])
def test_cut(n, want):
    assert packing.cut(n, 4) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_packed_bins_hold_everything_once(lengths):
    bins = packing.pack_lengths(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 50 for b in bins)


def fewest_by_force(lengths, most):
    """The least number of bins, all assignments tried."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[at] and rooms[k] not in rooms[:k]:
                place(at + 1, [*rooms[:k], rooms[k] - lengths[at], *rooms[k + 1:]])
        place(at + 1, [*rooms, most - lengths[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("lengths", [[4, 8, 3, 8, 3, 3, 3, 4, 9], [3, 9, 4, 3, 8, 3, 3, 4], [2, 2, 2, 9, 6, 5, 6, 3, 3]])
def test_search_beats_best_fit(lengths):
    only = packing.Bins(lengths, 10)
    only.best_fit()
    assert len(packing.pack_lengths(lengths, 10)) == fewest_by_force(lengths, 10) == len(only.held) - 1


@pytest.mark.parametrize(("pick", "saved"), [((700, 690, 680, 800, 650), 0.07), ((310, 420, 505, 610, 715, 820, 930, 1010), 0.004), (None, 0.004)])
def test_search_saves_bins_where_best_fit_loses(pick, saved):
    r = random.Random(1)
    lengths = [r.choice(pick) if pick else r.randint(200, 1100) for _ in range(2000)]
    only = packing.Bins(lengths, 2048)
    only.best_fit()
    squares = sum(f * f for f in only.fill)
    found = packing.Bins(lengths, 2048)
    found.best_fit()
    found.search()
    assert sum(f * f for f in found.fill) > squares
    assert all(sum(lengths[i] for i in own) == f <= 2048 for own, f in zip(found.held, found.fill))
    assert sorted(i for own in found.held for i in own) == list(range(2000))
    assert found.fewest() <= sum(map(bool, found.held)) <= (1 - saved) * len(only.held)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_few_pieces_need_hardly_more_bins_than_the_least(lengths):
    least = fewest_by_force(lengths, 20)
    assert least <= len(packing.pack_lengths(lengths, 20)) <= least + 1


def test_large_ids_beside_a_null_id(spark):
    rows = [(2 ** 60 + 1, 0, 0, 700, 1), (None, 0, 0, 500, 2), (2 ** 60 + 3, 0, 0, 800, 3), (None, 0, 0, 500, 2)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = packing.pack(pieces).collect()
    assert sorted((tuple(r)[:5] for r in packed), key=str) == sorted(rows, key=str)
    assert check_sequences(packed, 2048) == 2


def test_pieces_and_sequences(spark, awkward, nothing):
    tokenizer = Tokenizer.from_file(JSON)
    pieces = packing.tokenise(awkward, RANKS, public_tokenizers.PATTERN, SPECIAL, most=64)
    want = []
    for r in awkward.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r.doc_id or -1, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 64))]
    got = [(r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in pieces.collect()]
    assert sorted(got) == sorted(want)
    packed = packing.pack(pieces, most=64, group=4).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)
    check_sequences(packed, 64)
    assert packing.pack(packing.tokenise(nothing, RANKS, public_tokenizers.PATTERN, SPECIAL)).count() == 0


def check_sequences(packed, most):
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_groups_meet_again(spark):
    random.seed(5)
    rows = [(i, 0, 0, random.randint(200, 1100), i) for i in range(900)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = packing.pack(pieces, group=64).collect()
    assert len(packed) == 900
    assert check_sequences(packed, 2048) <= 1.02 * -(-sum(r[3] for r in rows) // 2048)
