"""Token counts and byte-level BPE against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import sys
import time

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from barloom.llm import byte_bpe, token_counts
from barloom.llm.queries import PIECES, RANKS

ALPHABET = "ab \n\t'é▁\0ñ日本😀1½²٣_-.,\x1c\x85 　s<>"


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def strings(rng, n):
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*made, "", " ", "  ", "\n", "a" * 3000, "the " * 3000, " " * 500, "<unk> <0x0A>"]


def test_segments_count_like_the_library(rng, pieces):
    with open(PIECES, "rb") as file:
        counter = token_counts.SegmentCounter(file.read())
    texts = strings(rng, 3000)
    assert counter.count(texts) == [len(pieces.encode(t)) for t in texts]


def test_memory_starts_anew(rng, pieces, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 100)
    with open(PIECES, "rb") as file:
        counter = token_counts.SegmentCounter(file.read())
    for _ in range(3):
        texts = strings(rng, 50)
        assert counter.count(texts) == [len(pieces.encode(t)) for t in texts]


def test_token_counts_of_odd_rows(odd, odd_rows, nothing, pieces):
    found = token_counts.token_counts(odd, PIECES, limit=100).collect()
    expected = []
    for doc_id, text in odd_rows:
        n = len(pieces.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts.token_counts(nothing, PIECES).count() == 0


def test_merges_like_the_library(rng, ranks, library):
    bpe = byte_bpe.ByteBPE(ranks, public_tokenizers.PATTERN)
    texts = strings(rng, 3000)
    assert list(bpe.encode(texts)) == [library.encode_ordinary(t) for t in texts]


def test_merge_order_where_a_lower_rank_comes_up_late():
    """`ab` merges last, `abc` and `bcd` have lower ranks: leftmost of the lowest is next."""
    singles = {bytes([b]): 1000 + b for b in range(256)}
    ranks = {**singles, b"ab": 9, b"abc": 2, b"cd": 7, b"aba": 5, b"bab": 3}
    bpe = byte_bpe.ByteBPE(ranks, r"[a-d]+")
    library = tiktoken.Encoding("own", pat_str=r"[a-d]+", mergeable_ranks=ranks, special_tokens={})
    texts = ["abababcdabc", "ababababab", "babab", "abcdabcd", "aabbccdd", "cdcdabab"]
    assert list(bpe.encode(texts)) == [library.encode_ordinary(t) for t in texts]


def test_merge_order_of_any_ranks(rng):
    """Merges of any order, also such whose parts merge later: leftmost of the lowest is next."""
    for _ in range(60):
        made = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(40)}
        made = [*made, *(bytes([b]) for b in range(256))]
        ranks = dict(zip(made, rng.sample(range(len(made)), len(made)), strict=True))
        bpe = byte_bpe.ByteBPE(ranks, r"[a-c]+|[^a-c]+")
        library = tiktoken.Encoding("own", pat_str=r"[a-c]+|[^a-c]+", mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choice("aaabc ") for _ in range(rng.randint(0, 60))) for _ in range(40)]
        assert list(bpe.encode(texts)) == [library.encode_ordinary(t) for t in texts]


def test_many_new_pre_tokens_are_merged_together(rng, ranks, library):
    bpe = byte_bpe.ByteBPE(ranks, public_tokenizers.PATTERN)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(16)) for _ in range(4000)]
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "c_call" else None)
    try:
        found = bpe.merge([w.encode() for w in words])
    finally:
        sys.setprofile(None)
    assert len(found) == len(words)
    assert len(calls) < 1.7 * sum(map(len, words))
    assert list(bpe.encode(words)) == [library.encode_ordinary(w) for w in words]


def test_a_long_pre_token_takes_linear_time(rng, ranks, library):
    bpe = byte_bpe.ByteBPE(ranks, public_tokenizers.PATTERN)
    text = "".join(rng.choice("abcde") for _ in range(100_000))
    begin = time.perf_counter()
    assert next(bpe.encode([text])) == library.encode_ordinary(text)
    assert time.perf_counter() - begin < 20


def test_queue_gives_ranks_in_order(rng):
    queue, pushed = byte_bpe.RankQueue(), []
    for _ in range(2000):
        rank = rng.randrange(60_000)
        queue.push(rank, len(pushed))
        pushed.append(rank)
    taken = []
    while (found := queue.take_bucket()) is not None:
        taken += [(found[0], p) for p in found[1]]
    assert taken == sorted((rank, p) for p, rank in enumerate(pushed))


def test_round_trip_of_odd_rows(odd, odd_rows, nothing, library):
    found = byte_bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    expected = []
    for doc_id, text in odd_rows:
        ids = library.encode_ordinary(text or "")
        of_ids = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        of_text = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc_id, len(ids), of_ids, of_text, ids))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert byte_bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_and_decode_apart(odd, odd_rows):
    ids = byte_bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_ids(ids, RANKS, public_tokenizers.PATTERN).collect()
    expected = [(doc_id, (text or "").encode()) for doc_id, text in odd_rows]
    assert sorted(((r[0], bytes(r[1])) for r in decoded), key=repr) == sorted(expected, key=repr)
