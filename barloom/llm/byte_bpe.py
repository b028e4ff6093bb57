"""Byte-level BPE encoding and decoding with a rank queue of hierarchical bitmaps.

The queue has one bucket per merge rank, holding linked-list positions. Three
levels of 64-bit words say which buckets are filled, so finding the lowest rank
is three find-first-set steps however long the pre-token is. Entries whose pair
has changed since they were put in are skipped when they come up. All positions of a
bucket are merged together, in arrays.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import regex
from pyspark.sql import DataFrame

from barloom.llm.base import map_batches, prepared, small_groups

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Bytes of a Python worker's memory, and about what an entry has besides its texts.
REMEMBERED_BYTES = 48_000_000
ENTRY_BYTES = 200
# Characters whose pre-tokens are merged at once.
AT_ONCE = 2_000_000
LONGEST_REMEMBERED = 64


class RankQueue:
    """Positions by rank; `pop` gives a position of the lowest rank, first in first out."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        word, block = rank >> 6, rank >> 12
        self.low[word] = self.low.get(word, 0) | 1 << (rank & 63)
        self.middle[block] = self.middle.get(block, 0) | 1 << (word & 63)
        self.top |= 1 << block

    def fill(self, rank: int, positions: list[int]) -> None:
        """Many positions at once, of a rank that has none yet."""
        self.push(rank, positions[0])
        self.buckets[rank] = positions

    def take_bucket(self) -> tuple[int, list[int]] | None:
        """The lowest rank and all its positions, which leave the queue."""
        if not self.top:
            return None
        block = (self.top & -self.top).bit_length() - 1
        bits = self.middle[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        first = bits & -bits
        rank = (word << 6) + first.bit_length() - 1
        self.low[word] = bits ^ first
        if bits == first:
            self.middle[block] ^= 1 << (word & 63)
            if not self.middle[block]:
                self.top ^= 1 << block
        return rank, self.buckets.pop(rank)


class Memory:
    """Ids of texts that came up lately, in decimal. It has two generations of half its bytes
    each: what has not come up during a whole one is forgotten."""

    def __init__(self, size: int = REMEMBERED_BYTES):
        self.half, self.held = size // 2, 0
        self.recent: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def known(self, texts: set[str]) -> dict[str, str]:
        recent, older = self.recent, self.older
        return {t: i for t in texts if (i := recent.get(t) or older.get(t))}

    def keep(self, ids: dict[str, str]) -> None:
        """Remembers texts with their ids; those known already stay for another generation."""
        recent = self.recent
        for text, own in ids.items():
            if text not in recent and len(text) <= LONGEST_REMEMBERED:
                recent[text] = own
                self.held += ENTRY_BYTES + len(text) + len(own)
                if self.held > self.half:
                    self.recent, self.older, self.held = {}, recent, 0
                    recent = self.recent


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        if len(self.bytes_of) != len(ranks):
            raise ValueError("two tokens share a rank")
        self.by_decimal = {str(rank): token for rank, token in self.bytes_of.items()}
        self.decimal = {rank: text for text, rank in zip(self.by_decimal, self.bytes_of, strict=True)}
        # what stands between pre-tokens: an id that no token has
        self.gap = max(self.bytes_of) + 1
        self.shift = self.gap.bit_length()
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # every pair of tokens that merges, in order, and the rank of what it merges to
        merges = {
            left << self.shift | right: rank
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
        }
        # the last entry is above all pairs
        pairs = np.array([*merges, 1 << 62], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.pair_ranks = np.array([*merges.values(), -1], dtype=np.int64)[order]
        self.pieces = Memory()

    @classmethod
    def load(cls, content: bytes, pattern: str) -> ByteBPE:
        """From the lines `base64 rank` of a rank file."""
        ranks = {}
        for line in content.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        return cls(ranks, pattern)

    def _pair_ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The ranks of neighbours' merges, -1 where they never merge."""
        at = self.pairs.searchsorted(pairs)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[str]:
        """Token ids of each pre-token, in decimal, joined by spaces. All of them lie in one
        linked list with gaps between them and share one queue: a bucket serves them all."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1
        gaps = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.single[np.frombuffer(b"\0".join([b"", *pieces, b""]), dtype=np.uint8)]
        ids[gaps] = self.gap
        n = len(ids)
        wanted = np.full(n, -1, dtype=np.int64)  # the rank of a position's pair in the queue
        wanted[:-1] = self._pair_ranks(ids[:-1] << self.shift | ids[1:])
        before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
        queue = RankQueue()
        push, filled = queue.push, queue.buckets.get
        found_at = np.flatnonzero(wanted >= 0)
        order = found_at[np.argsort(wanted[found_at], kind="stable")]
        edges = np.flatnonzero(np.diff(wanted[order])) + 1
        for at in np.split(order, edges) if len(order) else ():
            queue.fill(int(wanted[at[0]]), at.tolist())
        while (found := queue.take_bucket()) is not None:
            merged = found[0]
            at = np.array(found[1], dtype=np.int64)
            at = at[wanted[at] == merged]  # others are stale: the pair was taken or has changed
            if not len(at):
                continue
            at.sort()  # leftmost first among equals
            own, joined, ranks = self._beside(at, merged, ids, before, after)
            # a rank of -1 is above all as an unsigned number
            low = ranks.view(np.uint64) < merged
            if low.any():
                # a lower rank comes up: what is right of it in the same pre-token waits
                lower = own[low[: len(own)] | low[len(own) :]]
                first = np.full(len(gaps), n)
                np.minimum.at(first, np.searchsorted(gaps, lower), lower)
                now = at <= first[np.searchsorted(gaps, at)]
                for i in at[~now].tolist():
                    push(merged, i)
                own, joined, ranks = self._beside(at[now], merged, ids, before, after)
            taken = after[own]
            following = after[taken]
            ids[own] = merged
            ids[taken] = -1
            wanted[taken] = -1
            after[own] = following
            before[following] = own
            lefts = before[own]
            if joined is not None:
                # two merged ones side by side are a pair that the left one has
                side = np.flatnonzero(joined)
                ranks[len(own) + side - 1] = ranks[side]
                apart = np.concatenate([~joined, np.ones(len(own), dtype=bool)])
                changed = np.concatenate([lefts, own])[apart]
                ranks = ranks[apart]
            else:
                changed = np.concatenate([lefts, own])
            wanted[changed] = ranks
            new = ranks >= 0
            for rank, i in zip(ranks[new].tolist(), changed[new].tolist(), strict=True):
                if bucket := filled(rank):
                    bucket.append(i)
                else:
                    push(rank, i)
        left = (ids >= 0) & (ids != self.gap)
        texts = list(map(self.decimal.__getitem__, ids[left].tolist()))
        bounds = np.cumsum(left)[gaps].tolist()
        return [" ".join(texts[a:b]) for a, b in pairwise(bounds)]

    def _beside(self, at, merged: int, ids, before, after) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Of positions with the same pair, in order: those that merge, leftmost first; which of
        them follow the one before directly, None if none does; and the ranks of the pairs that
        each has with its left and then its right neighbour when it has merged and what is
        right of it has not."""
        taken = after[at]
        over = taken[:-1] == at[1:]
        if over.any():
            # of pairs that overlap, every other one is left over
            number = np.arange(len(at))
            start = np.maximum.accumulate(np.where(np.concatenate([[False], over]), 0, number))
            at = at[(number - start) & 1 == 0]
            taken = after[at]
        previous = before[at]
        left, joined = ids[previous], None
        follows = taken[:-1] == previous[1:]
        if follows.any():
            joined = np.concatenate([[False], follows])
            left[joined] = merged
        right = ids[after[taken]]
        return at, joined, self._pair_ranks(np.concatenate([left << self.shift | merged, right | merged << self.shift]))

    def _learn(self, new: set[str]) -> dict[str, str]:
        """Pre-tokens -> their ids in decimal, joined by spaces."""
        coded = {p: p.encode() for p in new}
        text = {p: str(rank) for p, b in coded.items() if (rank := self.ranks.get(b)) is not None}
        rest = [p for p in new if p not in text]
        text.update(zip(rest, self.merge([coded[p] for p in rest]), strict=True))
        return text

    def _ids_texts(self, texts: list[str]) -> Iterator[str]:
        """The ids of each text in decimal, joined by spaces."""
        cut = [self.pattern.findall(t) for t in texts]
        wanted = set().union(*cut)
        kept = self.pieces.known(wanted)
        kept |= self._learn(wanted.difference(kept))
        for pieces in cut:
            yield " ".join(map(kept.__getitem__, pieces))
        self.pieces.keep(kept)

    def digests(self, texts: list[str]) -> Iterator[tuple[list[str], str, str]]:
        """Ids in decimal, SHA-256 of their joined text, SHA-256 of the bytes they decode to."""
        for group in small_groups(texts, AT_ONCE):
            for text in self._ids_texts(group):
                ids = text.split(" ") if text else []
                yield (
                    ids,
                    hashlib.sha256(text.encode()).hexdigest(),
                    hashlib.sha256(b"".join(map(self.by_decimal.__getitem__, ids))).hexdigest(),
                )

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for group in small_groups(texts, AT_ONCE):
            for text in self._ids_texts(group):
                yield list(map(int, text.split(" "))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; an id outside the vocabulary is an error."""
        return b"".join([self.bytes_of[i] for i in ids])


_coders: dict[tuple[bytes, str], ByteBPE] = {}


def coder(content: bytes, pattern: str) -> ByteBPE:
    """One per Python worker and vocabulary, so that remembered pre-tokens serve many tasks."""
    key = (hashlib.sha256(content).digest(), pattern)
    if key not in _coders:
        _coders[key] = ByteBPE.load(content, pattern)
    return _coders[key]


def read_ranks(documents: DataFrame, ranks_path: str):
    spark = prepared(documents.sparkSession)
    with open(ranks_path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())  # one vocabulary file, about 1 MB


def encode_texts(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of each whole text. NULL texts are empty and have no ids."""
    content = read_ranks(documents, ranks_path)

    def encode(columns: dict[str, list]) -> dict[str, list]:
        bpe = coder(content.value, pattern)
        return {
            "doc_id": columns["doc_id"],
            "ids": list(bpe.encode([t or "" for t in columns["text"]])),
        }

    return map_batches(documents.select("doc_id", "text"), encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of each row of ids. NULL ids decode to no bytes."""
    content = read_ranks(encoded, ranks_path)

    def decode(columns: dict[str, list]) -> dict[str, list]:
        bpe = coder(content.value, pattern)
        return {
            "doc_id": columns["doc_id"],
            "decoded": [bpe.decode(i or []) for i in columns["ids"]],
        }

    return map_batches(encoded.select("doc_id", "ids"), decode, "doc_id long, decoded binary")


def round_trip(
    documents: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False
) -> DataFrame:
    """Encodes and decodes every whole text: token count and digests, one row per input row,
    and the ids themselves if wanted.

    A NULL text is empty: 0 tokens and the digests of the empty string. A NULL
    doc_id stays NULL, repeated rows give repeated rows, other columns are ignored,
    an empty table gives no rows. A pre-token of any length takes time almost
    proportional to it.
    """
    content = read_ranks(documents, ranks_path)

    def encode(columns: dict[str, list]) -> dict[str, list]:
        bpe = coder(content.value, pattern)
        out: dict[str, list] = {"doc_id": columns["doc_id"], "n_tokens": [], "ids_sha256": []}
        out |= {"decoded_sha256": [], "ids": []}
        for ids, of_ids, of_bytes in bpe.digests([t or "" for t in columns["text"]]):
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(of_ids)
            out["decoded_sha256"].append(of_bytes)
            if with_ids:
                out["ids"].append(np.array(ids, dtype=np.int32))
        return out

    schema = SCHEMA + ", ids array<int>" if with_ids else SCHEMA
    return map_batches(documents.select("doc_id", "text"), encode, schema)
