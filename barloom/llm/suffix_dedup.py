"""Removal of bytes that repeat an earlier document, found with suffix arrays.

Every `LENGTH`-byte string has an anchor: the 24 bytes in it with the smallest hash.
Strings with the same anchor that start next to each other form a run, and equal
strings have equal anchors, so the runs of one anchor can be compared on their own:

1. Anchors that occur in two documents at least are found by hash and kept as a
   filter of bounded size; it lets others pass rarely, and loses none.
2. The different texts of such runs, each with the smallest doc_id that has it, meet
   by anchor. What all texts of an anchor agree on around it becomes one symbol; a
   suffix array over the rest tells, for every string, the smallest doc_id it
   occurs in. The texts of a hot anchor are first split by what stands around it.
3. These verdicts are joined with the runs of all documents. Runs of one hot text
   stay rows of a join, they are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import prepared
from barloom.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 50
ANCHOR = 24
SPARE = LENGTH - ANCHOR
WINDOW = SPARE + 1
# Bytes of short documents scanned together: intermediate arrays then stay small and in cache.
TOGETHER = 1 << 17
# Strings scanned at once; a longer text is scanned in pieces that overlap.
PIECE = 1 << 18
# Anchors a task remembers before it hands them on, and bytes of the texts they are in.
AT_ONCE = 1 << 20
BYTES_AT_ONCE = 1 << 25
# The filter's size at most, over all buckets.
FILTER_BITS = 1 << 29
# Each task hands on a piece per bucket: tasks x buckets grow with the square of the input, so
# buckets are as large as a task can hold. Up to FEW_BUCKETS they are smaller, for more tasks.
KEYS_PER_BUCKET = 1 << 19
FEW_BUCKETS = 8
FEW_KEYS_PER_BUCKET = 1 << 16
# Of what is shuffled in pieces; the scattered short texts are most of it.
CODEC = "zstd"
# Texts in one suffix array; an anchor with more of them is split.
MOST_TEXTS = 256
NO_ID = (1 << 63) - 1  # a document without doc_id comes after all others

_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 21) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_STEP, n, 1 << 64))


_POWERS = np.full(PIECE + LENGTH + 1, _STEP, dtype=np.uint64)
_POWERS[0] = 1
np.multiply.accumulate(_POWERS, out=_POWERS)
_INVERSES = np.full(PIECE + LENGTH + 1, pow(_STEP, -1, 1 << 64), dtype=np.uint64)
_INVERSES[0] = 1
np.multiply.accumulate(_INVERSES, out=_INVERSES)


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position on, by doubling 1, 2, 4, 8, 16, 24."""
    h = data.astype(np.uint64) + np.uint64(1)
    eight = h
    for width in (1, 2, 4):
        eight = eight[:-width] * _power(width) + eight[width:]
    sixteen = eight[:-8] * _power(8) + eight[8:]
    return _mixed(sixteen[:-8] * _power(8) + eight[16:])


def _key(hashes: np.ndarray) -> np.ndarray:
    """Smallest hashes are small numbers: mixed again, they spread evenly over buckets."""
    return _mixed(hashes + np.uint64(_STEP))


def _window_minima(values: np.ndarray) -> np.ndarray:
    least, width = values, 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOW - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last string start, anchor position and anchor hash of each run.

    `data` holds documents one after another up to `ends`; no string crosses an end.
    At most PIECE strings at a time.
    """
    if len(data) < LENGTH:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
    hashes = _anchor_hashes(data)
    places = np.arange(len(hashes), dtype=np.uint64)
    anchor = (_window_minima(hashes & ~_LOW | places) & _LOW).astype(np.int64)
    inside = np.ones(len(anchor), dtype=bool)
    for end in ends.tolist():
        inside[max(0, end - LENGTH + 1) : end] = False
    change = np.ones(len(anchor) + 1, dtype=bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change[:-1] & inside)
    last = np.flatnonzero(change[1:] & inside)
    at = anchor[first]
    return first, last, at, _key(hashes[at])


class Scanner:
    """Cuts batches of documents into pieces and finds their runs."""

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Data, and per run: first, last, anchor position, hash, document number, and the
        run's start within its document."""
        group, size, number = [], 0, 0
        for i, text in enumerate(texts):
            if len(text) > TOGETHER:
                for start in range(0, len(text) - LENGTH + 1, PIECE):
                    part = text[start : start + PIECE + LENGTH - 1]
                    yield self._found([part], np.array([i]), start)
                continue
            group.append((i, text))
            size += len(text)
            if size > TOGETHER:
                yield self._found([t for _, t in group], np.array([n for n, _ in group]))
                group, size = [], 0
        if group:
            yield self._found([t for _, t in group], np.array([n for n, _ in group]))

    def _found(self, parts: list[bytes], numbers: np.ndarray, offset: int = 0):
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        first, last, at, keys = runs(data, ends)
        part = np.searchsorted(ends, first, side="right")
        begins = np.concatenate([[0], ends[:-1]])
        return data, first, last, at, keys, numbers[part], first - begins[part] + offset


def content_classes(data: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit identity of each run's text and of where its anchor lies in it."""
    powers = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(data)])])
    body = (powers[last + LENGTH] - powers[first]) * _INVERSES[first]
    shape = ((last - first) * 64 + (at - first)).astype(np.uint64)
    return _mixed(body ^ _mixed(shape + np.uint64(1)))


class Filter:
    """Which anchors occur in two documents: two bits per anchor in its bucket's segment."""

    def __init__(self, bucket_bits: int, segment_bits: int, words: np.ndarray | None = None):
        self.bucket_bits, self.segment_bits, self.words = bucket_bits, segment_bits, words

    @classmethod
    def sized(cls, total_bytes: int) -> Filter:
        anchors = max(1, total_bytes // (WINDOW // 2))
        few = min(FEW_BUCKETS, (anchors // FEW_KEYS_PER_BUCKET).bit_length())
        bucket_bits = min(20, max(4, few, (anchors // KEYS_PER_BUCKET).bit_length()))
        bits = min(FILTER_BITS, 4 * anchors)
        return cls(bucket_bits, max(6, (bits >> bucket_bits).bit_length() - 1))

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bucket_bits)).astype(np.int64)

    def low(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(32 - self.bucket_bits)).astype(np.uint32)

    def places(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint32(32 - self.segment_bits)
        return low >> shift, (low * np.uint32(0x9E3779B1)) >> shift

    def segment(self, low: np.ndarray) -> bytes:
        bits = np.zeros(1 << self.segment_bits, dtype=bool)
        for places in self.places(low):
            bits[places] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def holds(self, keys: np.ndarray) -> np.ndarray:
        base = self.bucket(keys) << self.segment_bits
        found = np.ones(len(keys), dtype=bool)
        for places in self.places(self.low(keys)):
            bit = base + places.astype(np.int64)
            found &= (self.words[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        return found


def _utf8(values: pa.Array) -> list[bytes]:
    return [b or b"" for b in values.cast(pa.binary()).to_pylist()]


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket, from, to for each stretch of equal sorted buckets."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    starts = np.concatenate([[0], cuts]) if len(buckets) else []
    ends = np.concatenate([cuts, [len(buckets)]])
    for a, b in zip(starts, ends, strict=False):
        yield int(buckets[a]), int(a), int(b)


def shared_anchors(rows: DataFrame, shape: Filter) -> Filter:
    """The filter of anchors of at least two documents; `rows` has doc, row and text."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, keys, docs, seen = Scanner(), [], [], 0
        codec = pa.Codec(CODEC)

        def flush() -> pa.RecordBatch:
            key = np.concatenate(keys)
            doc = np.concatenate(docs)
            # the bits that are kept of a key: its bucket and 32 more
            key >>= np.uint64(32 - shape.bucket_bits)
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            # an anchor of several documents is said twice
            each = np.repeat(key[first], 1 + several)
            found = list(_by_bucket((each >> np.uint64(32)).astype(np.int64)))
            low = (each & np.uint64(0xFFFFFFFF)).astype("<u4")
            # sorted, so differences are small; bytes of equal weight stand together
            steps = [np.diff(low[i:j], prepend=np.uint32(0)) for _, i, j in found]
            planes = [codec.compress(x.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True) for x in steps]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in found], pa.int64()),
                    pa.array([j - i for _, i, j in found], pa.int32()),
                    pa.array(planes, pa.binary()),
                ],
                names=["bucket", "n", "low"],
            )

        for batch in batches:
            doc_ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for _, _, _, _, key, number, _ in scanner.pieces(_utf8(batch.column("text"))):
                keys.append(key)
                docs.append(doc_ids[number])
                seen += len(key)
                if seen > AT_ONCE:
                    yield flush()
                    keys, docs, seen = [], [], 0
        if seen:
            yield flush()

    def segment(table: pa.Table) -> pa.Table:
        codec, lows = pa.Codec(CODEC), []
        for n, packed in zip(table.column("n").to_pylist(), table.column("low").to_pylist(), strict=True):
            planes = np.frombuffer(codec.decompress(packed, 4 * n), np.uint8).reshape(4, n)
            lows.append(np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32))
        low = np.concatenate(lows)
        low.sort()
        shared = low[1:][low[1:] == low[:-1]]
        return pa.table({"bucket": table.column("bucket")[:1], "bits": pa.array([shape.segment(shared)])})

    segments = (
        rows.mapInArrow(anchors, "bucket long, n int, low binary")
        .groupBy("bucket")
        .applyInArrow(segment, "bucket long, bits binary")
        .collect()  # FILTER_BITS at most
    )
    words = np.zeros(1 << (shape.bucket_bits + shape.segment_bits - 3), dtype=np.uint8)
    size = 1 << (shape.segment_bits - 3)
    for row in segments:
        words[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Filter(shape.bucket_bits, shape.segment_bits, words)


TEXTS = "bucket long, n int, size int, packed binary"


def _run_texts(rows: DataFrame, shared) -> DataFrame:
    """Per bucket the different run texts a task has met, with their smallest and largest doc."""

    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, codec = Scanner(), pa.Codec(CODEC)
        found: list[list] = [[] for _ in range(6)]
        pieces: list[np.ndarray] = []
        seen = kept_runs = 0

        def flush() -> pa.RecordBatch:
            key, cls, doc, offset, size, start = (np.concatenate(c) for c in found)
            joined = np.concatenate(pieces)
            order = np.lexsort((cls, key))
            key, cls, doc = key[order], cls[order], doc[order]
            one = np.flatnonzero(np.concatenate([[True], (cls[1:] != cls[:-1]) | (key[1:] != key[:-1])]))
            low, high = np.minimum.reduceat(doc, one), np.maximum.reduceat(doc, one)
            key, pick = key[one], order[one]
            size, start = size[pick].astype(np.int64), start[pick]
            shapes = np.stack([offset[pick], size.astype(np.uint8)], axis=1)
            out = []
            for b, i, j in _by_bucket(shared.value.bucket(key)):
                begin = np.cumsum(size[i:j]) - size[i:j]
                index = np.repeat(start[i:j] - begin, size[i:j]) + np.arange(int(size[i:j].sum()))
                columns = (shapes[i:j], low[i:j], high[i:j] - low[i:j], joined[index])
                raw = b"".join(c.tobytes() for c in columns)
                out.append((b, j - i, len(raw), codec.compress(raw, asbytes=True)))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                names=["bucket", "n", "size", "packed"],
            )

        for batch in batches:
            doc_ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for data, first, last, at, key, number, _ in scanner.pieces(_utf8(batch.column("text"))):
                kept = np.flatnonzero(shared.value.holds(key))
                if not len(kept):
                    continue
                first, last, at, key = first[kept], last[kept], at[kept], key[kept]
                classes = content_classes(data, first, last, at) ^ _mixed(key)
                shape = ((at - first).astype(np.uint8), (last - first + LENGTH).astype(np.uint8))
                # where the text stands in the joined pieces
                values = (key, classes, doc_ids[number[kept]], *shape, first + seen)
                for column, value in zip(found, values, strict=True):
                    column.append(value)
                pieces.append(data)
                seen += len(data)
                kept_runs += len(kept)
                if seen > BYTES_AT_ONCE or kept_runs > AT_ONCE:
                    yield flush()
                    found, pieces, seen, kept_runs = [[] for _ in range(6)], [], 0, 0
        if kept_runs:
            yield flush()

    return rows.mapInArrow(collect, TEXTS)


def anchor_verdicts(
    texts: list[bytes], offsets: list[int], owners: list[int]
) -> list[list[tuple[int, int, int]]]:
    """For the run texts of one anchor: spans (from, to, owner) of string starts in each text,
    `owner` being the smallest owner of a text that has the same string.

    `offsets` says where the anchor lies in each text. What all texts have in common
    around it is one symbol, so the suffix array is over what differs and that symbol.
    Two texts share nothing but that symbol's strings. Texts that are too many for one
    suffix array are split.
    """
    if len(texts) > MOST_TEXTS:
        return _split_verdicts(texts, offsets, owners)
    left = min(offsets)
    right = min(len(t) - o for t, o in zip(texts, offsets, strict=True))
    a, o = texts[0], offsets[0]
    for other, at in zip(texts[1:], offsets[1:], strict=True):
        while a[o - left : o] != other[at - left : at]:
            left -= 1
        if a[o : o + right] != other[at : at + right]:
            right = next(i for i in range(right) if a[o + i] != other[at + i])
    core = left + right
    owner = [[own] * (len(t) - LENGTH + 1) for t, own in zip(texts, owners, strict=True)]
    if len(texts) <= 2:
        strings, least = max(0, core - LENGTH + 1), min(owners)
        for own, at in zip(owner, offsets, strict=True):
            own[at - left : at - left + strings] = [least] * strings
        return [_stretches(own) for own in owner]
    # separators 0.. differ, so no common prefix crosses one; then bytes, then the common symbol
    many = len(texts)
    symbol = many + 256
    string: list[int] = []
    text_of: list[int] = []
    place_of: list[int] = []
    for number, (text, at) in enumerate(zip(texts, offsets, strict=True)):
        before = at - left
        string += [many + b for b in text[:before]]
        string.append(symbol)
        string += [many + b for b in text[at + right :]]
        string.append(number)
        text_of += [number] * (len(string) - len(text_of))
        place_of += range(len(string) - len(place_of))
    order = suffix_array(string)
    common = common_prefixes(string, order)

    group: list[tuple[int, int]] = []

    def settle() -> None:
        if len(group) > 1:
            least = min(owners[number] for number, _ in group)
            for number, start in group:
                owner[number][start] = least

    # strings that start before the common symbol: LENGTH bytes reach this many symbols
    for rank, suffix in enumerate(order):
        number, place = text_of[suffix], place_of[suffix]
        before = offsets[number] - left
        if place >= before or place >= len(owner[number]):
            continue
        needed = before - place + 1 + max(0, LENGTH - (before - place) - core)
        if not group or common[rank] < needed or order[rank - 1] != last:
            settle()
            group = []
        group.append((number, place))
        last = suffix
    settle()
    # strings that start within it: the common symbol's suffixes, for each offset into it
    inner = [(rank, text_of[s]) for rank, s in enumerate(order) if string[s] == symbol]
    for into in range(left + 1):
        needed = 1 + max(0, LENGTH - core + into)
        group = []
        for rank, number in inner:
            start = offsets[number] - left + into
            if group and common[rank] < needed:
                settle()
                group = []
            if start < len(owner[number]):
                group.append((number, start))
        settle()
    return [_stretches(own) for own in owner]


def _stretches(own: list[int]) -> list[tuple[int, int, int]]:
    """(from, to, value) of each stretch of equal values."""
    cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1])]
    return [(a, b, own[a]) for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True)]


def _split_verdicts(
    texts: list[bytes], offsets: list[int], owners: list[int]
) -> list[list[tuple[int, int, int]]]:
    """As `anchor_verdicts`, for many texts.

    Strings with `low` to `high` bytes before the anchor have `low` bytes before it and
    SPARE - `high` after its end in common if they are equal. Texts are grouped by these;
    a group that is still too large is grouped anew for either half of `low` to `high`.
    """
    owner = [[own] * (len(t) - LENGTH + 1) for t, own in zip(texts, owners, strict=True)]
    work: list[tuple[int, int, list[int]]] = [(0, SPARE, list(range(len(texts))))]
    while work:
        low, high, members = work.pop()
        groups: dict[bytes, list[int]] = {}
        for i in members:
            at = offsets[i]
            if at >= low and at + LENGTH - high <= len(texts[i]):
                groups.setdefault(texts[i][at - low : at + LENGTH - high], []).append(i)
        for group in groups.values():
            if len(group) == 1:
                continue
            if low == high:  # one string each, and it is the same
                least = min(owners[i] for i in group)
                for i in group:
                    owner[i][offsets[i] - low] = least
                continue
            # the strings in question and no others
            cut: dict[tuple[bytes, int], list[int]] = {}
            for i in group:
                at = offsets[i]
                before = min(at, high)
                cut.setdefault((texts[i][at - before : at + LENGTH - low], before), []).append(i)
            if len(cut) > MOST_TEXTS:
                middle = (low + high) // 2
                work += [(low, middle, group), (middle + 1, high, group)]
                continue
            least_of = [min(owners[i] for i in same) for same in cut.values()]
            found = anchor_verdicts([t for t, _ in cut], [before for _, before in cut], least_of)
            for (_, before), same, parts in zip(cut, cut.values(), found, strict=True):
                for i in same:
                    begin = offsets[i] - before
                    for a, b, least in parts:
                        owner[i][begin + a : begin + b] = [least] * (b - a)
    return [_stretches(own) for own in owner]


VERDICTS = "class long, begins int, ends int, owner long"


# Of two equal strings around an anchor, so many bytes are equal before or after it at least.
HALF = SPARE // 2


def _identified(data: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash and class of run texts that stand one after another, and hashes of the
    anchor with HALF bytes before and with HALF bytes after it, 0 if there are fewer.

    They follow from the texts, so they are computed again, not sent.
    """
    found: list[list[np.ndarray]] = [[] for _ in range(4)]
    ends = np.cumsum(shapes[:, 1])
    at_once = PIECE // 256  # of texts of less than 128 bytes
    for i in range(0, len(shapes), at_once):
        offsets, sizes = shapes[i : i + at_once, 0], shapes[i : i + at_once, 1]
        first = ends[i : i + at_once] - sizes
        part = data[first[0] : first[-1] + sizes[-1]]
        first = first - first[0]
        at = first + offsets
        keys = _key(_anchor_hashes(part)[at])
        last = first + sizes - LENGTH
        classes = content_classes(part, first, last, at) ^ _mixed(keys)
        # such a piece looks like a run of one string with its anchor in front or at its end
        beside = np.zeros((2, len(at)), np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(part)])])
        for side, begin, enough in (
            (0, at - HALF, offsets >= HALF),
            (1, at, sizes - offsets >= ANCHOR + HALF),
        ):
            begin = begin[enough]
            body = (sums[begin + ANCHOR + HALF] - sums[begin]) * _INVERSES[begin]
            beside[side, enough] = _mixed(body ^ np.uint64(side + 1)) | np.uint64(1)
        for column, value in zip(found, (keys, classes, *beside), strict=True):
            column.append(value)
    return tuple(np.concatenate(c) for c in found)


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Which hashes are there twice; 0 is none."""
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    found = np.zeros(len(hashes), bool)
    found[order[1:]] = same
    found[order[:-1]] |= same
    return found & (hashes != 0)


def _bucket_verdicts(table: pa.Table) -> pa.Table:
    """Verdicts on all run texts of one bucket of anchors."""

    codec = pa.Codec(CODEC)
    columns: list[list[np.ndarray]] = [[] for _ in range(3)]
    blobs: list[bytes] = []
    for n, size, packed in zip(*(table.column(c).to_pylist() for c in ("n", "size", "packed")), strict=True):
        raw = codec.decompress(packed, size, asbytes=True)
        columns[0].append(np.frombuffer(raw, np.uint8, 2 * n).reshape(-1, 2))
        columns[1].append(np.frombuffer(raw, np.int64, n, 2 * n))
        columns[2].append(np.frombuffer(raw, np.int64, n, 10 * n))
        blobs.append(raw[18 * n :])
    shapes, low, high = (np.concatenate(c) for c in columns)
    shapes = shapes.astype(np.int64)
    high += low
    blob = b"".join(blobs)
    del columns, blobs
    key, cls, before, after = _identified(np.frombuffer(blob, np.uint8), shapes)
    start = np.cumsum(shapes[:, 1]) - shapes[:, 1]
    order = np.lexsort((cls, key))
    key, cls, low, high = key[order], cls[order], low[order], high[order]
    one = np.flatnonzero(np.concatenate([[True], (cls[1:] != cls[:-1]) | (key[1:] != key[:-1])]))
    low, high = np.minimum.reduceat(low, one), np.maximum.reduceat(high, one)
    key, cls, pick = key[one], cls[one], order[one]
    starts, offsets, sizes = start[pick], shapes[pick, 0], shapes[pick, 1]

    # texts of one anchor that share a string share HALF bytes beside it, too
    sharing = _repeated(before[pick]) | _repeated(after[pick])
    # a text that shares none is all one symbol, owned by its smallest doc
    alone = np.flatnonzero(~sharing & (low < high))
    out_class, out_owner = [cls[alone]], [low[alone]]
    out_begin = [np.zeros(len(alone), np.int64)]
    out_end = [sizes[alone] - LENGTH + 1]
    meeting = np.flatnonzero(sharing)
    first = np.flatnonzero(np.diff(key[meeting], prepend=~key[meeting[:1]]))
    spans: list[list[int]] = [[], [], [], []]
    for a, n in zip(first.tolist(), np.diff(np.append(first, len(meeting))).tolist(), strict=True):
        of_anchor: dict[bytes, list[int]] = {}  # two anchors may share a hash
        for i in meeting[a : a + n].tolist():
            at = starts[i] + offsets[i]
            of_anchor.setdefault(blob[at : at + ANCHOR], []).append(i)
        for own in of_anchor.values():
            texts = [blob[starts[i] : starts[i] + sizes[i]] for i in own]
            found = anchor_verdicts(texts, offsets[own].tolist(), low[own].tolist())
            for i, top, parts in zip(own, high[own].tolist(), found, strict=True):
                for part in parts:
                    if part[2] < top:
                        for column, value in zip(spans, (i, *part), strict=True):
                            column.append(value)
    if spans[0]:
        i, x, y, o = (np.array(c, dtype=np.int64) for c in spans)
        out_class.append(cls[i])
        out_begin.append(x)
        out_end.append(y)
        out_owner.append(o)
    return pa.table(
        {
            "class": np.concatenate(out_class).view(np.int64),
            "begins": np.concatenate(out_begin).astype(np.int32),
            "ends": np.concatenate(out_end).astype(np.int32),
            "owner": np.concatenate(out_owner),
        }
    )


def _run_places(rows: DataFrame, shared) -> DataFrame:
    """(class, doc, row, start) of every run whose anchor the filter holds."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            doc_ids = batch.column("doc").to_numpy(zero_copy_only=False)
            row_ids = batch.column("row").to_numpy(zero_copy_only=False)
            for data, first, last, at, key, number, start in scanner.pieces(_utf8(batch.column("text"))):
                kept = np.flatnonzero(shared.value.holds(key))
                classes = content_classes(data, first[kept], last[kept], at[kept]) ^ _mixed(key[kept])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(classes.view(np.int64)),
                        pa.array(doc_ids[number[kept]]),
                        pa.array(row_ids[number[kept]]),
                        pa.array(start[kept].astype(np.int64)),
                    ],
                    names=["class", "doc", "row", "start"],
                )

    return rows.mapInArrow(collect, "class long, doc long, row int, start long")


def _identity(text: Column) -> Column:
    """Tells rows of one doc_id apart; 32 bits, as it travels with every run."""
    return F.hash(F.coalesce(text, F.lit("")))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc, row, spans): byte spans to remove per document that has any, overlapping, in
    order of their start, each as start x 256 + length. `doc` is doc_id or NO_ID, `row` a hash
    of the text, for rows that share a doc_id."""
    spark = prepared(documents.sparkSession)
    rows = documents.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), _identity(F.col("text")).alias("row"), "text"
    ).where(F.octet_length("text") >= LENGTH)
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(shared_anchors(rows, Filter.sized(total)))
    verdicts = (
        _run_texts(rows, shared).groupBy("bucket").applyInArrow(_bucket_verdicts, VERDICTS)
    )
    hits = (
        _run_places(rows, shared)
        .join(verdicts, "class")
        .where("owner < doc")
        .select(
            "doc",
            "row",
            # one number: where it starts, and in the low byte how long it is
            (
                (F.col("start") + F.col("begins")) * 256
                + (F.col("ends") - F.col("begins") + (LENGTH - 1))
            ).alias("span"),
        )
    )
    # a document's spans are bounded by its own length
    return hits.groupBy("doc", "row").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def _merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Disjoint (from, to) of spans as `repeated_spans` has them."""
    out: list[tuple[int, int]] = []
    for span in spans or []:
        begin, end = span >> 8, (span >> 8) + (span & 255)
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    begins = [0, *(b for _, b in removed)]
    ends = [*(a for a, _ in removed), len(text)]
    return b"".join(text[a:b] for a, b in zip(begins, ends, strict=True))


def _with_spans(documents: DataFrame) -> DataFrame:
    """(whole, spans): each row as a struct, so that no column of it can clash, and its spans."""
    spans = repeated_spans(documents).withColumnsRenamed({"doc": "of_doc", "row": "of_row"})
    rows = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("whole"),
        F.coalesce(documents["doc_id"], F.lit(NO_ID)).alias("doc"),
        _identity(documents["text"]).alias("row"),
    )
    same = (F.col("doc") == F.col("of_doc")) & (F.col("row") == F.col("of_row"))
    return rows.join(spans, same, "left").select("whole", "spans")


def repeated_bytes(documents: DataFrame) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every document, one row per input row.

    Removed is each byte that a 50-byte string covers which also starts in a document
    with a smaller doc_id. A NULL text is empty; a NULL doc_id counts as larger than
    all others; rows with one doc_id do not remove each other's bytes; an empty table
    gives no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            spans = batch.column("spans").to_pylist()
            whole = batch.column("whole")
            for text, own in zip(_utf8(whole.field("text")), spans, strict=True):
                removed = _merged(own)
                out.append(
                    (
                        len(text),
                        sum(b - a for a, b in removed),
                        len(removed),
                        hashlib.sha256(_kept(text, removed)).hexdigest(),
                    )
                )
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [whole.field("doc_id"), *arrays],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_spans(documents.select("doc_id", "text")).mapInArrow(digest, schema)


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without the bytes that repeat an earlier document.

    Bytes of a character that is cut are dropped with it, so that texts stay valid.
    A text that repeats nothing is unchanged; one that repeats altogether becomes
    empty, its row stays.
    """

    names = documents.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, spans = batch.column("whole"), batch.column("spans").to_pylist()
            texts = [
                None if text is None else _kept(text, _merged(own)).decode("utf-8", "ignore")
                for text, own in zip(
                    whole.field("text").cast(pa.binary()).to_pylist(), spans, strict=True
                )
            ]
            columns = [
                pa.array(texts, pa.string()) if name == "text" else whole.field(name) for name in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _with_spans(documents).mapInArrow(cut, documents.schema)
