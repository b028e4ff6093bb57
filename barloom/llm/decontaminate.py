"""Benchmark passages in documents, found through pieces with at most one edit.

Items are cut into as many pieces as make sure that an item within its limit of edits has
a piece with at most one of them, wherever the edits are. Pieces are looked up in
documents by hashes that leave one character out; the pairs and fours of pieces around
what is found are compared bit-parallel, and what is left is verified with the exact edit
distance. No step loses an item that is within the limit.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import prepared, small_groups

SIMILARITY = 0.8
# Items of fewer characters count only if they are there exactly.
SEED = 14
# Characters of a piece at most; there may be fewer so that items have pieces enough.
LONGEST = 9
# Characters are told apart by their code modulo this, letters and digits of ASCII all of them.
SLOTS = 97
# Starts of windows of one item closer than this are one window; the verification spans both.
GRAIN = 4
# Parts compared at once, and characters of documents searched together: arrays stay in cache.
AT_ONCE = 8192
TOGETHER = 100_000
# Characters of items that are broadcast at once, in tables of about 160 bytes for each; a larger
# benchmark takes several scans.
BLOCK_CHARS = 500_000
LEAKS = "doc_id long, item_id long, distance int, similarity double, ends long"


@cache
def _alphabet() -> np.ndarray:
    """Lower-case letters, marks and digits by code point, a blank for everything else."""
    table = np.full(1 << 16, 32, dtype=np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if unicodedata.category(char)[0] in "LMN":
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def normalised(text: str) -> np.ndarray:
    """Code points of lower-case letters and digits with single blanks between words."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    mapped = _alphabet()[points & 0xFFFF]
    for i in np.nonzero(points > 0xFFFF)[0]:
        mapped[i] = points[i] if unicodedata.category(chr(points[i]))[0] in "LMN" else 32
    blank = mapped == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    out = mapped[keep]
    return out[: len(out) - 1] if len(out) and out[-1] == 32 else out


def within(pattern: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """Smallest edit distance of `pattern` to any part of `text`, and where the first such part
    ends; None above `most`. Bit-parallel, one machine word as long as the pattern."""
    m = len(pattern)
    at: dict[int, int] = {}
    for i, code in enumerate(pattern.tolist()):
        at[code] = at.get(code, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, code in enumerate(text.tolist(), 1):
        equal = at.get(code, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        up_h = down | (full & ~(horizontal | up))
        down_h = up & horizontal
        if up_h & high:
            score += 1
        elif down_h & high:
            score -= 1
        up_h = up_h << 1 & full
        down_h = down_h << 1 & full
        up = down_h | (full & ~(vertical | up_h))
        down = up_h & vertical
        if score < best:
            best, end = score, j
    return (best, end) if best <= most else None


_STEP = np.uint64(0x9E3779B97F4A7C15)


@cache
def _powers(base: int, count: int) -> np.ndarray:
    """base to the power of 0, 1, and so on, modulo 2**64."""
    out = np.full(count, base & (1 << 64) - 1, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Polynomial hashes of any stretch of a text, each from two running sums; all groups of
    pieces share them. A text has at most TOGETHER + 2 * LONGEST characters."""

    def __init__(self, codes: np.ndarray):
        self.one = codes.astype(np.uint64) + np.uint64(1)
        self.count = len(codes)
        inverse = _powers(pow(int(_STEP), -1, 1 << 64), TOGETHER + 2 * LONGEST + 1)
        self.powers = _powers(int(_STEP), TOGETHER + 2 * LONGEST + 1)
        # characters by falling powers, so that a rising one makes any stretch's sum its hash
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(self.one * inverse[: len(codes)], out=self.sums[1:])
        self.whole: dict[int, np.ndarray] = {}
        self.salted: dict[int, np.ndarray] = {}

    def everywhere(self, length: int) -> np.ndarray:
        """The hash of the `length` characters from each position on."""
        if length not in self.whole:
            starts = max(0, self.count - length + 1)
            sums = self.sums[length : length + starts] - self.sums[:starts]
            sums *= self.powers[length - 1 : length - 1 + starts]
            self.whole[length] = sums
        return self.whole[length]

    def everywhere_salted(self, length: int) -> np.ndarray:
        if length not in self.salted:
            self.salted[length] = _salted(self.everywhere(length), 0)
        return self.salted[length]


def _salted(hashes: np.ndarray, salt: int) -> np.ndarray:
    hashes = hashes + np.uint64(salt * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    return (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Bits:
    """A set of hashes, of which it lets others pass rarely and loses none."""

    def __init__(self, hashes: np.ndarray):
        width = min(25, max(12, int(16 * len(hashes) + 1).bit_length()))
        self.shift = np.uint64(64 - width)
        self.maybe = np.zeros(1 << width, dtype=bool)
        self.maybe[hashes >> self.shift] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return self.maybe[hashes >> self.shift]


class Pieces:
    """Pieces of one length, found in texts with at most one edit.

    One half of such a piece is there without edits; the other has a character replaced
    (a hash that leaves the place out), missing (the piece's hash without it) or too many
    (a hash of one more that leaves it out).
    """

    def __init__(self, pieces: np.ndarray):
        count, self.length = pieces.shape
        m, self.left = self.length, self.length // 2
        rows = pieces.astype(np.uint64) + np.uint64(1)
        powers = np.array([pow(int(_STEP), n, 1 << 64) for n in range(m + 1)], dtype=np.uint64)
        self.powers = powers
        total = lambda x: (x * powers[: x.shape[1]][::-1]).sum(axis=1, dtype=np.uint64)
        # the exact beginning before an edit's place, and the exact end after it
        self.begins = {n: Bits(_salted(total(rows[:, :n]), 0)) for n in range(self.left, m)}
        self.ends = {n: Bits(_salted(total(rows[:, -n:]), 0)) for n in range(m - self.left, m)}
        # a table for each way to edit, so that each stays in cache
        made: dict[int, list[np.ndarray]] = {}
        for j in range(m):
            blank, less = rows.copy(), np.delete(rows, j, axis=1)
            blank[:, j] = 0
            more = np.insert(rows, j, 0, axis=1)
            for salt, edited in ((self.replaced(j), blank), (self.missing(j), less), (self.extra(j), more)):
                made.setdefault(salt, []).append(_salted(total(edited), salt))
        self.tables = {}
        for salt, keys in made.items():
            number = np.tile(np.arange(count, dtype=np.int64), len(keys))
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            keys, number = keys[order], number[order]
            # of equal keys: where the next ones begin
            after = np.searchsorted(keys, keys, side="right")
            self.tables[salt] = keys, after, number, Bits(keys)

    def replaced(self, j: int) -> int:
        return 1 + j

    def missing(self, j: int) -> int:
        # without it, what is left says the rest: one look for all places of a half
        return 100 + (j >= self.left)

    def extra(self, j: int) -> int:
        return 200 + j

    def find(self, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every place where a piece is with at most one edit; a place may
        come more than once."""
        m, left, one = self.length, self.left, hashes.one
        starts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def look(at: np.ndarray, size: int, salt: int, place: int | None) -> None:
            at = at[np.searchsorted(at, 0) : np.searchsorted(at, hashes.count - size + 1)]
            if not len(at):
                return
            own = hashes.everywhere(size)[at]
            if place is not None:
                own -= one[at + place] * self.powers[size - 1 - place]
            own = _salted(own, salt)
            keys, after, piece, bits = self.tables[salt]
            few = np.flatnonzero(bits.holds(own))
            if not len(few):
                return
            own, at = own[few], at[few]
            low = np.searchsorted(keys, own)
            low[low == len(keys)] = 0
            hit = np.flatnonzero(keys[low] == own)
            low, at = low[hit], at[hit]
            many = after[low] - low
            entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            starts.append(np.repeat(at, many))
            numbers.append(piece[entry])

        # where an exact end of the first half's edits is, with room for what is looked up beyond
        ended = np.zeros(hashes.count + m + 2, dtype=bool)
        last = hashes.everywhere_salted(m - left)
        ended[: len(last)] = self.ends[m - left].holds(last)
        # edits in the second half: the beginning is exact up to their place, so fewer and fewer
        most = max(0, hashes.count - m + 2)
        own, salted = hashes.everywhere(left)[:most], hashes.everywhere_salted(left)[:most]
        at = np.arange(len(own))
        for j in range(left, m):
            some = np.flatnonzero(self.begins[j].holds(_salted(own, 0) if salted is None else salted))
            at, own, salted = at[some], own[some], None
            look(at, m, self.replaced(j), j)
            # what follows one too many at the half is an exact end
            look(at[ended[at + j + 1]] if j == left else at, m + 1, self.extra(j), j)
            if j == left:
                look(at, m - 1, self.missing(left), None)
            if j < m - 1:
                own = own * _STEP + one[at + j]
        # edits in the first half: likewise from the end
        at = np.flatnonzero(ended)
        own = hashes.everywhere(m - left)[at]
        for j in range(left - 1, -1, -1):
            n = m - 1 - j
            if j < left - 1:
                some = np.flatnonzero(self.ends[n].holds(_salted(own, 0)))
                at, own = at[some], own[some]
                # one too many before an end that is exact from there on
                look(at - j - 2, m + 1, self.extra(j + 1), j + 1)
            look(at - j - 1, m, self.replaced(j), j)
            if j == left - 1:
                look(at - j, m - 1, self.missing(0), None)
            some = np.flatnonzero(at > 0)
            at = at[some] - 1
            own = own[some] + one[at] * self.powers[n]
        return np.concatenate(starts), np.concatenate(numbers)


class Parts:
    """Stretches of items, each with the edits it may have; 64 characters are one word."""

    def __init__(self, strings: list[np.ndarray], most: list[int]):
        self.sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.most = np.array(most, dtype=np.int64)
        # words of all stretches one after another
        self.first = np.cumsum([0, *((len(s) + 63) // 64 for s in strings)])
        short = int(self.sizes.max(initial=0)) <= 32  # then half a word is enough, and faster
        self.word, self.signed = (np.uint32, np.int32) if short else (np.uint64, np.int64)
        self.masks = np.zeros((int(self.first[-1]), SLOTS), dtype=self.word)
        for row, codes in zip(self.first.tolist(), strings, strict=False):
            place = np.arange(len(codes), dtype=np.uint64)
            bits = (np.uint64(1) << (place & np.uint64(63))).astype(self.word)
            np.bitwise_or.at(self.masks, (row + (place >> np.uint64(6)).astype(np.int64), codes % SLOTS), bits)

    def near(self, part: np.ndarray, begin: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether the part is within its edits somewhere in the text from `begin`, of which
        it reads the part's size and twice its edits. Characters that share a slot are taken
        for equal, so it may say yes too often, never no."""
        out = np.zeros(len(part), dtype=bool)
        if not len(part):
            return out
        before = max(0, -int(begin.min()))
        after = max(0, int((begin + self.sizes[part] + 2 * self.most[part]).max()) - len(slots))
        slots = np.pad(slots, (before, after + int(self.sizes.max() + 2 * self.most.max())), constant_values=32)
        begin = begin + before
        order = np.argsort(self.sizes[part], kind="stable")
        for first in range(0, len(part), AT_ONCE):
            own = order[first : first + AT_ONCE]
            out[own] = self._near(part[own], begin[own], slots)
        return out

    def _near(self, part: np.ndarray, begin: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Bit-parallel as in `within`, over several words: what a word's last row gains or
        loses goes on to the next."""
        size, most = self.sizes[part], self.most[part]
        one = self.word(1)
        words = int((size.max() + 63) // 64)
        up = [np.full(len(part), ~self.word(0)) for _ in range(words)]
        down = [np.zeros(len(part), dtype=self.word) for _ in range(words)]
        flat = self.masks.ravel()
        final = (size - 1) // 64
        ends = [final == w for w in range(words)]
        last = [np.where(final == w, (size - 1) % 64, 63).astype(self.word) for w in range(words)]
        rows = [np.minimum(self.first[part] + w, len(self.masks) - 1) * SLOTS for w in range(words)]
        score, best = size.astype(self.signed), size.astype(self.signed)
        reach = size + 2 * most
        least = int(reach.min())
        place = begin.copy()
        for step in range(int(reach.max())):
            met = slots[place]
            place += 1
            gain = loss = None
            for w in range(words):
                equal = flat[rows[w] + met]
                vertical = equal | down[w]
                if w:
                    equal |= loss
                down_h = equal & up[w]
                down_h += up[w]
                down_h ^= up[w]
                down_h |= equal
                up_h = down_h | up[w]
                np.invert(up_h, out=up_h)
                up_h |= down[w]
                down_h &= up[w]
                more, less = up_h >> last[w], down_h >> last[w]
                more &= one
                less &= one
                change = more.view(self.signed) - less.view(self.signed)
                score += change if words == 1 else change * ends[w]
                up_h <<= one
                down_h <<= one
                if w:
                    up_h |= gain
                    down_h |= loss
                down[w] = up_h & vertical
                vertical |= up_h
                np.invert(vertical, out=vertical)
                vertical |= down_h
                up[w] = vertical
                gain, loss = more, less
            np.minimum(best, score if step < least else np.where(step < reach, score, best), out=best)
        return best <= most


class Benchmark:
    """Items of one block, cut into pieces of which one at least has a single edit at most.

    An item of at most k edits in k // 2 + 1 pieces has fewer than two in one of them; of
    the pairs and the fours of pieces one likewise has fewer than two for each piece, and
    holds such a piece. So a place is proposed by a piece, and passes on to the exact
    distance if the pair and the four around that piece are within their edits. None of
    these steps loses an item that is within SIMILARITY.
    """

    def __init__(self, items: list[tuple[int, str]]):
        coded = [(i, normalised(t or "")) for i, t in items]
        self.items = [(i, c) for i, c in coded if len(c) >= SEED]
        self.short = [(i, c.tobytes()) for i, c in coded if 0 < len(c) < SEED]
        self.lengths = np.array([len(c) for _, c in self.items], dtype=np.int64)
        self.most = ((1 - SIMILARITY) * self.lengths + 1e-9).astype(np.int64)
        found: dict[int, list[tuple[np.ndarray, int, int, int, int]]] = {}
        strings: list[list[np.ndarray]] = [[], []]
        edits: list[list[int]] = [[], []]
        begins: list[list[int]] = [[], []]
        for number, (_, codes) in enumerate(self.items):
            pieces = int(self.most[number]) // 2 + 1
            size = min(LONGEST, len(codes) // pieces)
            bounds = [i * len(codes) // pieces for i in range(pieces + 1)]
            for i in range(pieces):
                for level, width in enumerate((2, 4)):
                    if i % width == 0:
                        end = min(i + width, pieces)
                        # items cut into long pieces are short; a part is one machine word
                        strings[level].append(codes[bounds[i] : bounds[end]])
                        edits[level].append(2 * (end - i) - 1)
                        begins[level].append(bounds[i])
                own = codes[bounds[i] : bounds[i] + size]
                two, four = len(strings[0]) - 1, len(strings[1]) - 1
                found.setdefault(size, []).append((own, number, bounds[i], two, four))
        self.whole = Parts([c for _, c in self.items], [m + GRAIN for m in self.most.tolist()])
        self.parts = [Parts(s, e) for s, e in zip(strings, edits, strict=True)]
        self.begins = [np.array(b, dtype=np.int64) for b in begins]
        self.pieces = []
        for size in sorted(found):
            own = np.stack([piece for piece, *_ in found[size]])
            rest = np.array([r for _, *r in found[size]], dtype=np.int64).T
            self.pieces.append((Pieces(own), *rest))

    def windows(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(document, start, item) of every window that may hold its item, in joined documents;
        the item begins at most as many characters from there as it may have edits."""
        slots = (codes % SLOTS).astype(np.int64)
        places: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in self.pieces]
        longest = max((pieces.length for pieces, *_ in self.pieces), default=0)
        for first in range(0, len(codes), TOGETHER):
            hashes = Hashes(codes[first : first + TOGETHER + longest])
            for known, (pieces, *_) in zip(places, self.pieces, strict=True):
                start, number = pieces.find(hashes)
                known.append((start + first) << 32 | number)
        out = [np.zeros((0, 3), dtype=np.int64)]
        for known, (_, item, place, *parts) in zip(places, self.pieces, strict=True):
            pairs = np.concatenate(known)
            pairs.sort()
            pairs = pairs[np.diff(pairs, prepend=-1) != 0]
            start, number = pairs >> 32, pairs & 0xFFFFFFFF
            for level, part in enumerate(parts):
                own = part[number]
                stretches = self.parts[level]
                most = stretches.most[own]
                inside = place[number] - self.begins[level][own]
                near = stretches.near(own, start - inside - most, slots)
                start, number = start[near], number[near]
            document = np.searchsorted(ends, start, side="right")
            out.append(np.stack([document, start - place[number], item[number]], axis=1))
        windows = np.concatenate(out)
        if not len(windows):
            return windows
        one = np.concatenate([windows[:, :1], windows[:, 1:2] // GRAIN, windows[:, 2:]], axis=1)
        windows = windows[np.unique(one, axis=0, return_index=True)[1]]
        most = self.most[windows[:, 2]] + GRAIN
        return windows[self.whole.near(windows[:, 2], windows[:, 1] - most, slots)]

    def search(self, texts: list[str]) -> list[list[tuple[int, int, float, int]]]:
        """Per text: item_id, distance, similarity and end of each item that it holds."""
        coded = [normalised(t) for t in texts]
        ends = np.cumsum([len(c) for c in coded])
        begins = np.concatenate([[0], ends[:-1]])
        codes = np.concatenate([*coded, np.zeros(0, np.uint32)])
        best: list[dict[int, tuple[int, int, float, int]]] = [{} for _ in texts]
        if len(self.items) and len(codes):
            self._verify(self.windows(codes, ends), codes, begins, ends, best)
        for item, whole in self.short:
            for number, c in enumerate(coded):
                place = c.tobytes().find(whole)
                while place % 4 and place > 0:
                    place = c.tobytes().find(whole, place + 1)
                if place >= 0:
                    best[number][item] = (item, 0, 1.0, (place + len(whole)) // 4)
        return [[own[k] for k in sorted(own)] for own in best]

    def _verify(self, windows, codes, begins, ends, best) -> None:
        """The exact distance, once for windows of an item that overlap."""
        windows = windows[np.lexsort((windows[:, 1], windows[:, 2], windows[:, 0]))]
        document, start, owner = windows.T
        apart = np.ones(len(windows), dtype=bool)
        apart[1:] = (document[1:] != document[:-1]) | (owner[1:] != owner[:-1])
        apart[1:] |= start[1:] - start[:-1] > 2 * self.most[owner[1:]]
        first = np.flatnonzero(apart)
        last = np.append(first[1:], len(windows))[: len(first)] - 1
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            d, number = int(document[a]), int(owner[a])
            item, pattern = self.items[number]
            length, most = len(pattern), int(self.most[number])
            low = max(int(begins[d]), int(start[a]) - most - GRAIN)
            high = min(int(ends[d]), int(start[b]) + length + most + GRAIN)
            found = within(pattern, codes[low:high], most)
            if found and (item not in best[d] or found[0] < best[d][item][1]):
                distance, end = found
                best[d][item] = (item, distance, 1 - distance / length, end + low - int(begins[d]))


def _blocks(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The items in blocks of about BLOCK_CHARS characters, each read on its own."""
    total = benchmark.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = int(total // BLOCK_CHARS) + 1
    for block in range(blocks):
        rows = (
            benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
            .where("text IS NOT NULL")
            .select("item_id", "text")
            .orderBy("item_id", "text")
            .collect()
        )
        yield Benchmark([(r["item_id"], r["text"]) for r in rows])


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, similarity, ends) of every benchmark item in a document.

    An item is in a document if its normalised text has at most 0.2 x its length edits
    to some part of the document's; `ends` is where the best such part ends, in
    normalised characters. An item of fewer than SEED characters counts if it is there
    exactly. Items with NULL or no letters and digits, and NULL or empty texts, match
    nothing; repeated rows give repeated rows; a NULL doc_id stays NULL.
    """
    spark = prepared(documents.sparkSession)
    out = spark.createDataFrame([], LEAKS)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = [x for group in small_groups(texts) for x in shared.value.search(group)]
                ids = batch.column("doc_id").to_pylist()
                rows = [(i, *leak) for i, own in zip(ids, found, strict=True) for leak in own]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=[part.split(" ")[0] for part in LEAKS.split(", ")],
                )

        out = out.union(documents.select("doc_id", "text").mapInArrow(find, LEAKS))
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    spark = prepared(documents.sparkSession)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = [x for group in small_groups(texts) for x in shared.value.search(group)]
                yield batch.filter(pa.array([not own for own in found], pa.bool_()))

        documents = documents.mapInArrow(keep, documents.schema)
    return documents
