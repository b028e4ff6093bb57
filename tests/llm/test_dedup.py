"""SimHash near-duplicates, components and suffix-array dedup against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash

from barloom.llm import simhash, suffix_dedup
from barloom.llm.components import stars
from barloom.llm.suffix_array import common_prefixes, suffix_array

from .conftest import rows_of


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), seed=42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > n)


def smallest_reachable(nodes, linked):
    """Component of each node number, by plain union-find."""
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(nodes))]


def test_fingerprints(spark, odd, odd_rows, rng):
    assert rows_of(simhash.fingerprints(odd)) == sorted(
        ((i, int(np.uint64(plain_fingerprint(t)).view(np.int64))) for i, t in odd_rows), key=repr
    )
    spark_hash = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert simhash.fingerprint("A b\tC") == spark_hash % 2**64
    assert simhash.fingerprint("a b") == simhash.fingerprint("a b ")  # no ASCII space inside


@pytest.mark.parametrize("distance,segments", [(3, 2), (3, 4), (5, 2), (1, 2)])
def test_links_are_complete(spark, rng, distance, segments):
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) & (2**64 - 1) for c in centres for _ in range(12)}
    prints |= {0, 2**64 - 1, 1, 2**63}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {tuple(r) for r in simhash.links(frame, distance, segments).collect()}
    expected = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= distance
    }
    assert found == expected


def test_stars(spark, rng):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1001 + i) for i in range(300)]
    mixed = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = [*chain, *hub, *mixed, (5, 5), (0, 1), (1, 0)]
    rng.shuffle(edges)
    found = dict(map(tuple, stars(spark.createDataFrame(edges, "a long, b long")).collect()))
    names = sorted({n for e in edges for n in e})
    pairs = {frozenset(e) for e in edges}
    roots = smallest_reachable(names, lambda a, b: frozenset((a, b)) in pairs)
    assert found == {n: names[r] for n, r in zip(names, roots) if names[r] != n}
    assert stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_odd_rows(odd, odd_rows, nothing):
    prints = [plain_fingerprint(t) for _, t in odd_rows]
    roots = smallest_reachable(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    members = {}
    for (doc_id, _), root in zip(odd_rows, roots):
        members.setdefault(root, []).append(doc_id)
    smallest = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    expected = [(d, f"{p:016x}", smallest[r]) for (d, _), p, r in zip(odd_rows, prints, roots)]
    assert rows_of(simhash.near_duplicates(odd)) == sorted(expected, key=repr)
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(odd, odd_rows):
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert [i for i in ids if i is not None] == sorted(set(ids) - {None}, key=ids.index)
    assert 1 in ids and 6 in ids and 7 in ids and 3 not in ids  # 6 repeats 1, but has another text, too
    assert ids.count(None) == 2


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_suffix_array_against_sorting(rng, letters):
    for _ in range(400):
        text = [rng.randrange(letters) for _ in range(rng.randint(0, 50))]
        order = suffix_array(text)
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        common = common_prefixes(text, order)
        for rank in range(1, len(text)):
            a, b = text[order[rank - 1] :], text[order[rank] :]
            assert common[rank] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def plain_removal(rows):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        rank = suffix_dedup.NO_ID if doc_id is None else doc_id
        for i in range(len(data) - 49):
            string = data[i : i + 50]
            first[string] = min(first.get(string, rank), rank)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        rank = suffix_dedup.NO_ID if doc_id is None else doc_id
        mark = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < rank:
                mark[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, m in zip(data, mark) if not m)
        spans = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        out.append((doc_id, len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_of_odd_rows(odd, odd_rows, nothing):
    assert rows_of(suffix_dedup.repeated_bytes(odd)) == plain_removal(odd_rows)
    assert suffix_dedup.repeated_bytes(nothing).count() == 0


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgé \n"])
def test_repeats_in_texts_of_few_letters(documents, rng, letters):
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([30, 49, 50, 51, 80, 200]))) for _ in range(8)]
    rows = []
    for doc_id in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += [part[cut : len(part) - rng.randint(0, 20)], "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))]
        rows.append((rng.choice([doc_id, doc_id, doc_id % 7, None]), "".join(parts)))
    assert rows_of(suffix_dedup.repeated_bytes(documents(rows).repartition(5))) == plain_removal(rows)


def test_texts_longer_than_a_piece(documents, rng, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 200)
    rows = [(i, "".join(rng.choice("abcd") for _ in range(700))) for i in range(4)]
    rows += [(9, rows[0][1][50:600] + rows[2][1][100:]), (10, rows[3][1])]
    scanner, frame = suffix_dedup.Scanner(), []
    for _, text in rows:
        starts = set()
        for data, first, last, at, keys, number, begin in scanner.pieces([text.encode()]):
            for a, b, start in zip(first, last, begin):
                starts.update(range(int(start), int(start + b - a + 1)))
                assert data[a : b + 50].tobytes() == text.encode()[start : start + b - a + 50]
        frame.append(starts == set(range(len(text) - 49)))
    assert all(frame)
    assert rows_of(suffix_dedup.repeated_bytes(documents(rows))) == plain_removal(rows)


def test_a_filter_that_holds_everything_changes_nothing(documents, rng, monkeypatch):
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(300))) for i in range(20)]
    rows += [(30 + i, rows[i][1][:120] + "?" + rows[i + 1][1][30:]) for i in range(10)]
    monkeypatch.setattr(suffix_dedup.Filter, "holds", lambda self, keys: np.ones(len(keys), dtype=bool))
    assert rows_of(suffix_dedup.repeated_bytes(documents(rows))) == plain_removal(rows)


def test_cut_texts_stay_valid_and_keep_their_columns(documents):
    passage = "é" * 40 + " shared passage"
    rows = [(1, passage), (2, "ü" + passage + "ß"), (3, passage), (4, None)]
    cut = suffix_dedup.without_repeats(documents(rows))
    assert cut.columns == documents(rows).columns
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == [(1, passage), (2, "üß"), (3, ""), (4, None)]


def test_near_duplicates_are_judged_by_row(documents):
    """A second row of a doc_id keeps not its copy but its own text; of NULL ids one copy stays."""
    shared, own = "one shared text of eight words in all", "entirely different prose of the second row here"
    nameless = "a text that only rows without an id ever have"
    rows = [(1, shared), (2, shared), (2, own), (None, nameless), (None, nameless), (None, shared)]
    for order in (rows, rows[::-1]):
        for parts in (1, 5):
            frame = documents(order).repartition(parts, "text")
            kept = simhash.without_near_duplicates(frame)
            assert kept.columns == frame.columns
            assert rows_of(kept.select("doc_id", "text")) == sorted([(1, shared), (2, own), (None, nameless), (None, shared)], key=repr)


def test_a_task_hands_on_one_piece_per_bucket(spark, documents, rng):
    """Not one per batch and bucket: those grow with the square of the input."""
    rows = documents([(i, "".join(rng.choice("abcdefgh ") for _ in range(400))) for i in range(300)])
    rows = rows.selectExpr("doc_id AS doc", "0 AS row", "text").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    shared = suffix_dedup.Filter(4, 6, np.full(1 << 7, 255, dtype=np.uint8))  # holds every anchor
    sent = suffix_dedup._run_texts(rows, spark.sparkContext.broadcast(shared))
    try:
        spark.conf.set(name, "10")
        buckets = [r.bucket for r in sent.select("bucket").collect()]
    finally:
        spark.conf.set(name, before)
    assert sorted(buckets) == list(range(16))


def test_buckets_stay_few_as_the_input_grows():
    sized = suffix_dedup.Filter.sized
    # 10 GB in tasks of 26 MB: a task hands on a piece per bucket, of hundreds of anchors
    assert (26 << 20) // (suffix_dedup.WINDOW // 2) >> sized(10 << 30).bucket_bits >= 500
    assert [sized(n << 20).bucket_bits for n in (0, 1, 16, 100, 1000)] == [4, 4, 5, 7, 8]
    for n in (1 << 20, 1 << 33, 1 << 40):
        shape = sized(n)
        assert 1 << (shape.bucket_bits + shape.segment_bits) <= suffix_dedup.FILTER_BITS


def plain_owners(texts, offsets, owners):
    """Of every string, the smallest owner of a text that has it as far from the anchor."""
    first = {}
    for text, at, owner in zip(texts, offsets, owners):
        for i in range(len(text) - 49):
            string = at - i, text[i : i + 50]
            first[string] = min(first.get(string, owner), owner)
    return [[first[at - i, text[i : i + 50]] for i in range(len(text) - 49)] for text, at in zip(texts, offsets)]


@pytest.mark.parametrize("most", [3, 40, 256])
@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcd"])
def test_a_hot_anchor_is_split(rng, monkeypatch, letters, most):
    """One line before many texts: no suffix array is of more than MOST_TEXTS of them."""
    sizes = []

    def noted(string):
        sizes.append(sum(symbol == max(string) for symbol in string))
        return suffix_array(string)

    monkeypatch.setattr(suffix_dedup, "MOST_TEXTS", most)
    monkeypatch.setattr(suffix_dedup, "suffix_array", noted)
    anchor = b"the anchor of 24 bytes!!"
    sides = [bytes(rng.choice(letters) for _ in range(26)) for _ in range(4)]
    contexts = {(sides[0], bytes(rng.choice(letters) for _ in range(26)), 26, 26): i for i in range(600)}
    for i in range(600):
        before, after = (bytearray(rng.choice(sides)) for _ in range(2))
        for side in (before, after):
            for _ in range(rng.choice([0, 0, 1, 2])):
                side[rng.randrange(26)] = rng.choice(letters)
        left = rng.choice([26, 26, rng.randint(0, 26)])
        contexts[bytes(before), bytes(after), left, rng.randint(26 - left, 26)] = rng.randrange(1200)
    texts = {(before[26 - left :] + anchor + after[:right], left): owner for (before, after, left, right), owner in contexts.items()}
    texts, offsets, owners = [t for t, _ in texts], [o for _, o in texts], list(texts.values())
    found = suffix_dedup.anchor_verdicts(texts, offsets, owners)
    assert [[owner for a, b, owner in parts for _ in range(a, b)] for parts in found] == plain_owners(texts, offsets, owners)
    assert max(sizes, default=0) <= most


def test_a_line_before_many_texts(documents, rng, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_TEXTS", 5)
    line = "a line that stands before the text of very many documents\n"
    rows = [(i, line + "".join(rng.choice("ab") for _ in range(rng.randint(0, 70)))) for i in range(150)]
    rows += [(rng.randrange(200), rows[i][1][20:] + line) for i in range(40)]
    assert rows_of(suffix_dedup.repeated_bytes(documents(rows).repartition(4))) == plain_removal(rows)
