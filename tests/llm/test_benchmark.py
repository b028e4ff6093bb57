"""Decontamination: distances against dynamic programming, recall, and whole searches."""

from __future__ import annotations

import numpy as np
import pytest

from barloom.llm import decontaminate
from barloom.llm.decontaminate import Benchmark, normalised, within

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def codes(text):
    return np.array([ord(c) for c in text], dtype=np.uint32)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        place = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[place] = rng.choice("abcdefghij ")
        elif kind == 1:
            del out[place]
        else:
            out.insert(place, rng.choice("abcdefghij "))
    return "".join(out)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") * rng.randint(0, 3) for _ in range(n))


@pytest.fixture(scope="module")
def items():
    import random

    rng = random.Random(4)
    return [(i, sentence(rng, rng.randint(15, 60))) for i in range(60)]


@pytest.fixture
def benchmark(spark, items):
    return spark.createDataFrame([*items, (90, None), (91, ""), (92, "?!"), (93, "tiny 1")], "item_id long, text string")


def test_distance_against_dynamic_programming(rng):
    for _ in range(300):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        row = [0] * (len(text) + 1)
        for i, p in enumerate(pattern, 1):
            above, row = row, [i] + [0] * len(text)
            for j, t in enumerate(text, 1):
                row[j] = min(above[j - 1] + (p != t), above[j] + 1, row[j - 1] + 1)
        best = min(row)
        found = within(codes(pattern), codes(text), len(pattern))
        assert found[0] == best
        assert found[1] == (row.index(best) if best < len(pattern) else 0)
        assert within(codes(pattern), codes(text), best - 1) is None


def test_normalisation():
    assert "".join(map(chr, normalised("  Ab,  C-d\n1!é "))) == "ab c d 1 é"
    assert len(normalised("")) == 0 and len(normalised("?!")) == 0


@pytest.mark.parametrize("share,least", [(0.05, 0.99), (0.1, 0.97), (0.19, 0.9)])
def test_recall(rng, items, share, least):
    block = Benchmark(items)
    texts, expected = [], []
    for item, text in items * 4:
        length = len(normalised(text))
        changed = edited(rng, text, int(share * length))
        if within(normalised(text), normalised(changed), int(0.2 * length)):
            texts.append(sentence(rng, 30) + " " + changed + " " + sentence(rng, 30))
            expected.append(item)
    found = block.search(texts)
    hit = sum(item in {leak[0] for leak in own} for item, own in zip(expected, found))
    assert len(expected) > 100 and hit >= least * len(expected)


def test_leaks_and_clean_texts(documents, nothing, benchmark, items, odd, rng):
    clean = [(i, sentence(rng, 80)) for i in range(40)]
    quoting = [(100 + i, sentence(rng, 20) + " " + " ".join(items[i][1].split()[:5]) + " " + sentence(rng, 20)) for i in range(10)]
    leaking = [(200 + i, sentence(rng, 9) + "\n" + items[i][1].upper() + "!! " + sentence(rng, 9)) for i in range(20)]
    at_ends = [(300, items[0][1]), (301, items[1][1] + " tail"), (302, "head " + items[2][1]), (303, "a tiny, 1 here")]
    frame = documents([*clean, *quoting, *leaking, *at_ends, (None, items[3][1]), (400, None), (401, "")])
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(frame, benchmark).collect()}
    expected = {(200 + i, i) for i in range(20)} | {(300, 0), (301, 1), (302, 2), (303, 93), (None, 3)}
    assert set(found) == expected
    assert all(r.distance == 0 and r.similarity == 1.0 for r in found.values())
    kept = decontaminate.without_leaks(frame, benchmark)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in [*clean, *quoting]} | {400, 401}
    assert decontaminate.leaks(nothing, benchmark).count() == 0
    assert decontaminate.leaks(odd, benchmark.limit(0)).count() == 0
    assert decontaminate.without_leaks(odd, benchmark).count() == odd.count()


def test_blocks_find_the_same(documents, benchmark, items, monkeypatch):
    frame = documents([(i, "before " + text + " after") for i, text in items])
    whole = sorted(map(tuple, decontaminate.leaks(frame, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 4_000)
    assert sorted(map(tuple, decontaminate.leaks(frame, benchmark).collect())) == whole
    assert len(whole) >= len(items)


def spread(rng, text, every, kinds):
    """An edit at every so many characters."""
    out = []
    for place, char in enumerate(text, 1):
        kind = rng.choice(kinds) if place % every == 0 else ""
        out.append({"": char, "replaced": "#", "missing": "", "extra": char + "#"}[kind])
    return "".join(out).replace("#", "z")


@pytest.mark.parametrize("kinds", [["replaced"], ["missing"], ["extra"], ["replaced", "missing", "extra"]])
@pytest.mark.parametrize("every", [14, 12, 10, 8, 6, 5])
def test_evenly_spread_edits_are_all_found(rng, items, every, kinds):
    block = Benchmark([*items, (70, "twenty characters ab"), (71, "just over fourteen")])
    texts, expected = [], []
    for number, (item, codes) in enumerate(block.items):
        text = "".join(map(chr, codes))
        changed = spread(rng, text, every, kinds)
        around = [sentence(rng, 10), changed, sentence(rng, 10)]
        texts.append([" ".join(around), changed, " ".join(around[1:]), " ".join(around[:2])][number % 4])
        expected.append((item, codes, text))
    found = block.search(texts)
    for (item, codes, _), text, own in zip(expected, texts, found):
        best = within(codes, normalised(text), int(0.2 * len(codes) + 1e-9))
        assert best is None or (item, best[0]) in {(i, distance) for i, distance, _, _ in own}
    assert every == 5 or sum(map(bool, found)) > 50


def test_edits_in_each_word_are_all_found(rng, items):
    block = Benchmark(items)
    texts = []
    for _, codes in block.items:
        words = "".join(map(chr, codes)).split()
        texts.append(" ".join(w[:2] + "q" + w[3:] if len(w) > 4 else w for w in words))
    within_limit = [within(c, normalised(t), int(0.2 * len(c) + 1e-9)) for (_, c), t in zip(block.items, texts)]
    found = block.search(texts)
    assert sum(map(bool, within_limit)) > 30
    for (item, _), best, own in zip(block.items, within_limit, found):
        assert best is None or (item, best[0], best[1]) in {(i, d, end) for i, d, _, end in own}


def test_search_is_brute_force(rng):
    """Every pair of the rule, with all its details, and no other."""
    letters = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    block = Benchmark([(i, letters(rng.randint(14, 60))) for i in range(25)])
    texts = []
    for _ in range(150):
        text = "".join(map(chr, rng.choice(block.items)[1]))
        texts.append(letters(rng.randint(0, 30)) + edited(rng, text, rng.randint(0, len(text) // 4)) + letters(rng.randint(0, 30)))
    found = block.search(texts)
    for text, own in zip(texts, found):
        brute = {}
        for item, codes in block.items:
            if best := within(codes, normalised(text), int(0.2 * len(codes) + 1e-9)):
                brute[item] = (item, best[0], 1 - best[0] / len(codes), best[1])
        assert own == [brute[i] for i in sorted(brute)]


def test_pieces_with_one_edit_over_chunks(rng, monkeypatch):
    """Every piece with at most one edit is found, wherever texts are cut; pieces of all
    lengths share the running sums of a chunk."""
    made, begin = [], decontaminate.Hashes.__init__
    monkeypatch.setattr(decontaminate, "TOGETHER", 40)
    monkeypatch.setattr(decontaminate.Hashes, "__init__", lambda self, codes: made.append(1) or begin(self, codes))
    decontaminate._powers.cache_clear()
    items = [(n, "".join(rng.choice("abcdefghij") for _ in range(size))) for n, size in enumerate([44, 44, 100, 240])]
    bench = decontaminate.Benchmark(items)
    assert len({pieces.length for pieces, *_ in bench.pieces}) == 2
    whole = ""
    for _, text in items:
        for at in range(0, len(text) - 9, 7):
            j = at + rng.randrange(9)
            whole += rng.choice([text[:j] + text[j + 1 :], text[:j] + "x" + text[j:], text[:j] + "x" + text[j + 1 :]])[at : at + 11]
    codes = decontaminate.normalised(whole)
    for pieces, item, place, *_ in bench.pieces:
        m = pieces.length
        found = set()
        for first in range(0, len(codes), 40):
            start, number = pieces.find(decontaminate.Hashes(codes[first : first + 40 + 9]))
            found |= set(zip((start + first).tolist(), number.tolist(), strict=True))
        for n in range(len(item)):
            own = bench.items[item[n]][1][place[n] : place[n] + m]
            edited = {tuple(own)}
            for j in range(m):
                edited |= {(*own[:j], ord("x"), *own[j + 1 :]), (*own[:j], *own[j + 1 :])}
                edited |= {(*own[:j], ord("x"), *own[j:])} if j else set()
            for k in range(len(codes) - m):
                if any(tuple(codes[k : k + len(e)]) == e for e in edited if len(e) != m - 1 or k + m <= len(codes)):
                    assert any((k + d, n) in found for d in (-1, 0, 1))
    made.clear()
    bench.search([whole])
    assert len(made) == -(-len(codes) // 40)
    decontaminate._powers.cache_clear()
