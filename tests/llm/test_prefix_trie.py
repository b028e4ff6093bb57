from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from barloom.llm import prefix_trie
from tests.llm.conftest import CLASHING, rows_of


def expected(rows):
    """By the definition, with plain lists."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) or 1
        bytes_ = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * bytes_ + sum(saved[c] for c in below)
    return sorted(
        (
            (
                min(m),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(m),
                len(children[node]),
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=repr,
    )


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        names = [c for c in CLASHING if c != "row"] + ["node", "parent", "depth", "place", "leaf"]
        kinds = "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in names)
        return spark.createDataFrame([(*r, *["?"] * len(names)) for r in rows], kinds)

    return make


def test_shared_beginnings(frame, rng):
    rows = []
    for c in rng.sample(range(-20, 60), 50):
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None])))
    rows += rows[:20]
    rng.shuffle(rows)
    assert rows_of(prefix_trie.prefix_trie(frame(rows).repartition(4))) == expected(rows)


def test_copies_long_chains_and_odd_rows(frame):
    rows = [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(10)]
    rows += [(7, t, "user", f"turn {t}") for t in range(400)]  # a chain
    rows += [(8, None, None, None)] * 30 + [(None, 1, "user", "nobody's"), (2**40, 5, "x" * 5000, "y" * 100_000)]
    rows += [(11, t, "a:1", ":b") for t in range(9)] + [(12, t, "a", "1::b") for t in range(9)]
    assert rows_of(prefix_trie.prefix_trie(frame(rows).repartition(6))) == expected(rows)


def test_nothing(frame):
    assert prefix_trie.prefix_trie(frame([])).collect() == []


def test_small_blocks(frame, rng, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    rows = [(c, t, "u", rng.choice("xy")) for c in range(30) for t in range(7)]
    rows += [(c, t, "u", "same") for c in range(100, 140) for t in range(3)]
    assert rows_of(prefix_trie.prefix_trie(frame(rows))) == expected(rows)


def test_totals_of_any_tree(spark, rng):
    parents = {0: None} | {n: rng.choice([n - 1, n - 1, n - 1, rng.randrange(n)]) for n in range(1, 300)}
    made = [(n, p, rng.randrange(5), rng.randrange(100)) for n, p in parents.items()]
    tree = spark.createDataFrame(made, "node long, parent long, leaves long, saved long")
    sums = {n: [a, b] for n, _, a, b in made}
    for n in sorted(parents, reverse=True)[:-1]:
        for k in (0, 1):
            sums[parents[n]][k] += sums[n][k]
    found = {r.node: [r.leaves, r.saved] for r in prefix_trie.subtree_totals(tree).collect()}
    assert found == sums


def test_rounds_back_do_not_pile_up(frame):
    # each conversation goes on one turn further than the one before it
    rows = [(5 * c, t, "u", f"turn {t}") for c in range(40) for t in range(c + 1)]
    found = prefix_trie.prefix_trie(frame(rows))
    joins = found._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins <= prefix_trie.ROUNDS_AT_ONCE + 4
    assert rows_of(found) == expected(rows)


def test_stretches_need_no_rounds(frame, monkeypatch):
    written, write = [], prefix_trie.stored
    monkeypatch.setattr(prefix_trie, "stored", lambda f, label: written.append(label) or write(f, label))
    # copies with a long beginning in common, and as long tails of their own
    rows = [(5 * c, t, "u", f"turn {t}" if t < 60 else f"{c} {t}") for c in range(12) for t in range(120)]
    assert rows_of(prefix_trie.prefix_trie(frame(rows))) == expected(rows)
    assert [w for w in written if w.startswith("trie-") and w[5:].isdigit()] == ["trie-0"]
