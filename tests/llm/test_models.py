"""Language identification and toxicity: probabilities, held-out accuracy, odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from barloom.llm import language, toxicity
from barloom.llm.queries import QUERIES

SYLLABLES = {"aa": "ka lo mi tu ren sa vo".split(), "bb": "zwi ärt og ulp schn eif öd".split(), "cc": "ñor qué ía lles ción ro".split()}


def text_in(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)) + "."


@pytest.fixture
def corpus(rng):
    return [(i, text_in(rng, lang, rng.randint(5, 60)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 80)]


def gram_list(rows):
    """Every occurrence of a 4-gram, as four symbols, by language."""
    out = {}
    for _, text, lang in rows:
        sequence = [int(x) for x in language.symbols(text)[0]]
        out.setdefault(lang, []).extend(tuple(sequence[i : i + 4]) for i in range(len(sequence) - 3))
    return out


def plain_orders(occurrences):
    """Counts of 4-grams and continuation counts of shorter ones, by order."""
    orders = {4: Counter(occurrences)}
    for order in (3, 2, 1):
        orders[order] = Counter(gram[1:] for gram in orders[order + 1])
    return orders


def key_of(gram):
    return sum(symbol << 16 * i for i, symbol in enumerate(reversed(gram)))


def counted(rows, rare=0.0):
    """What `train` gathers, by plain Python."""
    out = {}
    for lang, occurrences in gram_list(rows).items():
        orders = plain_orders(occurrences)
        for order in range(1, 5):
            counts, heads = orders[order], Counter()
            for gram, n in counts.items():
                heads[gram[:-1]] += n
            kept = sorted(g for g, n in counts.items() if n >= rare * sum(counts.values()))
            once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
            columns = (
                np.array([key_of(g) for g in kept], dtype=np.uint64),
                np.array([counts[g] for g in kept]),
                np.array([heads[g[:-1]] for g in kept]),
            )
            out.setdefault(lang, []).append(language.Counts(*columns, language.discount(once, twice)))
    return out


def plain_probability(orders, symbols, gram):
    """Interpolated Kneser-Ney by its definition."""
    if not gram:
        return 1 / (symbols + 1)
    counts = orders[len(gram)]
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    cut = once / (once + 2 * twice) if once and twice else 0.5
    same = {g: n for g, n in counts.items() if g[:-1] == gram[:-1]}
    lower = plain_probability(orders, symbols, gram[1:])
    if not same:
        return lower
    total = sum(same.values())
    return max(counts[gram] - cut, 0) / total + cut * len(same) / total * lower


@pytest.mark.parametrize("rare", [0.0, 1e-3])
def test_probabilities_sum_to_one(corpus, rare):
    models = language.Models.build(counted(corpus, rare))
    alphabet = models.keys[0]
    for order in range(1, language.ORDER + 1):
        for context in models.contexts[order - 1][::7]:
            keys = (context << np.uint64(16)) | alphabet
            total = np.exp(models.score(keys, order)).sum(axis=0)
            # what is missing is the floor's share for symbols never seen
            assert (total <= 1 + 1e-4).all() and (total > 0.98).all()


def test_probabilities_are_kneser_ney(corpus, rng):
    models = language.Models.build(counted(corpus))
    occurrences = gram_list(corpus)
    some = rng.sample(sorted({g for own in occurrences.values() for g in own}), 60)
    some += [(*g[:3], h[3]) for g, h in zip(some, reversed(some))]
    scores = np.exp(models.score(np.array([key_of(g) for g in some], dtype=np.uint64)))
    for column, lang in enumerate(models.languages):
        orders = plain_orders(occurrences[lang])
        expected = [plain_probability(orders, len(models.keys[0]), g) for g in some]
        assert np.allclose(scores[:, column], expected, rtol=1e-4)


@pytest.mark.parametrize("rare", [0.0, 1e-3])
def test_statistics_are_of_all_grams(documents, corpus, monkeypatch, rare):
    found = {}
    monkeypatch.setattr(language.Models, "build", lambda given: found.update(given))
    language.train(documents(corpus).repartition(4), rare)
    expected = counted(corpus, rare)
    assert found.keys() == expected.keys()
    for lang, orders in expected.items():
        for got, own in zip(found[lang], orders, strict=True):
            assert got.discount == own.discount
            for name in ("keys", "counts", "heads"):
                assert (getattr(got, name) == getattr(own, name)).all()


def test_a_rare_language_keeps_its_grams(documents, rng):
    many = [(i, text_in(rng, "aa", 120), "aa") for i in range(600)]
    few = [(1000 + i, text_in(rng, "bb", 12), "bb") for i in range(30)]
    unseen = [(2000 + i, text_in(rng, "bb", 12), None) for i in range(20)]
    models = language.train(documents(many + few), rare=1e-3)
    column = models.languages.index("bb")
    h, _, _ = models.entropies([t for _, t, _ in unseen])
    assert (h.argmin(axis=1) == column).all()
    whole = language.train(documents(few), rare=0.0)
    kept = language.train(documents(few), rare=1e-7)
    assert all((a == b).all() for a, b in zip(whole.keys, kept.keys))


def test_counts_are_of_all_rows(documents, corpus):
    found = {(r.lang, r.gram): r.n for r in language.gram_counts(documents(corpus).repartition(4)).collect()}
    expected = {
        (lang, int(np.uint64(k).view(np.int64))): int(n)
        for lang, orders in counted(corpus).items()
        for k, n in zip(orders[-1].keys, orders[-1].counts)
    }
    assert found == expected


def test_languages(documents, corpus, rng):
    noise = ["".join(rng.choice("qxjzkvwbfgyp") for _ in range(400)), "日本語の文章です" * 30]
    rows = [*corpus, (900, noise[0], None), (901, noise[1], None), (902, "12 34 !!", "aa"), (903, None, "aa"), (None, text_in(rng, "bb", 30), None)]
    found = {r.doc_id: r for r in language.identify(documents(rows), "doc_id % 5 <> 0").collect()}
    held_out = [(i, lang) for i, _, lang in corpus if i % 5 == 0]
    assert np.mean([found[i].lang_pred == lang for i, lang in held_out]) > 0.97
    assert not any(found[i].rejected for i, _, _ in corpus)
    assert found[900].rejected and found[901].rejected and found[901].lang_pred != "und"
    assert (found[902].lang_pred, found[902].score, found[902].rejected) == ("und", 0.0, True)
    assert (found[903].lang_pred, found[903].rejected) == ("und", True)
    assert found[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = language.accepted(documents(rows), "doc_id % 5 <> 0")
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _ in corpus} | {None}
    assert kept.columns == documents(rows).columns


def test_scores_do_not_depend_on_neighbours(corpus):
    models = language.Models.build(counted(corpus))
    texts = [t for _, t, _ in corpus[:20]]
    together = models.entropies(texts)[0]
    alone = np.concatenate([models.entropies([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6)


def test_nothing_to_learn(odd, nothing):
    found = language.identify(odd, "doc_id < -5").collect()
    assert len(found) == odd.count() and {r.lang_pred for r in found} == {"und"}
    assert language.identify(nothing, "true").count() == 0
    assert language.identify(odd, "doc_id IS NOT NULL").count() == odd.count()


@pytest.fixture
def judged(rng):
    """Texts of which one in eight holds words of a secret lexicon, with its label."""
    stems, rows, labels = ["grobl", "schnurz", "fiend"], [], []
    for i in range(900):
        lang = rng.choice(["aa", "bb", "cc"])
        toxic = rng.random() < 0.125
        words = text_in(rng, lang, rng.randint(10, 40)).split(" ")
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(["", "en", "ia", "or"]))
        rows.append((i, " ".join(words), lang))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents, judged):
    rows, labels = judged
    given = [*labels, (5000, 1, 1), (None, 1, 1), (7, 1, None)]
    frame = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    odd_texts = [(None, "grobl grobl"), (9001, None), (9002, ""), (9003, "Grobl schnurzen!")]
    found = {
        r.doc_id: r for r in toxicity.toxicity(documents([*rows, *odd_texts]), frame, "doc_id % 3 <> 0").collect()
    }
    held_out = [(found[i].predicted, toxic) for i, _, toxic in labels if i % 3 == 0]
    assert sum(p == t for p, t in held_out) >= 0.98 * len(held_out)
    assert found[9003].predicted == 1 and found[None].predicted == 1
    assert found[9001].score == found[9002].score < 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())


def test_toxicity_without_labels(spark, odd, nothing, judged, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(odd, none, "true").collect()} == {0}
    one_class = spark.createDataFrame([(1, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(odd, one_class, "true").collect()} == {0}
    assert toxicity.toxicity(nothing, one_class, "true").count() == 0


def test_label_model_discounts_copies(rng):
    gen = np.random.default_rng(2)
    truth = gen.random(4000) < 0.2
    fires = lambda hit, false: np.where(truth, gen.random(4000) < hit, gen.random(4000) < false)
    good, weak = fires(0.8, 0.02), fires(0.4, 0.3)
    votes = np.stack([good, weak, weak, weak, fires(0.5, 0.05)], axis=1).astype(float)
    none, label = ~votes.any(axis=1), truth ^ (gen.random(4000) < 0.02)
    votes = np.column_stack([votes, none, label]).astype(float)
    model = toxicity.LabelModel.fit(votes, start=0.02 + 0.96 * label)
    assert np.allclose(model.weight[1:4], 1 / 3, atol=0.05) and model.weight[0] > 0.8
    assert abs(model.toxic_rate[0] - 0.8) < 0.1 and abs(model.clean_rate[0] - 0.02) < 0.04
    assert np.mean((model.posterior(votes) > 0.5) == truth) >= np.mean(label == truth) - 0.005


@pytest.mark.parametrize("name", ["op6_toxicity", "op7_language"])
def test_queries_on_the_given_tables(spark, name):
    folder = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, folder).toPandas()
    given = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    assert sorted(found.doc_id) == sorted(given.doc_id)
    joined = found.merge(given, on="doc_id")
    if name == "op7_language":
        assert (joined.lang_pred == joined.lang)[joined.held_out].mean() > 0.98
        assert not joined.rejected.any()
    else:
        assert 0.15 < joined.held_out.mean() < 0.35 and joined.score.between(0, 1).all()
