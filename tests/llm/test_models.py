"""Classifiers and the language model: held-out accuracy, brute force for what SQL can't express, odd rows."""
from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, SF

from churnlens.llm import quality_pu, queries, suffix_tree, toxicity

SF_MORE = "/root/testdata/sf0.01"


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def labels_of(spark, sf, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}


# --- toxicity ----------------------------------------------------------------------------------------

def brute_features(text):
    """Words, stems, pairs and skip pairs as tuples instead of hashes."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    words = "".join(chr(b) if b >= 128 or chr(b).isalnum() else " " for b in raw).split()
    out = {("w", w) for w in words} | {(k, w[:k]) for w in words for k in toxicity.STEMS}
    return out | {(gap, a, b) for gap in (1, 2, 3) for a, b in zip(words, words[gap:])}


def test_features_equal_brute_force():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "THE", "thé", "clown,", "a-b", "x" * 9, "🙂", "42"]) for _ in range(rng.randrange(0, 25))) for _ in range(40)]
    got = list(toxicity._document_features(texts, toxicity.hasher(), 7)())
    assert [len(g) for g in got] == [len(brute_features(t)) for t in texts]


def test_ftrl_equals_reference_update():
    """One coordinate at a time against the textbook update."""
    model = toxicity.Ftrl(3)
    z, n = [0.0] * 4, [0.0] * 4
    for at, y in (([0, 3], 1), ([1, 3], 0), ([0, 1, 3], 1), ([2, 3], 0), ([0, 3], 1)) * 6:
        def weight(i):
            if abs(z[i]) <= model.l1:
                return 0.0
            return -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)
        w = {i: weight(i) for i in at}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i in at:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
        model.learn(np.array(at), y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_toxicity_held_out(spark):
    labels = labels_of(spark, SF_MORE, "toxic")
    got = queries.op9_toxicity(spark, SF_MORE).collect()
    assert len(got) == spark.read.parquet(f"{SF_MORE}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in held if not y) <= 1
    assert sum(p == y for y, p in held) / len(held) >= 0.93


def test_toxicity_odd_rows(spark, odd, none, docs_of):
    texts = ["fine words here", "you stupid clown", "nice day today", "a pathetic loser"] * 20
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None), (3, 0), (4, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(texts), labels)
    scored = toxicity.score(odd, model)
    rows = scored.collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows) and toxicity.score(none, model).count() == 0
    assert {c for c in odd.columns} <= set(scored.columns)
    bad, good = (r.score for r in toxicity.score(docs_of(["such a stupid loser clown", "fine day here"]), model).orderBy("doc_id").collect())
    assert bad > 0.5 > good
    nothing = toxicity.train(docs_of(texts), labels.limit(0))
    assert max(r.score for r in toxicity.score(odd, nothing).collect()) < 1e-300


# --- quality -----------------------------------------------------------------------------------------

def test_quality_held_out(spark):
    labels = labels_of(spark, SF_MORE, "quality")
    got = queries.op7_quality(spark, SF_MORE).collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == y for y, p in held) / len(held) >= 0.95
    assert sum(not p for y, p in held if not y) / max(1, sum(not y for y, _ in held)) >= 0.8


def test_quality_odd_rows(spark, odd, none):
    rng = np.random.default_rng(0)
    model = quality_pu.fit(rng.normal(0, 1, (50, quality_pu.N_FEATURES)), rng.normal(0.3, 1, (80, quality_pu.N_FEATURES)), 0.7)
    assert quality_pu.score(odd, model).count() == len(ODD) and quality_pu.score(none, model).count() == 0
    assert all(0 <= r.score <= 1 for r in quality_pu.score(odd, model).collect())
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality_pu.score(odd, quality_pu.train(odd, no_labels)).collect()} == {0.0}
    assert (quality_pu.features("") == 0).all()


def test_pu_recovers_negatives():
    """With the right prior, positives and unlabelled data alone separate the classes."""
    rng = np.random.default_rng(1)
    d = quality_pu.N_FEATURES
    good, bad = rng.normal(0, 1, (9000, d)), rng.normal(0, 1, (3000, d))
    bad[:, :2] += 4
    model = quality_pu.fit(good[:4500], np.concatenate([good[4500:], bad]), 0.6)
    assert (model.score(good) >= 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.9


def mixture(rng, n_good, n_web, prior):
    d = quality_pu.N_FEATURES
    good, web = rng.normal(0, 1, (n_good, d)), rng.normal(0, 1, (n_web, d))
    web[int(prior * n_web):, :2] += 4
    return good, web


def test_pu_risk_is_least_and_its_slope_right():
    """The objective equals the risk written out row by row, its slope finite differences; no small step from the fit lowers it
    unless the negatives' part falls below zero."""
    rng = np.random.default_rng(4)
    good, web = mixture(rng, 400, 700, 0.6)
    model = quality_pu.scaled(quality_pu.moments(good, web))
    objective = quality_pu.non_negative(0.6)

    def risk(w):
        loss = lambda x, sign: np.mean([math.log1p(math.exp(-sign * float(r @ w))) for r in model.design(x)])
        negatives = loss(web, -1) - 0.6 * loss(good, -1)
        return math.inf if negatives < 0 else 0.6 * loss(good, 1) + negatives + 0.5 * quality_pu.L2 * float(w[:-1] @ w[:-1])

    w = rng.normal(0, 0.05, 2 * quality_pu.N_FEATURES + 1)
    value, slope, curvature = objective(w, quality_pu.risk_sums(good, web, model, w))
    assert value == pytest.approx(risk(w), abs=1e-8)
    for i in (0, 1, 30, len(w) - 1):
        ahead = w + 1e-5 * (np.arange(len(w)) == i)
        there = objective(ahead, quality_pu.risk_sums(good, web, model, ahead))
        assert (there[0] - value) / 1e-5 == pytest.approx(slope[i], abs=1e-4)
        assert np.allclose((there[1] - slope) / 1e-5, curvature[i], atol=1e-3)
    fitted = quality_pu.fit(good, web, 0.6)
    w = np.append(fitted.weights, fitted.bias)
    least = risk(w)
    assert all(risk(w + rng.normal(0, 0.05, len(w))) >= least - 1e-3 for _ in range(20))


@pytest.mark.parametrize("prior", [0.2, 0.6, 0.9])
def test_class_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(5)
    good, web = mixture(rng, 6000, 8000, prior)
    web = rng.permutation(web)
    model = quality_pu.scaled(quality_pu.moments(good, web))
    got = quality_pu.estimated_prior(lambda half, part, *values: part(good[half::2], web[half::2], *values), model)
    assert got == pytest.approx(prior, abs=0.05)


def test_quality_fit_reads_every_row(spark):
    """The sums over the stored table give the model that the same rows give in memory; repeated and null ids count."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 7 = 0")).unionByName(docs.where("doc_id < 5").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_pu.train(docs, labels, prior=0.8)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(known.get(r.doc_id), quality_pu.features(r.text or "")) for r in docs.collect()]
    want = quality_pu.fit(np.array([x for y, x in rows if y == 1]), np.array([x for y, x in rows if y is None]), 0.8)
    assert np.allclose(got.mean, want.mean) and np.allclose(got.scale, want.scale)
    assert np.allclose(got.weights, want.weights, atol=1e-4) and got.bias == pytest.approx(want.bias, abs=1e-4)


# --- language model ----------------------------------------------------------------------------------

def brute_base(rows):
    bags = [(i, suffix_tree.words_of(t) + [b""]) for i, t in rows]
    counts = Counter(w for i, bag in bags if fold(i, 5) != 1 for w in bag)
    n, v = sum(counts.values()), len(counts)
    return [(i, fold(i, 5) == 1, len(bag), sum(w in counts for w in bag), n,
             sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in bag)) for i, bag in bags]


def same_base(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=order)
    want = sorted(want, key=order)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in rows], [r[5] for r in want], rtol=1e-9)


def scored(df):
    held = toxicity.held_out("doc_id", 5, 1)
    return suffix_tree.score(df, ~held).withColumn("held_out", held)


def test_suffix_tree_base_equals_brute_force(spark, odd, real_rows, none):
    same_base(queries.op6_suffix_tree(spark, SF).collect(), brute_base(real_rows))
    same_base(scored(odd).collect(), brute_base(ODD))
    assert scored(none).count() == 0


def test_suffix_tree_beats_base_on_held_out(spark):
    got = [r for r in queries.op6_suffix_tree(spark, SF_MORE).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got) and all(r.score <= 0 for r in got)
    assert np.mean([r.score > r.base_score for r in got]) > 0.8


def test_suffix_tree_is_a_distribution():
    """Every state's distribution sums to one over all symbols, and scores follow the longest retained suffix."""
    rng = random.Random(3)
    stream = [0]
    for _ in range(4000):   # symbol depends on the one before
        stream.append(rng.choice([2, 3]) if stream[-1] in (0, 2) else rng.choice([0, 4, 5]))
    mass = np.bincount(stream, minlength=7) + 0.5
    rows = [np.arange(2, 6).reshape(-1, 1), np.array([[2, 2], [2, 3], [3, 4]])]
    pairs, below = [], []
    for own in rows:
        c = Counter()
        for i in range(own.shape[1], len(stream)):
            for s, ctx in enumerate(own.tolist()):
                if stream[i - len(ctx):i] == ctx:
                    c[s, stream[i]] += 1
        kept = sorted(k for k in c if c[k] >= 3)
        pairs.append((np.array([k[0] for k in kept]), np.array([k[1] for k in kept]), np.array([c[k] for k in kept], float)))
        below.append(np.bincount([k[0] for k in c], [c[k] for k in c], len(own)))
    tree = suffix_tree.grow(rows, pairs, below, mass / mass.sum())
    assert tree.retained[0].any()
    for context in ([2], [3], [2, 2], [3, 4], [6], [5, 3]):
        total = 0.0
        for s in range(7):
            seq = np.array([0, *context, s])
            total += 10 ** tree.scores(seq, np.zeros(len(seq), int))[-1]
        assert total == pytest.approx(1.0, abs=1e-9)


def test_sequences_start_with_an_end():
    symbols, row = suffix_tree.sequences(pa.array([[5, 6, 0], [0], [7, 0]], pa.list_(pa.int32())))
    assert symbols.tolist() == [0, 5, 6, 0, 0, 0, 0, 7, 0] and row.tolist() == [0, 0, 0, 0, 1, 1, 2, 2, 2]


def scores_in_memory(texts, depth):
    """Score of each of a few texts by the tree in memory learned from them."""
    spelled = [[b"^", *suffix_tree.words_of(t), b""] for t in texts]
    counts = Counter(w for t in spelled for w in t[1:])
    symbol = {w: w if n >= suffix_tree.MIN_WORD or not w else (w[-2:],) for w, n in counts.items()} | {b"^": b"^"}
    mass = Counter({symbol[w]: 0.5 for w in symbol if isinstance(symbol[w], tuple)})
    for w, n in counts.items():
        mass[symbol[w]] += n + 0.5
    share = {w: math.log10((n + 0.5) / mass[symbol[w]]) for w, n in counts.items()}
    words = sorted(set(symbol.values()), key=str)
    number = {w: words.index(symbol[w]) for w in symbol}
    root = np.array([max(mass[w], 1e-300) for w in words]) / (sum(mass.values()) + 0.5)
    grams = [Counter(tuple(number[w] for w in t[i:i + m]) for t in spelled for i in range(len(t) - m + 1)) for m in range(1, depth + 2)]
    rows, pairs, below_of = [], [], []
    for m in range(1, depth + 1):
        own = sorted(g for g, n in grams[m - 1].items() if n >= 2 and g[-1] != number[b""])
        at = {g: i for i, g in enumerate(own)}
        kept = sorted((at[g[:-1]], g[-1], n) for g, n in grams[m].items() if g[:-1] in at)
        rows.append(np.array(own).reshape(-1, m))
        pairs.append(tuple(np.array([k[j] for k in kept], float if j == 2 else int) for j in range(3)))
        below_of.append(np.array([grams[m - 1][g] for g in own], float))
    tree = suffix_tree.grow(rows, pairs, below_of, root)
    assert all(r.any() for r in tree.retained[:2])
    return [tree.scores(np.array([number[w] for w in t]), np.zeros(len(t), int)).sum() + sum(share[w] for w in t[1:]) for t in spelled]


def test_suffix_tree_tables_equal_tree_in_memory(spark, docs_of, monkeypatch):
    """Scores from the tables and joins are those of the tree in memory, whatever part of the weights is broadcast."""
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = ["a"]
        for _ in range(rng.randrange(5, 60)):
            words.append(rng.choice(["b", "c"]) if words[-1] == "a" else "a" if words[-2:] == ["c", "b"] else rng.choice("abcdefgh"))
        texts.append(" ".join(words))
    texts[3] += " Éa bé rare1 x x"   # words of a class, one of a single byte
    texts[4] += " seé rare2 rare3 a rare3"
    want = scores_in_memory(texts, suffix_tree.DEPTH)
    for share in (1e-9, 0.01, 1.0):   # all, some and no weights are broadcast
        monkeypatch.setattr(suffix_tree, "HEAVY", share)
        monkeypatch.setattr(suffix_tree, "collect_bounded", lambda df, limit, what: df.toArrow())
        got = suffix_tree.score(docs_of(texts), suffix_tree.F.lit(True)).orderBy("doc_id").collect()
        assert np.allclose([r.score for r in got], want, rtol=1e-9)


def test_suffix_tree_keeps_what_is_rare_in_a_large_corpus(spark, docs_of):
    """A passage seen three times is learned beside any amount of other text."""
    rng = random.Random(6)
    filler = [" ".join(rng.choices("abcdefghij", k=20_000)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(filler + ["quixotic zephyrs vex bold jackdaws"] * 4)]
    last = len(rows) - 1
    got = {r.doc_id: r for r in suffix_tree.score(docs_of(rows), suffix_tree.F.col("doc_id") < last).collect()}
    assert got[last].train_tokens > 500_000
    assert got[last].score - got[last].base_score > 12   # four of its words follow a context


def test_suffix_tree_learns_longer_contexts(spark, docs_of):
    """What follows depends on the word four before: only a context of four symbols tells."""
    rows = [f"{start} and so on {end}" for start, end in (("red", "apple"), ("blue", "sky")) * 30]
    rows += ["red and so on apple", "red and so on sky"]
    n = len(rows)
    got = {r.doc_id: r.score for r in suffix_tree.score(docs_of(rows), suffix_tree.F.col("doc_id") < n - 2).collect()}
    assert got[n - 2] - got[n - 1] > 0.5
