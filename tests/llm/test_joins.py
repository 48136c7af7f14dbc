"""Joins between documents: decontamination, near-duplicates, and the pipeline that uses them."""
from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from llm_rows import ODD, SF

import corpus_pipeline
from churnlens.llm import byte_bpe, decontaminate, jaccard_join, pii, queries, toxicity
from churnlens.session import list_dir, scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- decontamination ---------------------------------------------------------------------------------

def brute_hits(rows, items, window=10):
    wins = set()
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        wins |= {(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)} if n else set()
    by_words = {}
    for item, w in wins:
        by_words.setdefault(w, set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in by_words}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in by_words:
                    hit |= set(range(i, i + n))
                    found |= by_words[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), sorted(str(x) for x in found if x is not None), bool(hit)))
    return out


def got_hits(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids, r.contaminated) for r in df.collect()]


def same(a, b):
    assert sorted(map(str, a)) == sorted(map(str, b))


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_decontaminate_equals_brute_force(spark, docs_of, max_broadcast):
    rng = random.Random(1)
    vocabulary = ["a", "b", "C", "dé", "e1"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 40)))) for i in range(60)] + ODD
    items = [(i, ", ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 8)))) for i in range(12)]
    items += [(20, "one"), (21, "Two"), (22, "one two"), (22, "one two"), (23, None), (24, ""), (None, "three four"), (25, "word " * 12)]
    docs = docs_of(rows, extra=("item_id", "w", "n", "shingle", "start"))
    same(got_hits(decontaminate.find_hits(docs, items_of(spark, items), window=4, max_broadcast=max_broadcast)), brute_hits(rows, items, 4))
    if max_broadcast:
        same(got_hits(decontaminate.find_hits(docs, items_of(spark, items))), brute_hits(rows, items, 10))


def test_decontaminate_empty_tables(spark, docs_of, none):
    assert decontaminate.find_hits(none, items_of(spark, [(1, "a b c")])).count() == 0
    for items in ([], [(1, None), (2, "...")]):
        same(got_hits(decontaminate.find_hits(docs_of(["a b", None]), items_of(spark, items))), [(0, 2, 0, 0, [], False), (1, 0, 0, 0, [], False)])


def test_decontaminate_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.OP1_SQL)
    df = queries.op1_decontaminate(spark, SF)
    assert df.columns == [d[0] for d in cur.description]
    same([tuple(r) for r in df.collect()], cur.fetchall())


def test_decontaminate_uses_no_python(spark):
    plan = queries.op1_decontaminate(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan


# --- near-duplicates ---------------------------------------------------------------------------------

def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def got_components(df):
    return [(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()]


def families(rng, n=70):
    """Chains of edits, exact copies and common passages."""
    vocabulary = [f"w{i}" for i in range(40)]
    common = [rng.choice(vocabulary) for _ in range(12)]
    rows, base = [], []
    for i in range(n):
        if i % 10 == 0 or not base:
            base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 90))] + common
        else:
            base = list(base)
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append((i, " ".join(base).upper() if i % 7 == 0 else "  ".join(base)))
    return rows


@pytest.mark.parametrize(("size", "percent", "block"), [(3, 90, 256), (5, 80, 2), (2, 60, 3), (1, 100, 256)])
def test_near_duplicates_equal_brute_force(docs_of, monkeypatch, size, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)
    rows = families(random.Random(size)) + [(100 + (i or 50), t) if i != 5 else (105, t) for i, t in ODD[:9]]
    rng = random.Random(0)
    rng.shuffle(rows)
    docs = docs_of(rows, extra=("n", "gid", "set_key", "head"))
    same(got_components(jaccard_join.near_duplicates(docs, size=size, percent=percent)), brute_components(rows, size, percent))


def test_near_duplicates_without_broadcast(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MAX_BROADCAST", 0)
    rows = families(random.Random(9), 30)
    same(got_components(jaccard_join.near_duplicates(docs_of(rows), size=3, percent=80)), brute_components(rows, 3, 80))


def test_near_duplicates_odd_rows(odd, none):
    same(got_components(jaccard_join.near_duplicates(odd, size=3, percent=90)), brute_components(ODD, 3, 90))
    assert jaccard_join.near_duplicates(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_near_duplicates_query(spark, real_rows):
    same(got_components(queries.op2_jaccard_join(spark, SF)), brute_components(real_rows, 3, 90))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200 - i, 199 - i) for i in range(30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.component for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_keep_one(docs_of):
    same_text = "a b c d e f g h"
    rows = [(3, same_text), (2, same_text.upper()), (2, same_text), (2, same_text), (9, "else where x y z"), (None, same_text), (None, None), (4, ""), (4, "")]
    kept = jaccard_join.keep_one(docs_of(rows, extra=("n", "component"))).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept)[:3] == [("2", kept[[r.doc_id for r in kept].index(2)].text), ("4", ""), ("4", "")]
    assert len(kept) == 5 and [r.doc_id for r in kept].count(2) == 1


# --- pipeline ----------------------------------------------------------------------------------------

def test_pipeline_equals_brute_force(spark, real_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out("doc_id", 5, 0))
    model = toxicity.train(docs, labels)
    fine = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}   # the classifier itself is tested by its accuracy
    rows = [(i, t) for i, t in real_rows if i in fine]
    rows = [(r[0], t) for r, (_, t) in zip(brute_components(rows, 5, 80), rows) if r[0] == r[2]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {h[0] for h in brute_hits(rows, items) if not h[5]}
    finder, (ranks, pattern) = pii.Finder(), byte_bpe.public_vocabulary()
    import tiktoken
    library = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in rows:
        if i in clean:
            done, out = 0, ""
            for a, b, k in sorted((a, -b, k) for k, own in finder(t or "").items() if k in pii.MASKED_KINDS for a, b in own):
                out, done = (out + t[done:a] + f"<{k.upper()}>", -b) if a >= done else (out, max(done, -b))
            ids = library.encode_ordinary(out + (t or "")[done:])
            want[i] = (len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest())
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, hashlib.sha256(bytes(r.ids)).hexdigest()) for r in got} == want and len(got) == len(want)
    assert all(r.round_trip for r in got)


def test_pipeline_stages_take_odd_rows(spark, odd, none):
    for docs, n in ((odd, len(ODD)), (none, 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "byte_bpe":
                assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            assert out.count() <= n
            if name in ("decontaminate", "pii", "byte_bpe"):
                assert out.count() == n


def test_band_counts_bound_every_overlap(monkeypatch):
    """The sum of minima is never below the overlap, also where a band holds more than its count can say."""
    import numpy as np
    rng = np.random.default_rng(7)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    for top in (0xFFFF, 3):
        own = jaccard_join.band_counts
        if top == 3:   # a count that holds 3 at most
            monkeypatch.setattr(jaccard_join, "band_counts", lambda s: np.full_like(own(s), 0xFFFF) if own(s).max(initial=0) > 3 else own(s))
        for _ in range(200):
            a, b = (np.sort(rng.choice(pool, rng.integers(1, 600), replace=False)) for _ in range(2))
            bound = np.minimum(jaccard_join.band_counts(a), jaccard_join.band_counts(b)).sum(dtype=np.int64)
            assert bound >= len(np.intersect1d(a, b))
    many = np.arange(70_000, dtype=np.uint64)   # all in one band
    assert set(own(many)) == {0xFFFF} and own(many[:0]).sum() == 0



def test_pipeline_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard", "decontaminate", "pii", "byte_bpe"]
    import __spark_entry__ as entry
    assert {"pipeline", *queries.llm_queries()} <= set(entry.queries()) and len(queries.llm_queries()) == 13


def test_prefix_candidates_are_dealt_without_what_their_group_has_in_common(spark):
    """Only (gid, late, shingle) is dealt by shingle; the lists are those of an order computed by hand, late places included."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = [" ".join(base[:rng.randint(1, 90)] + [f"x{rng.randint(0, 3)}"] * rng.randint(0, 2)) for _ in range(60)] + ["a b c", "a b c", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    jaccard_join.small_batches(spark)
    rows = jaccard_join.stored(jaccard_join._profile(docs, 5, 80), "test-profiles")
    shared = spark.sparkContext.broadcast(jaccard_join._shared_bits(rows.selectExpr("explode(candidates) AS shingle")))
    assert jaccard_join._maybe_shared(rows, shared).columns == ["gid", "late", "shingle"]
    held = [r for r in rows.collect() if r["n"]]
    seen = {}
    for r in held:
        for s in r["candidates"]:
            seen[s] = seen.get(s, 0) + 1
    want, late = set(), 0
    for r in held:
        c, k = r["candidates"], r["n_counted"]
        own = sorted((seen[s], s) for s in c[:k] if seen[s] > 1)
        places = [(k - len(own) + i, s) for i, (_, s) in enumerate(own)] + [(i, s) for i, s in enumerate(c) if i >= k and seen[s] > 1]
        length = r["n"] - -(-80 * r["n"] // 100) + 1
        late += any(p >= k and p < length for p, _ in places)
        want |= {(r["gid"], r["n"], s, r["n"] - p) for p, s in places if p < length}
    got = [tuple(r) for r in jaccard_join._prefix_lists(rows, 80).select("gid", "n", "shingle", "rest").collect()]
    assert late and len(got) == len(set(got)) and set(got) == want


def dealt_with(df, column):
    """Rows that the shuffles of a frame, which was collected, dealt out with this column."""
    seen, total = set(), 0

    def walk(node):
        nonlocal total
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ReusedExchangeExec":
            return walk(node.child())
        if kind == "ShuffleExchangeExec" and node.id() not in seen and f"{column}#" in node.output().mkString(" "):
            seen.add(node.id())
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_rows_that_stay_are_not_dealt_out(spark, docs_of):
    """Only texts of rows that go or are repeated are shuffled, also where no table is broadcast."""
    rng = random.Random(3)
    texts = [" ".join(str(rng.random()) for _ in range(30)) for _ in range(400)]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i]) for i in range(20)] + [(7, texts[7]), (500, None), (500, None), (None, texts[9])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard_join.keep_one(docs_of(rows))
        assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
            (str(i), t) for i, t in list(enumerate(texts)) + [(500, None), (500, None)])
        assert 0 < dealt_with(kept, "text") <= 2 * 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_near_duplicates_remove_what_no_later_step_reads(spark, docs_of):
    """Of the tables that are stored on the way only those stay that the lazy result reads; the candidates are the largest."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(30)]
    rows += [(100 + i, f"{t} more") for i, (_, t) in enumerate(rows)]
    folder = scratch_path(spark, "llm")
    before = {p.rsplit("/", 1)[1] for p in list_dir(spark, folder)}
    found = jaccard_join.near_duplicates(docs_of(rows), size=2, percent=80)
    left = {p.rsplit("/", 1)[1] for p in list_dir(spark, folder)} - before
    assert not {n for n in left if n.startswith(("profiles", "frequencies", "prefixes", "lists", "met-", "member", "cells", "planned"))}
    same(got_components(found), brute_components(rows, 2, 80))
