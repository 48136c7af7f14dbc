"""Merkle manifest, periodic runs and sharding against brute force on small tables."""
from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from llm_rows import ODD, SF, collect
from pyspark.sql import functions as F

from churnlens.llm import merkle, queries, runs, sharding


def sha(text) -> str:
    return hashlib.sha256(text.encode("utf-8") if isinstance(text, str) else text).hexdigest()


def by_null(x):
    return (x is not None, x if x is not None else 0)


# --- Merkle manifest -----------------------------------------------------------------------------------

def brute_tree(leaves, arity):
    """(top, per leaf its (before, behind) hex texts of each level)."""
    level, at, steps = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p // arity * arity
            steps[i].append(("".join(level[run:p]), "".join(level[p + 1:run + arity])))
            at[i] = p // arity
        level = [sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)]
    return level[0], steps


def brute_manifest(rows, arity):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((sha("".join(field(r[i]) for i in (0, 3, 2, 4, 1))), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    out, tops = [], []
    for s in names:
        own = sorted(trees[s], key=lambda x: (by_null(x[1][0]), x[0]))
        top, steps = brute_tree([x[0] for x in own], arity)
        tops.append(top)
        out.append([(r, leaf, top, st) for (leaf, r), st in zip(own, steps)])
    if not tops:
        return []
    root, upper = brute_tree(tops, arity)
    return [(r[0], leaf, top, root, sha("".join(a + b for a, b in st + upper[i]))) for i, part in enumerate(out) for r, leaf, top, st in part]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def got_manifest(df, arity):
    found = merkle.manifest(merkle.leaves(df, queries.LEAF_FIELDS, "source", "doc_id"), arity)
    hexed = [merkle.hex_text(F.col(c)).alias(c) for c in ("digest", "subroot", "root")]
    back = (merkle.folded(F.col("digest"), F.col("path")) == F.col("root")).alias("back")
    rows = found.select("id", *hexed, merkle.hex_text(merkle.proof_digest(F.col("path"))).alias("proof"), back).collect()
    assert all(r.back for r in rows)
    return [tuple(r)[:5] for r in rows]


@pytest.mark.parametrize("arity,n", [(2, 37), (3, 60), (16, 400)])
def test_merkle_equals_brute_force(spark, arity, n):
    rng = random.Random(arity)
    rows = [(rng.randrange(n), rng.choice(["a", "é漢", "", None]), None, rng.choice(["hot", "hot", "hot", "b", None, ""]), i % 3) for i in range(n)]
    rows += [(i, t, "en", "odd", None) for i, t in ODD] + [(5, "x", "en", "lone", 1)] + [(None, "x", None, None, None)] * 3
    assert sorted(map(str, got_manifest(frame(spark, rows), arity))) == sorted(map(str, brute_manifest(rows, arity)))


def test_merkle_edges(spark):
    assert got_manifest(frame(spark, []), 16) == []
    one = got_manifest(frame(spark, [(1, "a", None, None, None)]), 16)
    assert one == brute_manifest([(1, "a", None, None, None)], 16) and one[0][1] == one[0][2] == one[0][3] and one[0][4] == sha("")
    lone_last = [(i, "t", "en", "s", 1) for i in range(17)]   # the last run holds one node, which is hashed again
    assert sorted(got_manifest(frame(spark, lone_last), 16)) == sorted(brute_manifest(lone_last, 16))


def test_merkle_detects_every_changed_field(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(40)]
    other = merkle.leaf([F.col("doc_id"), F.lit("s"), F.col("lang"), F.col("n_chars"), F.concat("text", F.lit("!"))])
    df = frame(spark, rows)
    found = merkle.manifest(merkle.leaves(df, queries.LEAF_FIELDS, "source", "doc_id", {"other": other}))
    assert found.where(merkle.folded(F.col("other"), F.col("path")) == F.col("root")).count() == 0


def test_merkle_ignores_extra_columns_and_partitioning(spark, odd):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    wide = plain.withColumns({c: F.lit("x") for c in ("tree", "id", "digest", "row", "slot", "run", "path", "root", "idx")})
    assert sorted(map(str, got_manifest(plain.repartition(7), 16))) == sorted(map(str, got_manifest(wide.coalesce(1), 16)))


@pytest.mark.parametrize("name", ["op11_merkle", "op13_sharding"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(queries.llm_oracle_sql()[name])
    df = queries.llm_queries()[name](spark, SF)
    assert df.columns == [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in df.collect()) == sorted(cur.fetchall())


# --- periodic runs --------------------------------------------------------------------------------------

def brute_runs(w):
    out, seen = [], set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def got_runs(texts):
    _, numbers, limits = runs._numbers(texts)
    first, out = np.concatenate([[0], limits + 1]), [[] for _ in texts]
    for s, e, q in runs.find(numbers, limits).tolist():
        d = int(np.searchsorted(limits, s))
        out[d].append((s - int(first[d]), e - s, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def repetitive(rng):
    """Texts of long and short periods, periods inside periods, and stretches just short of four periods."""
    unit = [rng.choice("abcde"[:rng.randrange(1, 6)]) for _ in range(rng.randrange(1, 90))]
    kind = rng.randrange(5)
    if kind == 0:
        unit = unit[:rng.randrange(1, 5)] * rng.randrange(1, 20) + ["c"] * rng.randrange(0, 3)
    if kind == 1:
        unit = ["a"] * rng.randrange(1, 70) + ["b"] * rng.randrange(0, 4)
    times = len(unit) * (3 + rng.random() * 3)
    body = (unit * 7)[:int(times)]
    return [rng.choice("abc") for _ in range(rng.randrange(30))] + body + [rng.choice("xa") for _ in range(rng.randrange(30))] + (body if kind == 2 else [])


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(repetitive(rng)) for _ in range(10)] + ["", None, " \n", "one"]
        assert got_runs(texts) == [brute_runs((t or "").split()) for t in texts]


def test_runs_do_not_cross_texts_and_know_words_exactly():
    assert got_runs(["a a a", "a a a", "a A a A a A"]) == [[], [], []]
    assert got_runs(["é é é é é é", "\x1c \x1c \x1c \x1c \x1c \x1c"]) == [[(0, 6, 1)], [(0, 6, 1)]]


def test_runs_wrong_hashes_change_nothing(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(repetitive(rng)) for _ in range(20)]
    want = got_runs(texts)
    monkeypatch.setattr(runs, "mix64", lambda x: x & np.uint64(1))   # hashes of unequal words agree
    assert got_runs(texts) == want


def test_runs_of_odd_rows(spark, odd, none):
    rows = collect(runs.find_runs(odd.drop("n")))
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by_id[7].runs] == [(0, 60_000, 1)] and by_id[7].collapsed == "word" and by_id[7].n_words == 60_000
    assert by_id[1].runs == by_id[2].runs == by_id[3].runs == [] and by_id[1].collapsed == by_id[3].collapsed == ""
    assert {"score", "spans", "key", "word"} <= set(rows[0].asDict())
    assert runs.find_runs(none).count() == 0


def test_runs_query_equals_brute_force(spark, real_rows):
    def want(doc, text):
        w, h = (text or "").encode().split(), zlib.crc32(str(doc).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found, keep = brute_runs(w), [True] * n
        for s, length, q in found:
            keep[s + q:s + length] = [False] * (length - q)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
        return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)),
                sha(b" ".join(x for x, k in zip(w, keep) if k)))
    assert sorted(map(tuple, queries.op12_runs(spark, SF).collect())) == sorted(want(*r) for r in real_rows)


# --- sharding -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 255, 1024, 1025, 5000])
def test_permutation_and_its_inverse(n):
    rows = np.arange(n)
    p = sharding.permute(rows, n)
    assert sorted(p) == list(range(n)) and (sharding.permute(p, n, inverse=True) == rows).all()
    shard, slot = sharding.place(rows, n)
    assert (sharding.row_at(shard, slot, n) == rows).all()
    if n > 1000:
        assert (p != sharding.permute(rows, n, seed=1)).any() and abs(np.corrcoef(rows, p)[0, 1]) < 0.1


def test_shards_are_even_gapless_and_reproducible(spark, odd):
    df = odd.select("doc_id", F.col("text").isNotNull().alias("has_text"), F.sha2("text", 256).alias("text_hash"), F.lit(1).alias("slot"))
    a = sharding.assign(df, ["doc_id", "has_text", "text_hash"], shards=4)
    b = sharding.assign(df.repartition(5), ["doc_id", "has_text", "text_hash"], shards=4)
    assert a.columns == ["doc_id", "has_text", "text_hash", "row", "shard", "slot"]
    rows = sorted(map(str, a.collect()))
    assert rows == sorted(map(str, b.collect())) and len(rows) == len(ODD)
    slots = {}
    for r in a.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(i, [])) for i in range(4)) <= 1


def test_shards_of_few_rows(spark, none, docs_of):
    assert sharding.assign(none, ["doc_id"]).count() == 0
    assert len({r["shard"] for r in sharding.assign(docs_of(["a", "b", None]), ["doc_id"]).collect()}) == 3


def test_written_shards_hold_the_rows_in_slot_order(spark, docs_of, tmp_path):
    df = docs_of([f"text {i}" for i in range(50)])
    sharding.write(df, ["doc_id"], str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.text for r in back.collect()) == sorted(f"text {i}" for i in range(50))
    shard, slot = sharding.place(np.arange(50), 50, 3)
    assert {(r.doc_id, r["shard"], r["slot"]) for r in back.collect()} == set(zip(range(50), shard.tolist(), slot.tolist()))
