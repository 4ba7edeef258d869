import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import graph, simhash
from riskweave.llm.graph import components
from tests.llm.cases import no_docs, odd_docs, white_words


def plain_fingerprint(text):
    words = white_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_whole_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(fps, 4)
    want = {rows[i].doc_id: (f"{fps[i]:016x}", rows[roots[i]].doc_id) for i in range(len(rows))}
    from riskweave.llm.queries import op6_simhash

    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, sf).collect()}
    assert got == want


def clustered(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        out.add(base)
        for _ in range(rng.choice([0, 0, 3, 8])):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                base ^= 1 << b
            out.add(base)
    return sorted(out)[:n]


@pytest.mark.parametrize("equal", [1, 2, 3])
def test_links_are_exact_in_every_layout(spark, monkeypatch, equal):
    fps = clustered(1500, equal)
    blocks = 4 + equal
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    monkeypatch.setattr(simhash, "layout", lambda n, r: (widths, equal))
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) * 2 for f in fps], "id long, fp long")
    stars = components(simhash.links(nodes, 4)).collect()
    got = {r.u.fp: r.root.fp for r in stars}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    roots = plain_components(fps, 4)
    groups = {}
    for i, r in enumerate(roots):
        groups.setdefault(r, []).append(signed[i])
    want = {f: min(g) for g in groups.values() for f in g if f != min(g)}
    assert got == want


@pytest.mark.parametrize("heavy", [1_000, 1, 10**9])
def test_hot_shard_is_cut_into_chunks(spark, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "CHUNK", 64)
    monkeypatch.setattr(graph, "HEAVY", heavy)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = sorted({base ^ rng.getrandbits(12) for _ in range(700)})
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f, f) for f in signed], "id long, fp long")
    groups = simhash._groups(nodes, simhash._keys(F.col("fp"), *simhash.layout(len(fps), 4)))
    assert groups.groupBy("key", "a", "b").count().agg(F.max("count")).first()[0] < 64 * 4
    assert groups.filter("b > 0").count() > 0
    got = {r.u.fp: r.root.fp for r in components(simhash.links(nodes, 4)).collect()}
    roots = plain_components(fps, 4)
    groups_ = {}
    for i, r in enumerate(roots):
        groups_.setdefault(r, []).append(signed[i])
    assert got == {f: min(g) for g in groups_.values() for f in g if f != min(g)}


@pytest.mark.parametrize("heavy", [1_000, 3])
@pytest.mark.parametrize("local", [graph.LOCAL, 40])
def test_components_of_chains_hubs_and_repeats(spark, monkeypatch, local, heavy):
    monkeypatch.setattr(graph, "LOCAL", local)
    monkeypatch.setattr(graph, "HEAVY", heavy)
    rng = random.Random(8)
    edges = [(i, i - 1) for i in range(1, 60)] + [(500, i) for i in range(501, 800)] + [(900, 900), (None, 3), (4, None)]
    edges += [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(180)] + [(501, 500)] * 50
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for u, v in edges:
        if u is not None and v is not None:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    want = {i: find(i) for i in root if find(i) != i}
    df = spark.createDataFrame(edges, "u long, v long").repartition(3)
    assert {r.u: r.root for r in components(df).collect()} == want
    pair = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col(c) % 7).alias("id"), F.col(c).alias("fp"))).alias(c)
    got = {(r.u.id, r.u.fp): (r.root.id, r.root.fp) for r in components(df.select(pair("u"), pair("v"))).collect()}
    groups = {}
    for i in root:
        groups.setdefault(find(i), []).append((i % 7, i))
    assert got == {x: min(g) for g in groups.values() for x in g if x != min(g)}
    assert components(df.limit(0)).collect() == []


@pytest.mark.parametrize("heavy", [1_000, 1, 10**9])
def test_joins_with_hot_keys(spark, monkeypatch, heavy):
    monkeypatch.setattr(graph, "HEAVY", heavy)
    rows = [(i % 5 if i % 3 else 7, i) for i in range(60)] + [(None, 99), (50, 98)]
    df = spark.createDataFrame(rows, "k long, x long")
    sizes = {}
    for k, _ in rows:
        sizes[k] = sizes.get(k, 0) + 1
    names = spark.createDataFrame([(k, n, f"name {k}") for k, n in sizes.items() if k not in (None, 50)], "k long, n long, name string")
    want = sorted(((k, x, f"name {k}") for k, x in rows if k not in (None, 50)), key=repr)
    assert sorted(map(tuple, graph.hot_join(df, names, "k", len(rows)).collect()), key=repr) == want
    left = sorted(want + [(None, 99, None), (50, 98, None)], key=repr)
    assert sorted(map(tuple, graph.hot_join(df, names, "k", len(rows), "left").collect()), key=repr) == left


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd_docs(spark).withColumn("fp", F.lit("clash"))).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[1] == by[2] == {(by[1].copy().pop()[0], 1)}
    assert by[3] == by[4] == by[5] == {(0, 3)}
    assert by[None].pop()[1] is None
    # One id, texts of its own: two nodes with one name.
    twice = spark.createDataFrame([(5, "a b c d e f"), (5, "u v w x y z"), (6, "u v w x y z")], "doc_id long, text string")
    assert sorted(r.component_id for r in simhash.near_duplicates(twice).collect()) == [5, 5, 5]
    assert len({r.fp for r in simhash.near_duplicates(twice).collect()}) == 2
    assert simhash.near_duplicates(no_docs(spark)).collect() == []
