import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import bloom_lm as lm
from tests.llm.cases import no_docs, odd_docs, white_words


def plain(rows, remainder=2, modulus=7):
    """(doc_id, n_tokens, n_known, train_tokens, base) of each row, by counting."""
    out, counts = [], Counter()
    for doc_id, text in rows:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus != remainder:
            counts.update([*white_words(text), None])
    n, v = sum(counts.values()), len(counts)
    for doc_id, text in rows:
        tokens = [*white_words(text), None]
        base = sum(log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    for a, b in zip(got, sorted(plain(rows), key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("frequent", [0, 300, lm.FREQUENT])
def test_base_scores_are_exact(spark, sf, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    from riskweave.llm.queries import op3_bloom_lm

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op3_bloom_lm(spark, sf).collect()
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_filter_reads_counts_back():
    rng = np.random.default_rng(1)
    keys = lm.mix(np.arange(40_000, dtype=np.uint64))
    n = np.floor(rng.pareto(0.7, 40_000) + 1).astype(np.int64)
    blocks = 8
    made = lm.Filter.block_of(keys, blocks)
    bits = np.concatenate([lm.build_block(keys[made == b], n[made == b]) for b in range(blocks)])
    f = lm.Filter(blocks, bits)
    read = f.level(keys)
    assert (read >= lm.levels(n)).all()  # never too low
    assert (read > lm.levels(n)).mean() < 0.06
    others = f.level(lm.mix(np.arange(1 << 40, (1 << 40) + 40_000, dtype=np.uint64)))
    assert (others > 0).mean() < 0.06
    low = lm._MEANING[lm.levels(np.array([1, 2, 3, 4, 5, 6, 7]))]
    assert low.tolist() == [1, 2, 3, 4.5, 4.5, 6.5, 6.5]


def test_packed_keys_and_counts_come_back():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 1000):
        for spread in (2**20, 2**63):
            keys = np.unique(rng.integers(0, spread, size, dtype=np.uint64)) << np.uint64(1)
            assert lm.unpack(lm.pack(keys, lm._ODD), lm._ODD).tolist() == keys.tolist()
            n = rng.choice([1, 2, 254, 255, 256, 10**12], len(keys))
            assert lm.unpack_counts(lm.pack_counts(n), len(n)).tolist() == n.tolist()
    edges = np.array([0, 1 << 16, (1 << 64) - (1 << 16)], np.uint64)
    assert lm.unpack(lm.pack(edges, lm._PAIR_SHIFT), lm._PAIR_SHIFT).tolist() == edges.tolist()


@pytest.mark.parametrize("gather, part", [(lm.GATHER, lm.PART_BYTES), (3_000, 10_000)])
def test_counts_of_all_words_and_repeated_bigrams(spark, sf, monkeypatch, gather, part):
    monkeypatch.setattr(lm, "GATHER", gather)
    monkeypatch.setattr(lm, "PART_BYTES", part)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    want = Counter()
    for r in docs.collect():
        for _, _, words, at in lm.chunk_words(lm.pa.array([r.text]), lm.WHITE):
            for keys in lm.ngrams(words, at)[:2]:
                want.update(keys.tolist())
    got, tokens = {}, 0
    for r in lm.counts(docs).collect():
        w, wn, p, pn = lm.decode(r.asDict())
        assert not set(got) & set(w.tolist())
        got |= dict(zip(w.tolist(), wn.tolist(), strict=True)) | dict(zip(p.tolist(), pn.tolist(), strict=True))
        tokens += r.tokens
    assert got == {k: n for k, n in want.items() if k % 2 == 0 or n >= 2}
    assert tokens == sum(n for k, n in want.items() if k % 2 == 0)


@pytest.mark.parametrize("shards", [False, True])
def test_scores_by_definition(spark, sf, monkeypatch, shards):
    """Smoothed bigram probabilities with quantised counts, by plain counting; the filter is made so
    large that it confuses next to nothing."""
    monkeypatch.setattr(lm, "INSERT_BITS", 400)
    if shards:
        monkeypatch.setattr(lm, "FILTER_BITS", lm.BLOCK_BITS)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    one, two = Counter(), Counter()
    for doc_id, text in rows:
        if train(doc_id):
            tokens = [*white_words(text), None]
            one.update(tokens)
            two.update(zip(["<", *tokens[:-1]], tokens, strict=True))
    n, v = sum(one.values()), len(one)
    of = lambda c: lm._MEANING[lm.levels(np.array([c]))][0] if c else 0.0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).collect()}
    near = 0
    for doc_id, text in rows:
        total, before = 0.0, "<"
        for w in [*white_words(text), None]:
            c2 = two[before, w]
            c2, c1, cw = of(c2 if c2 > 1 else 0), of(one[None if before == "<" else before]), of(one[w])
            total += log10((c2 + lm.MU * (cw + 1) / (n + v + 1)) / (max(c1, c2) + lm.MU))
            before = w
        near += got[doc_id] == pytest.approx(total, rel=1e-9)
    assert near >= 0.95 * len(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark).select("doc_id", "text", F.lit(1).alias("key"), F.lit(2).alias("n"), F.lit(3).alias("score"), F.lit(4).alias("_row"))
    got = lm.score(docs, F.lit(True)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[3].n_tokens == by[4].n_tokens == by[5].n_tokens == 1
    assert by[7].n_tokens == 120_001
    assert by[None].n_known == by[None].n_tokens
    nothing = lm.score(odd_docs(spark).select("doc_id", "text"), F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in nothing} == {(0, 0, 0.0, 0.0)}
    assert lm.score(no_docs(spark), F.lit(True)).collect() == []


def test_a_filter_in_shards_gives_the_scores_of_a_whole_one(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(5).alias("n_tokens"), F.lit("x").alias("extra"))
    docs = docs.union(odd_docs(spark).selectExpr("doc_id", "text", "5", "'x'"))
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2

    def rows():
        got = lm.score(docs, train)
        assert got.columns == ["doc_id", "extra", "n_tokens", "score", "n_known", "train_tokens", "base_score"]
        return sorted([(r.doc_id or -1, r.extra, r.n_tokens, r.n_known, r.base_score, r.score) for r in got.collect()])

    whole = rows()
    monkeypatch.setattr(lm, "PART_BYTES", 50_000)
    monkeypatch.setattr(lm, "UNIT_BYTES", 100_000)
    for shard_bits in (lm.BLOCK_BITS, lm.BLOCK_BITS * 4):
        monkeypatch.setattr(lm, "FILTER_BITS", lm.BLOCK_BITS)
        monkeypatch.setattr(lm, "SHARD_BITS", shard_bits)
        cut = rows()
        assert [r[:4] for r in cut] == [r[:4] for r in whole]
        assert np.allclose([r[4:] for r in cut], [r[4:] for r in whole], rtol=1e-12, atol=0)


@pytest.mark.parametrize("shards", [False, True])
def test_op3_stores_bigrams_seen_once(spark, tmp_path, monkeypatch, shards):
    """Each training text's own bigrams are known, however often they were seen."""
    from riskweave.llm.queries import op3_bloom_lm

    monkeypatch.setattr(lm, "INSERT_BITS", 4_000)
    if shards:
        monkeypatch.setattr(lm, "FILTER_BITS", lm.BLOCK_BITS // 2)
    rows = [(i, f"a{i} b{i} a{i} c b{i} c") for i in range(40)] + [(40, None), (41, "c c")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    one, two = Counter(), Counter()
    for doc_id, text in rows:
        if train(doc_id):
            tokens = [*white_words(text), None]
            one.update(tokens)
            two.update(zip(["<", *tokens[:-1]], tokens, strict=True))
    n, v = sum(one.values()), len(one)
    of = lambda c: lm._MEANING[lm.levels(np.array([c]))][0] if c else 0.0
    for r in op3_bloom_lm(spark, str(tmp_path)).collect():
        total, before = 0.0, "<"
        for w in [*white_words(dict(rows)[r.doc_id]), None]:
            c2, c1, cw = of(two[before, w]), of(one[None if before == "<" else before]), of(one[w])
            total += log10((c2 + lm.MU * (cw + 1) / (n + v + 1)) / (max(c1, c2) + lm.MU))
            before = w
        assert r.score == pytest.approx(total, rel=1e-9)
