import hashlib

import numpy as np
import pytest
import xxhash

from riskweave.llm import imatch
from riskweave.llm.queries import op5_imatch
from tests.llm.cases import LONG, no_docs, odd_docs


def edit(text, after):
    n = len(text)
    return text[: n - n // 2] + after[: n // 2]


@pytest.mark.parametrize("ranges", [1, 4, 40])
def test_every_row_meets_its_successor(spark, sf, monkeypatch, ranges):
    monkeypatch.setattr(imatch, "RANGES", ranges)
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in op5_imatch(spark, sf).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for row, after in zip(rows, rows[1:] + rows[:1], strict=True):
        r = got[row.doc_id]
        assert r.n_chars == len(row.text)
        assert r.edited_sha256 == hashlib.sha256(edit(row.text, after.text).encode()).hexdigest()
        assert r.near_next == imatch.likeness(r.fingerprint, got[after.doc_id].fingerprint)
        assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
        assert by_text.setdefault(row.text, r.fingerprint) == r.fingerprint
    edited = np.mean([r.near_edited for r in got.values()])
    assert edited > 5 * np.mean([r.near_next for r in got.values()])


@pytest.mark.parametrize("rare, common", [(imatch.RARE, imatch.COMMON), (0.02, 0.2), (0.3, 0.1)])
def test_lexicon_is_the_band(spark, sf, monkeypatch, rare, common):
    monkeypatch.setattr(imatch, "RARE", rare)
    monkeypatch.setattr(imatch, "COMMON", common)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    df = {}
    for t in texts:
        for w in imatch.terms(t.encode()).tolist():
            df[w] = df.get(w, 0) + 1
    band = np.array([w for w, n in df.items() if max(2, rare * len(texts)) <= n <= common * len(texts)], np.uint64)
    assert imatch.lexicon(docs).tolist() == sorted(band[imatch.chosen(band).any(axis=1)].tolist())


def plain_fingerprint(text, df, total):
    """The definition, term by term: which of them are in the band and a subset, and a hash of each part."""
    found = sorted({int(w) for w in imatch.terms(text.encode())})
    if not found:
        return "0" * (imatch.SUBSETS * imatch.PART)
    band = [w for w in found if max(2, imatch.RARE * total) <= df.get(w, 0) <= imatch.COMMON * total]
    parts = []
    for j in range(imatch.SUBSETS):
        seed = int(imatch.mix(np.array([j + 1], np.uint64))[0])
        halvings = imatch.FIRST_HALVING + j % 8
        inside = [w for w in band if int(imatch.mix(np.array([w ^ seed], np.uint64))[0]) < 1 << (64 - halvings)]
        raw = b"".join(w.to_bytes(8, "little") for w in inside)
        parts.append(f"{max(1, xxhash.xxh32_intdigest(raw)):08x}" if inside else "0" * imatch.PART)
    if not any(p.strip("0") for p in parts):
        return f"{max(1, xxhash.xxh32_intdigest(b''.join(w.to_bytes(8, 'little') for w in found))):08x}" * imatch.SUBSETS
    return "".join(parts)


def test_fingerprints_by_definition(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rare = [(10_000 + i, f"only{i} here{i}") for i in range(3)] + [(10_003, "both rare"), (10_004, "rare both")]
    docs = spark.createDataFrame([*map(tuple, rows), *rare], "doc_id long, text string")
    texts = {r[0]: r[1] for r in [*rows, *rare]}
    df = {}
    for t in texts.values():
        for w in imatch.terms(t.encode()).tolist():
            df[w] = df.get(w, 0) + 1
    got = {r.doc_id: r.fingerprint for r in imatch.compare(docs).collect()}
    short = sorted(texts, key=lambda i: len(texts[i]))[:60]
    for i in short:
        assert got[i] == plain_fingerprint(texts[i], df, len(texts))
    # Texts of rare terms only: equal for equal terms, else different.
    assert len({got[i] for i, _ in rare}) == 4 and got[10_003] == got[10_004]


def test_likeness_of_copies_and_edits():
    rng = np.random.default_rng(4)
    vocabulary = [f"term{i}" for i in range(4000)]
    known = np.sort(np.concatenate([imatch.terms(w.encode()) for w in vocabulary]))
    words = rng.choice(vocabulary, 300).tolist()
    one = imatch.fingerprint(" ".join(words).encode(), known)
    assert one == imatch.fingerprint(" ".join(reversed(words)).upper().encode(), known)
    near = words[:]
    near[::100] = ["other"] * 3
    far = rng.choice(vocabulary, 300).tolist()
    likes = [imatch.likeness(one, imatch.fingerprint(" ".join(x).encode(), known)) for x in (near, words[:150] + far[150:], far)]
    assert likes[0] > 0.6 > likes[1] > likes[2]


def test_odd_rows(spark):
    rows = imatch.compare(odd_docs(spark)).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.fingerprint for k in (3, 4, 5) for r in by[k]} == {"0" * 256}
    assert by[3][0].near_next == 1.0 and by[3][0].n_chars == 0
    assert {r.fingerprint for r in by[1] + by[2]} == {by[1][0].fingerprint}
    assert by[7][0].n_chars == len(LONG)
    first = by[1][0]
    text = odd_docs(spark).filter("doc_id = 1").first().text
    last = odd_docs(spark).filter("doc_id is null").first().text
    assert first.edited_sha256 == hashlib.sha256(edit(text, text).encode()).hexdigest()
    assert by[None][0].edited_sha256 == hashlib.sha256(edit(last, text).encode()).hexdigest()
    assert imatch.compare(no_docs(spark)).collect() == []
    alone = odd_docs(spark).filter("doc_id = 8")
    assert imatch.compare(alone).first().near_next == 1.0
