import math
import random
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import decontaminate as d
from riskweave.llm.queries import op4_decontaminate
from tests.llm.cases import no_docs, odd_docs


def plain_hits(index, words):
    """Every part scored against every passage, without any skipping."""
    out = {}
    for passage in range(max(1, -(-len(words) // d.SPAN))):
        a = passage * d.SPAN
        at_hand = set(words[a : a + 2 * d.SPAN].tolist())
        near = words[max(0, a - d.SPAN) : a + 3 * d.SPAN]
        for part in index.parts:
            score = sum(g for w, g in zip(part.words.tolist(), part.impacts.tolist(), strict=True) if w in at_hand)
            if score >= d.THRESHOLD:
                q, s = d.share(part.question, near), d.share(part.answer, near)
                if min(q, s) >= d.OVERLAP:
                    out[part.item] = max(out.get(part.item, (0, 0, 0)), (round(score, 9), q, s))
    return out


def search(index, *texts):
    words = [d.words_of(t) for t in texts]
    return index.search(np.concatenate(words), np.concatenate(([0], np.cumsum([len(w) for w in words]))))


def test_impacts_are_bm25():
    texts = ["alpha beta gamma delta beta", "alpha epsilon zeta eta theta iota", "kappa beta lambda mu nu"]
    index = d.Index(list(enumerate(texts)))
    df = Counter(w for t in texts for w in set(t.split()))
    mean = sum(len(t.split()) for t in texts) / 3
    for part in index.parts:
        tf = Counter(texts[part.item].split())
        size = sum(tf.values())
        raw = {
            w: math.log(1 + (3 - df[w] + 0.5) / (df[w] + 0.5)) * n * (d.K1 + 1) / (n + d.K1 * (1 - d.B + d.B * size / mean))
            for w, n in tf.items()
        }
        want = {int(d.words_of(w)[0]): g / sum(raw.values()) for w, g in raw.items()}
        assert dict(zip(part.words.tolist(), part.impacts.tolist(), strict=True)) == pytest.approx(want)


def test_skipping_loses_nothing():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(120)]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n)) + "."
    items = [(i, sentence(rng.randint(3, 60)) + " " + sentence(rng.randint(1, 90))) for i in range(60)]
    index = d.Index(items)
    texts = []
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 300))
        for _ in range(rng.randint(0, 2)):
            leak = rng.choice(items)[1].split()
            for i in rng.sample(range(len(leak)), len(leak) // 25):
                leak[i] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = leak
        texts.append(" ".join(words))
    got = search(index, *texts)
    assert sum(map(bool, got)) > 40
    for t, hits in zip(texts, got, strict=True):
        assert hits == {k: pytest.approx(v) for k, v in plain_hits(index, d.words_of(t)).items()}


def test_whole_table_against_plain_containment(spark):
    path = "/root/testdata/sf0.01"
    norm = lambda t: " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) + " "
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        text = norm(r.text)
        want |= {(r.doc_id, i) for i, t in items if t in text}
    got = {(r.doc_id, r.item_id) for r in op4_decontaminate(spark, path).collect()}
    assert want and want <= got and len(got - want) <= 0.05 * len(got)


def test_needs_question_and_answer():
    item = "Which river flows through the old town of this country? It is the long green Danube river."
    index = d.Index([(1, item)])
    both, question, answer = item, item.split("?")[0] + "? Nobody knows any of that at all.", "Well, " + item.split("? ")[1]
    got = search(index, both.upper(), question, answer, "", "pad " * 500 + both + " pad" * 500)
    assert [set(x) for x in got] == [{1}, set(), set(), set(), {1}]


def test_shards_and_odd_rows(spark, monkeypatch):
    docs = odd_docs(spark).withColumn("found", d.F.lit(1)).withColumn("item_id", d.F.lit(1))
    fox = docs.first().text
    items = spark.createDataFrame([(i, f"{fox} number {i} of many other tests") for i in range(30)] + [(90, fox), (91, fox), (92, None), (None, fox), (93, "one two")], "item_id long, text string")
    rows = d.matches(docs, items, "hits").collect()
    assert len(rows) == 11
    for r in rows:
        assert {h.item_id for h in r.hits} == ({90, 91, None} if r.doc_id in (1, 2) else set())
    monkeypatch.setattr(d, "INDEX_BYTES", 2000)
    assert len(list(d._shards(items))) > 2
    again = d.matches(docs, items, "hits").collect()
    assert [{h.item_id for h in r.hits} for r in again] == [{h.item_id for h in r.hits} for r in rows]
    assert all(r.hits == [] for r in d.matches(docs, items.limit(0), "hits").collect())
    assert d.matches(no_docs(spark), items).collect() == []


def test_short_items_by_their_words_in_a_row(spark):
    texts = ["Yes, no. It is Paris, of course", "paris OF course it is", "it is", "", "of course it", "is paris"]
    items = [(1, "It is Paris!"), (2, "course"), (3, "is Paris of course"), (4, "Paris of course it is"), (5, "... "), (None, "no it"), (6, "It is Paris!")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = d.matches(docs, spark.createDataFrame(items, "item_id long, text string"), "hits").orderBy("doc_id").collect()
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split()) + " "
    for r in found:
        want = {i for i, t in items if i != 4 and plain(t).strip() and plain(t) in plain(r.text)}
        assert {h.item_id for h in r.hits} - {4} == want
    assert all(h.score == 1.0 for r in found for h in r.hits if h.item_id != 4)


def test_scores_do_not_depend_on_the_shards(spark, monkeypatch):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{path}/benchmark.parquet")
    rows = lambda: [tuple(r) for r in d.matches(docs, items, "hits").select("doc_id", "hits").orderBy("doc_id").collect()]
    whole = rows()
    assert any(h for _, h in whole)
    monkeypatch.setattr(d, "INDEX_BYTES", 6000)
    assert len(list(d._shards(items))) > 2
    assert rows() == whole
