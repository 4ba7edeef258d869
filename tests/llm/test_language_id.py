import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import language_id as li
from riskweave.llm.queries import op10_language_id
from tests.llm.cases import no_docs, odd_docs

TEXTS = {"en": "the cat sat on the mat that the other cat hated", "de": "der hund und die katze sind auf der matte und der bank"}


def grams(text):
    out = Counter()
    for w in text.split():
        s = f" {w} "
        for i in range(1, len(s)):
            out[s[max(0, i - li.ORDER + 1) : i + 1]] += 1
    return out


def plain_model(text):
    """Interpolated Kneser-Ney by its definition, from the words."""
    words = [f" {w} " for w in text.split()]
    seen = {k: Counter() for k in range(1, li.ORDER + 1)}
    for s in words:
        for i in range(1, len(s)):
            g = s[max(0, i - li.ORDER + 1) : i + 1]
            seen[len(g)][g] += 1
    for k in range(li.ORDER - 1, 0, -1):
        left = defaultdict(set)
        for g in seen[k + 1]:
            left[g[1:]].add(g[0])
        for g, before in left.items():
            seen[k][g] += len(before)
    discount = {}
    for k, t in seen.items():
        n1, n2 = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        discount[k] = min(0.95, max(0.1, n1 / (n1 + 2 * n2) if n1 else 0.1))

    def p(context, c):
        k = len(context) + 1
        lower = p(context[1:], c) if context else 1.0 / li.ALPHABET
        follow = {g: n for g, n in seen[k].items() if g[:-1] == context}
        total = sum(follow.values())
        if not total:
            return lower
        return max(seen[k][context + c] - discount[k], 0) / total + discount[k] * len(follow) / total * lower

    return p


def test_word_scores_are_kneser_ney():
    models = li.kneser_ney({k: dict(grams(t)) for k, t in TEXTS.items()})
    assert models.languages == ["de", "en"]
    plain = [plain_model(TEXTS[x]) for x in models.languages]
    words = ["the", "cat", "katze", "xyz", "a", "undother", "ß"]
    got = models.words(words)
    for w, row in zip(words, got, strict=True):
        s = f" {w} "
        for column, p in enumerate(plain):
            want = sum(math.log(p(s[max(0, i - li.ORDER + 1) : i], s[i])) for i in range(1, len(s)))
            assert row[column] == pytest.approx(want)
        assert row[-1] == len(s) - 1


def test_probabilities_add_up():
    models = li.kneser_ney({"en": dict(grams(TEXTS["en"]))})
    letters = sorted(set(TEXTS["en"].replace(" ", "")))
    p = plain_model(TEXTS["en"])
    seen = sum(p("th", c) for c in [*letters, " "])
    assert seen + (li.ALPHABET - len(letters) - 1) * p("th", "\x01") == pytest.approx(1)


def test_held_out_languages(spark):
    path = "/root/testdata/sf0.1"
    rows = op10_language_id(spark, path).join(spark.read.parquet(f"{path}/documents.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 2000
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.99
    assert np.mean([r.accepted for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_rejects_what_is_no_known_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = li.fit(docs, li.F.lit(True))
    strange = spark.createDataFrame([("zxqv wkjq pffz qqxz vbnm zzkx " * 20,), ("東京 大阪 " * 9,), ("1234 !!! 99",)], "text string")
    rows = li.predict(strange, models).collect()
    assert [r.accepted for r in rows] == [False] * 3
    assert rows[2].lang_pred == "und" and rows[2].score == 0.0


def test_odd_rows(spark):
    models = li.kneser_ney({k: dict(grams(t)) for k, t in TEXTS.items()})
    rows = li.predict(odd_docs(spark), models).collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert {by[i].lang_pred for i in (3, 4, 5)} == {"und"}
    assert {by[i].lang_pred for i in (1, 2, 6, 7, None)} <= {"de", "en"}
    assert by[1].score == by[2].score
    clash = odd_docs(spark).withColumns({"share": li.F.lit(9), "score": li.F.lit("x"), "gram": li.F.lit(1)})
    assert set(li.fit(clash, li.F.lit(True)).languages) <= {"de", "en"}
    assert li.predict(clash, models).columns[-4:] == ["lang_pred", "score", "cross_entropy", "accepted"]
    none = li.fit(no_docs(spark), li.F.lit(True))
    assert {r.lang_pred for r in li.predict(odd_docs(spark), none).collect()} == {"und"}
    assert li.predict(no_docs(spark), models).collect() == []


def test_every_language_is_learned_whatever_its_ids(spark):
    """Rows of one id, rows without id, and copies of one text."""
    rng = random.Random(9)
    words = {"de": "und der die das nicht ein mit auch".split(), "en": "the and of that with have this from".split(),
             "fr": "le la les des une avec pour dans".split(), "it": "che non una per sono come con gli".split()}
    text = lambda x: " ".join(rng.choices(words[x], k=12))
    rows = [(None, text("en"), "en") for _ in range(3000)] + [(5, text("de"), "de") for _ in range(3000)]
    copy = text("fr")
    rows += [(i, copy, "fr") if i % 2 else (5, copy, "fr") for i in range(3000)] + [(9, text("it"), "it")]
    rows += [(7, None, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = {r.lang: r["count"] for r in li._sample(docs, F.lit(True)).groupBy("lang").count().collect()}
    assert sizes["it"] == 1 and all(250 < sizes[x] < 550 for x in ("en", "de"))
    models = li.fit(docs, F.lit(True))
    assert {"de", "en", "fr", "it"} <= set(models.languages)
    got = li.predict(spark.createDataFrame([(x, text(x)) for x in words], "want string, text string"), models).collect()
    assert all(r.want == r.lang_pred for r in got)
