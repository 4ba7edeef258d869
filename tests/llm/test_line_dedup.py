import random
import re

import pytest
from pyspark.sql import functions as F

from riskweave.llm import line_dedup as ld
from tests.llm.cases import ODD, SCHEMA, no_docs, odd_docs


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, min_docs=2, min_chars=10):
    """(doc_id, kept text, lines, dropped lines) of each (doc_id, text), by counting in memory."""
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key_of(line)) >= min_chars:
                holders.setdefault(key_of(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        shared = lambda x: doc_id is not None and len(holders.get(key_of(x), ())) >= min_docs and doc_id > min(holders[key_of(x)])  # noqa: E731,B023
        kept = [x for x in lines if not shared(x)]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df, *a):
    return sorted([(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.drop_repeated(df, *a).collect()], key=repr)


@pytest.mark.parametrize("heavy", [1, 3, 10**9])
def test_random_lines_against_counting(spark, monkeypatch, heavy):
    monkeypatch.setattr(ld, "HEAVY", heavy)
    rng = random.Random(3)
    pool = ["Common line of all documents", "  common LINE of all documents\r", "ÄÖ zehn Zeichen ja", "äÖ zehn Zeichen ja", "short", "nine char", "ten  chars", "", " \t", "one more shared line", "KK ten chars"]
    rows = [(i // 2 if i % 9 == 0 else i, "\n".join([*rng.choices(pool, k=rng.randint(0, 6)), *[f"own line of {i} and {rng.random()}"] * rng.randint(0, 2)])) for i in range(120)]
    rows += [(None, "Common line of all documents\nx"), (None, None), (500, "solo line here\n" * 400), (501, "a\nb\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == plain(rows)
    assert found(df, 30, 5) == plain(rows, 30, 5)


def test_odd_rows(spark):
    assert found(odd_docs(spark)) == plain([r[:2] for r in ODD])
    assert ld.drop_repeated(no_docs(spark)).collect() == []
    extra = odd_docs(spark).select("*", F.lit(1).alias("kept_text"), F.lit(2).alias("N_lines"), F.lit(3).alias("pos"), F.lit(4).alias("digest"), F.lit(5).alias("places"), F.lit(6).alias("a.b"))
    out = ld.drop_repeated(extra)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "pos", "digest", "places", "a.b", "kept_text", "n_lines", "n_dropped"]
    assert found(extra) == plain([r[:2] for r in ODD])
    assert {r.places for r in out.collect()} == {5}


def test_a_text_of_very_many_dropped_lines(spark):
    lines = [f"line number {i} of a long list" for i in range(30_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["head", *lines[::2], "tail"]))]
    got = ld.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id = 2").first()
    assert (got.kept_text, got.n_lines, got.n_dropped) == ("head\ntail", 15_002, 15_000)


def test_no_python_in_the_plan(spark):
    plan = ld.drop_repeated(spark.createDataFrame(ODD, SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|BroadcastNestedLoop", plan)
