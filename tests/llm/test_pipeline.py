from pyspark.sql import functions as F

import corpus_pipeline as cp
from riskweave.llm import decontaminate, pieces, quality, simhash, toxicity
from tests.llm.cases import LABELS, no_docs, odd_docs
from tests.llm.test_simhash import plain_components


def small(spark, tmp_path, docs):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 1, 0), (2, 1, 0), (7, 0, 1), (None, 1, 1), (6, None, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "a benchmark item of some words. And its answer."), (2, None)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder


def test_stages_against_their_operators(spark):
    """The pipeline's rows are those that the operators' decisions leave, computed without it."""
    path = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in cp.run(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")

    model = toxicity.fit(docs, labels)
    of = model.scorer()
    left = [r for r in docs.collect() if of(r.text)[0] < 0.7]
    kept = spark.createDataFrame(left, docs.schema)
    good = quality.score(kept, quality.fit(kept, labels)).filter("score >= 0.7").drop("score").collect()
    kept = spark.createDataFrame(good, docs.schema)
    prints = [simhash.fingerprint(r.text) for r in good]
    groups = {r.doc_id: min(o.doc_id for o, g in zip(good, roots, strict=True) if g == root) for roots in [plain_components(prints, 4)] for r, root in zip(good, roots, strict=True)}
    ones = [r for r in good if groups[r.doc_id] == r.doc_id]
    index = decontaminate.Index([(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()])
    clean = []
    for r in ones:
        words = decontaminate.words_of(r.text)
        if not index.search(words, decontaminate.np.array([0, len(words)]))[0]:
            clean.append(r)
    machine = pieces.Transducer(open(pieces.MODEL, "rb").read())
    assert set(got) == {r.doc_id for r in clean}
    for r in clean:
        assert got[r.doc_id].round_trip and bytes(memoryview(pieces.np.array(got[r.doc_id].ids, "<i4"))) == machine.encode(r.text)
    assert 400 < len(got) < 1000


def test_odd_rows_and_extra_columns(spark, tmp_path):
    docs = odd_docs(spark).withColumns({"toxicity_score": F.lit("x"), "quality_score": F.lit(2), "benchmark_items": F.lit(3), "component_id": F.lit(4)})
    folder = small(spark, tmp_path, docs)
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, rows, folder)
        assert out.columns == docs.columns, name
        out.collect()
    once = cp.drop_copies(spark, rows, folder).collect()
    assert sorted((r.doc_id for r in once), key=repr) == sorted([1, 3, 6, 7, 8, 9, None], key=repr)
    assert len(cp.drop_leaks(spark, rows, folder).collect()) == 11
    assert len(cp.encode(spark, rows, folder).collect()) == 11


def test_empty_tables(spark, tmp_path):
    folder = small(spark, tmp_path, no_docs(spark))
    assert cp.run(spark, folder).collect() == []


def test_every_stage_is_registered():
    from riskweave.llm.queries import QUERIES

    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality", "simhash", "decontaminate", "sentencepiece"]
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
