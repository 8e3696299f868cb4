"""Every stage of the corpus pipeline on a small table with nulls, repeats and clashing columns."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epistand.llm import langid, mixing
from epistand.llm.queries import MIX_TARGET, label_domain

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("n_chars", "n_pieces")
    first = docs.orderBy("doc_id").limit(3)
    odd = spark.createDataFrame([(9001, None, None), (9002, "", "en"), (9003, "12 34 !!", "en"), (None, "The cat and the dog of the house. " * 9, "en"),
                                 (9004, "word " * 40000, None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(first).unionByName(first.withColumns({"doc_id": F.col("doc_id") + 9100, "text": F.upper("text")}))
    docs = docs.unionByName(odd, allowMissingColumns=True)
    for name in ("lang_score", "mix_tokens", "keep_id", "copies", "rid"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Input and output rows of every stage, in order."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_columns_and_rows_come_from_the_documents(stages):
    first = stages[0][0].columns
    for before, after in stages[:-1]:
        assert after.columns == first
        assert set(rows(after)) <= set(rows(before)) and after.count() > 0
    last = stages[-1][1].columns
    assert {"piece_ids", "n_pieces", "lossless", "n_pieces_input", "lang_score", "rid"} <= set(last) and "text" not in last


def test_language_id(stages):
    before, after = stages[0]
    found = langid.identify(before.select("doc_id", "text"), langid.train(before)).where("lang_accepted").select("doc_id", "text")
    assert rows(after.select("doc_id", "text")) == rows(found)
    kept = {r.doc_id for r in after.collect()}
    assert not kept & {9001, 9002, 9003} and len(kept) > 150


def test_exact_dedup(stages):
    before, after = stages[1]
    best = {}
    for r in before.collect():
        t = (r.text or "").translate(UPPER)
        best[t] = min(best.get(t, (2, 0)), (r.doc_id is None, r.doc_id or 0))
    assert sorted(best.values()) == sorted((r.doc_id is None, r.doc_id or 0) for r in after.collect())


def test_near_duplicates(stages):
    before, after = stages[2]
    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    low = {k: k for k in sets}
    order = lambda k: (k is None, k or 0)
    for _ in range(6):
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low[a] = min(low[a], low[b], key=order)
    assert sorted((k for k in sets if low[k] == k), key=order) == sorted((r.doc_id for r in after.collect()), key=order)


def test_mixing(spark, folder, stages):
    before, after = stages[3]
    plan, _ = mixing.mix(before.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"), label_domain(), MIX_TARGET)
    copies = {r.doc_id: r.copies for r in plan.collect()}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == {k: n for k, n in copies.items() if n}


def test_tokens(stages):
    before, after = stages[4]
    found = after.collect()
    assert len(found) == before.count() and all(r.lossless for r in found)
    assert all(r.n_pieces == len(r.piece_ids) for r in found)


def test_run_and_empty_table(spark, folder, tmp_path, stages):
    assert rows(corpus_pipeline.run(spark, folder)) == rows(stages[-1][1])
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
