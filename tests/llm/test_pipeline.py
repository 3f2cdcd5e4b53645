"""The pipeline's stages one after the other on a small corpus, and its place in the contract."""

import os
import random

import pytest

import __spark_entry__
import corpus_pipeline
from quillmark.llm import catalogue, decontamination, exact_dedup, simhash
from quillmark.session import shared_dir


def test_stages_take_effect(spark, prose, folder):
    rng = random.Random(4)
    junk = lambda k: " | ".join(w.upper() + "!!" for w in prose(k, 40).split())
    rows = [(k, prose(3000 + k, 60)) for k in range(200)] + [(1000 + k, junk(k)) for k in range(60)]
    labels = [(i, int(i < 1000), 0) for i, _ in rows if rng.random() < 0.8]
    base = prose(1, 3000)
    passage = prose(2, 40)
    rows += [(2000, base), (2001, base.replace(" ", "  ")), (2002, base.replace(" ", " ", 1) + " otherly"), (2003, f"{prose(3, 30)} {passage} {prose(4, 30)}"), (2004, junk(999)), (2005, None)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, texts = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, folder)
        now.write.parquet(f"{folder}/stage{k}")
        now = spark.read.parquet(f"{folder}/stage{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns
            texts[name] = {r.doc_id: r.text for r in now.collect()}
    assert 2004 not in texts["quality"] and sum(1000 <= i < 2000 for i in texts["quality"]) <= 3
    assert sum(i < 1000 for i in texts["quality"]) >= 195 and 2000 in texts["quality"]
    assert 2001 not in texts["exact dedup"] and 2000 in texts["exact dedup"]
    assert 2002 in texts["exact dedup"] and 2002 not in texts["near dedup"] and 2000 in texts["near dedup"]
    assert texts["decontamination"][2003] == f"{prose(3, 30)}  {prose(4, 30)}"
    assert {i: t for i, t in texts["near dedup"].items() if i != 2003} == {i: t for i, t in texts["decontamination"].items() if i != 2003}
    last = {r.doc_id: r for r in now.collect()}
    assert last.keys() == texts["decontamination"].keys() and all(r.round_trip for r in last.values())
    scratch = os.path.join(shared_dir(spark).removeprefix("file:"), "quillmark")
    before = set(os.listdir(scratch))
    ran = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert ran == {i: r.ids for i, r in last.items()}
    left = set(os.listdir(scratch)) - before
    assert [f.rsplit("-", 1)[0] for f in left] == ["pipeline-decontamination"]


def test_contract_names():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in catalogue.all_queries()} == {f"op{k}" for k in range(1, 14)}
    assert set(catalogue.all_sql()) <= set(__spark_entry__.oracle_sql()) <= names


@pytest.mark.parametrize("repeated", [False, True])
def test_rows_hold_when_files_are_dealt_anew(spark, prose, folder, repeated):
    """The result is read with other partitions than the search, with ids of each kind."""
    rows = [(k, prose(k, 40)) for k in range(200)] + [(1000 + k, prose(k, 40)) for k in range(0, 200, 2)]
    rows += [(5, prose(5, 40)), (None, prose(9, 40)), (None, prose(777, 40))] if repeated else []
    random.Random(6).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{folder}/rows")
    spark.createDataFrame([(1, prose(7, 40)), (1, prose(7000, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark")
    docs, benchmark = spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/benchmark")
    cut_apart = decontamination.without_passages(docs, benchmark, phrase_bytes=300)
    results = [exact_dedup.keep_first(docs), simhash.keep_one(docs), decontamination.without_passages(docs, benchmark), cut_apart]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        exact, near, cut, cut_too = [sorted(((r.doc_id or -1, r.text) for r in x.collect())) for x in results]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(-1, prose(777, 40))] * repeated + [(k or -1, prose(k, 40)) for k in range(200)]
    assert exact == near == sorted(want)
    assert {i for i, t in cut if not t} == {7} and cut == cut_too and len(cut) == len(rows)
