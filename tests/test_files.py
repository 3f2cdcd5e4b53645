"""Sources and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from quillmark.operators import inference, sampling
from quillmark.sources import files, sinks, tables


def test_text_files_in_numeric_order(spark, folder):
    for name, content in {"doc_0.txt": "  a\nb \n", "doc_2.txt": "c", "doc_10.txt": "　d", "doc_1.txt": "e", "doc_3.txt": " \n"}.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(content)
    got = [(r.file_index, r.text, r.source) for r in files.scan_text_files(spark, folder).collect()]
    assert got == [(0, "a\nb", "doc_0.txt"), (1, "e", "doc_1.txt"), (2, "c", "doc_2.txt"), (10, "d", "doc_10.txt")]


def test_artifact_sizes_skip_links(spark, folder):
    for name, size in {"adapter/a.bin": 10, "adapter/sub/b.bin": 5, "merged/c.bin": 1000}.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as f:
            f.write(b"x" * size)
    os.symlink(f"{folder}/merged/c.bin", f"{folder}/adapter/link #1.bin")
    os.symlink(f"{folder}/merged", f"{folder}/adapter/linked")
    os.symlink(f"{folder}/merged", f"{folder}/alias")
    os.makedirs(f"{folder}/empty")
    for name in (".hidden", "_marker", "a #2.bin", ".c.crc"):
        with open(f"{folder}/merged/{name}", "wb") as f:
            f.write(b"x")
    got = {r.artifact: (r.n_files, r.n_bytes) for r in files.artifact_sizes(spark, folder).collect()}
    assert got == {"adapter": (2, 15), "merged": (5, 1004), "empty": (0, 0)}
    got = {r.artifact: r.n_files for r in files.artifact_sizes(spark, folder, files.CHECKSUMS).collect()}
    assert got["merged"] == 4


def test_csv_keeps_quotes_breaks_and_blanks(spark, folder):
    texts = ['say "hi", ok', "a\nb\r\nc\rd", "  padded  ", "back\\slash", 'end"', "'", ",", "é x", '""', "\\\"", "\n"]
    df = spark.createDataFrame([*enumerate(texts)], "id int, t string")
    sinks.write_csv(df, f"{folder}/csv")
    got = {r.id: r.t for r in sinks.read_csv(spark, f"{folder}/csv", "id int, t string").collect()}
    assert got == dict(enumerate(texts))


def test_splits_are_pruned(spark, folder):
    df = sampling.train_eval_split(spark.range(100).toDF("id"), "id")
    sinks.write_splits(df, f"{folder}/s")
    loaded = tables.load_split(spark, f"{folder}/s", "eval", lambda d: d.withColumn("twice", F.col("id") * 2))
    assert loaded.count() == 10 and loaded.columns == ["id", "twice"]
    assert "PartitionFilters: [isnotnull(split" in loaded._jdf.queryExecution().executedPlan().toString()
    assert tables.load_splits(spark, f"{folder}/s").groupBy("split").count().count() == 2


def test_conversation_files_of_both_layouts(spark, folder):
    os.makedirs(f"{folder}/many")
    for i in range(3):
        with open(f"{folder}/many/c{i}.json", "w", encoding="utf-8") as f:
            f.write('[\n {"messages": [{"role": "user", "content": "q%d"}]},\n {"messages": []}\n]' % i)
    got = tables.read_conversations(spark, f"{folder}/many", multiline=True)
    assert got.count() == 6
    sinks.write_jsonl(got, f"{folder}/lines")
    back = tables.read_conversations(spark, f"{folder}/lines")
    assert sorted(r.messages[0].content for r in back.where(F.size("messages") > 0).collect()) == ["q0", "q1", "q2"]


def test_arrays_by_lines(spark, folder):
    rows = [(k, [("user", f'q{k} "}}]\n{{'), ("assistant", "],")]) for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, messages array<struct<role string, content string>>")
    sinks.write_json_arrays(df.repartition(2), f"{folder}/a")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        back = tables.read_array_lines(spark, f"{folder}/a", "conv_id bigint")
        assert back.rdd.getNumPartitions() > 4
        got = back.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.conv_id, [tuple(m) for m in r.messages]) for r in got) == rows
    os.makedirs(f"{folder}/b")
    with open(f"{folder}/b/x.json", "w") as f:
        f.write('[ {"conv_id": 1, "messages": []} ,\n {"conv_id": 2, "messages": null}\n, {"conv_id": 3}]\n')
    assert sorted(r.conv_id for r in tables.read_array_lines(spark, f"{folder}/b", "conv_id bigint").collect()) == [1, 2, 3]
    with open(f"{folder}/b/y.json", "w") as f:
        f.write('[\n{"conv_id": 1,\n "messages": []}]')
    with pytest.raises(Exception, match="not a whole object"):
        tables.read_array_lines(spark, f"{folder}/b", "conv_id bigint").collect()


def test_publish_adds_versions_and_merges(spark, folder):
    base = f"{folder}/data"
    assert sinks.latest_version(spark, base) == 0
    sinks.publish(spark.range(10).toDF("id"), base, "id")
    sinks.publish(spark.range(10, 15).toDF("id"), base, "id", merging=True)
    assert sinks.latest_version(spark, base) == 2
    assert sorted(r.id for r in sinks.read_published(spark, base).collect()) == list(range(15))
    sinks.publish(spark.range(3).toDF("id"), base, "id")
    assert sinks.read_published(spark, base).count() == 3
    with pytest.raises(Exception):
        sinks.publish(spark.range(3).toDF("other"), base, "other", merging=True)


def test_publish_goes_on_after_a_crash(spark, folder):
    base = f"{folder}/data"
    assert sinks.publish(spark.range(10).toDF("id"), base, "id") == 1
    spark.range(77).toDF("id").write.parquet(f"{base}/files/left-over")  # rows without a pointer
    open(f"{base}/versions/_half", "w").close()
    assert sinks.latest_version(spark, base) == 1
    assert sinks.publish(spark.range(10, 12).toDF("id"), base, "id", merging=True) == 2
    assert sorted(r.id for r in sinks.read_published(spark, base).collect()) == list(range(12))
    assert sinks.read_published(spark, base, 1).count() == 10


def test_two_publishers_of_one_version(spark, folder, monkeypatch):
    """Another publisher is first, between this one's write and its claim."""
    base, claim, done = f"{folder}/data", sinks._claim, []

    def second(spark_, base_, version, name):
        if version not in (1, 3, 5) and version not in done:
            done.append(version)
            assert sinks.publish(spark.range(100 * version, 100 * version + 3).toDF("id"), base, "id", merging=True) == version
        return claim(spark_, base_, version, name)

    sinks.publish(spark.range(5).toDF("id"), base, "id")
    monkeypatch.setattr(sinks, "_claim", second)
    assert sinks.publish(spark.range(5, 8).toDF("id"), base, "id", merging=True) == 3
    assert sorted(r.id for r in sinks.read_published(spark, base).collect()) == [*range(8), *range(200, 203)]
    assert sinks.publish(spark.range(3).toDF("id"), base, "id") == 5
    assert sinks.read_published(spark, base).count() == 3 and sinks.read_published(spark, base, 4).count() == 11 + 3


def test_publishers_in_threads(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    base = f"{folder}/data"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: sinks.publish(spark.range(10 * k, 10 * k + 10).toDF("id"), base, "id", merging=True, partitions=2), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    assert sorted(r.id for r in sinks.read_published(spark, base).collect()) == list(range(40))


def test_publish_checks_ids(spark, folder):
    base = f"{folder}/data"
    rows = lambda pairs: spark.createDataFrame(pairs, "id int, text string")
    with pytest.raises(ValueError, match="null or repeat"):
        sinks.publish(rows([(1, "a"), (1, "b")]), base, "id")
    with pytest.raises(ValueError, match="null or repeat"):
        sinks.publish(rows([(None, "a")]), base, "id")
    assert sinks.latest_version(spark, base) == 0
    sinks.publish(rows([(1, "a"), (2, "b")]), base, "id")
    with pytest.raises(ValueError, match=r"old and new rows.*\[2\]"):
        sinks.publish(rows([(2, "c"), (3, "d")]), base, "id", merging=True)
    assert sinks.latest_version(spark, base) == 1
    read = lambda: {r.id: r.text for r in sinks.read_published(spark, base).collect()}
    sinks.publish(rows([(2, "c"), (3, "d")]), base, "id", merging=True, clash="old")
    assert read() == {1: "a", 2: "b", 3: "d"}
    sinks.publish(rows([(2, "c"), (4, "e")]), base, "id", merging=True, clash="new")
    assert read() == {1: "a", 2: "c", 3: "d", 4: "e"}


def test_walk_deals_out_what_it_does_not_open(spark, folder):
    """One deep and one wide tree with links, walked a few entries at a time."""
    deep = f"{folder}/deep"
    for k in range(12):
        deep += f"/d{k}"
        os.makedirs(deep)
        with open(f"{deep}/f", "w") as f:
            f.write("x" * k)
    os.makedirs(f"{folder}/empty/er")
    for k in range(40):
        os.makedirs(f"{folder}/wide/w{k}")
        for j in range(3):
            with open(f"{folder}/wide/w{k}/{j}.txt", "w") as f:
                f.write("yy")
    os.symlink(f"{folder}/wide", f"{folder}/wide/w1/again")
    os.symlink(f"{folder}/wide/w1/0.txt", f"{folder}/wide/w2/link.txt")
    want = {"deep": (12, sum(range(12))), "wide": (120, 240), "empty": (0, 0)}
    for entries in (1, 7, 10_000):
        got = files.artifact_sizes(spark, folder, entries=entries).collect()
        assert {r.artifact: (r.n_files, r.n_bytes) for r in got} == want
    listed = spark.createDataFrame([("wide", f"{folder}/wide")], "artifact string, path string")
    first = listed.mapInPandas(files._walker(None, 5), files.WALK).collect()
    assert sum(r.path is not None for r in first) >= 39 and sum(r.path is None for r in first) == 1


def test_shuffled_order_is_the_seeded_order(spark):
    df = spark.range(300).toDF("id")
    placed = sinks.shuffled(df, "id", 42, partitions=5)
    assert [r.id for r in placed.collect()] == [r.id for r in sampling.seeded_order(df, "id", 42).collect()]
    assert placed.rdd.getNumPartitions() == 5


def test_records(spark, folder):
    sinks.write_records(spark.createDataFrame([(3, "x")], "k int, t string"), "k", "t", f"{folder}/r")
    assert spark.read.parquet(f"{folder}/r").first().asDict() == {"source": "doc_3.txt", "text": "x"}
    assert inference.materialize(spark.range(2), f"{folder}/m").count() == 2
