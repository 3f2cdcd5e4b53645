"""Row-level functions on a streaming frame."""

from pyspark.sql import functions as F

from quillmark.functions import text


def test_row_functions_run_on_a_stream(spark, folder):
    spark.createDataFrame([(1, " a  {b} <s> x </s>"), (2, "Yes")], "id int, t string").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id int, t string").parquet(f"{folder}/in")
    out = stream.select("id", text.clean_text(F.col("t")).alias("c"), text.extract_tag(F.col("t"), "s").alias("s"), text.is_yes(F.col("t")).alias("y"))
    sink = out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")
    sink.awaitTermination()
    got = spark.read.parquet(f"{folder}/out").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a  <s> x </s>", "x", False), (2, "Yes", None, True)]
