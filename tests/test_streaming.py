from lociflow.streaming.incremental import running_extent

SCHEMA = "chr int, pos long, p double"


def test_files_count_once(spark, tmp_path):
    folder, state, out = (str(tmp_path / x) for x in ("in", "state", "out"))
    first = [(1, 5, 0.5), (1, 2, None), (2, 9, float("nan")), (None, None, 0.1)]
    spark.createDataFrame(first, SCHEMA).write.parquet(folder)
    schema = spark.createDataFrame([], SCHEMA).schema
    run = lambda: {tuple(r) for r in running_extent(spark, folder, schema, "chr", "pos", "p", state, out).collect()}
    assert run() == {(1, 2, 2, 5, 0.5), (2, 1, 9, 9, None), (None, 1, None, None, 0.1)}
    spark.createDataFrame([(1, 1, 0.25)], SCHEMA).write.mode("append").parquet(folder)
    assert run() == {(1, 3, 1, 5, 0.25), (2, 1, 9, 9, None), (None, 1, None, None, 0.1)}
    assert run() == {(1, 3, 1, 5, 0.25), (2, 1, 9, 9, None), (None, 1, None, None, 0.1)}
