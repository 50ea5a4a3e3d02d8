from grainmill import streaming as st


def test_new_files_become_blocks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Q: x\nA: y\n\nprose")
    q = st.watch_blocks(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("blocks_seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {x.type for x in spark.table("blocks_seen").collect()} == {"qa", "prose"}


def test_repeated_deliveries_and_windows(spark, tmp_path):
    rows = [(1, "a", "2031-01-01 00:00:00"), (1, "a", "2031-01-01 05:00:00"), (2, "b", "2031-01-02 00:00:00")]
    spark.createDataFrame(rows, "id int, k string, t string").selectExpr("id", "k", "cast(t as timestamp) as t").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id int, k string, t timestamp").parquet(str(tmp_path / "in"))
    q = st.deliveries_once(s, "id", "t").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2
    assert st.windowed_counts(spark.read.parquet(str(tmp_path / "in")), "t", "k").count() == 2
