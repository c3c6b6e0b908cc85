from corpusloom.streaming import changes


def test_changed_keys(spark, tmp_path):
    src, seen = str(tmp_path / "in"), {}
    schema = "key string, rev string, ts int"
    rows = [[("a", "1", 0), ("b", "1", 0)], [("a", "1", 1), ("b", "2", 1), ("b", "3", 2)]]
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        rebuild = lambda df, n: seen.setdefault(n, sorted((r["key"], r["rev"]) for r in df.collect()))
        query = (
            changes.changed_keys(stream, str(tmp_path / "snap"), ["key"], ["rev"], rebuild)
            .option("checkpointLocation", str(tmp_path / "ck"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        assert len(seen) == i + 1
    assert seen == {0: [("a", "1"), ("b", "1")], 1: [("b", "3")]}


def test_claim_states(spark, tmp_path):
    schema = "key string, event string, order int"
    spark.createDataFrame([("k", "claim", 0), ("k", "merge", 1), ("k", "close", 2), ("m", "claim", 0), ("m", "close", 1)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = changes.claim_states(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = out.writeStream.format("memory").queryName("claims").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r["key"]: (r["outcome"], r["n"]) for r in spark.table("claims").collect()} == {"k": ("published", 3), "m": ("released", 2)}


def test_claim_states_in_pieces(spark, tmp_path):
    """The last event counts, however a key's rows are cut into frames and batches."""
    schema, src = "key string, event string, order bigint", str(tmp_path / "in")
    batches = [
        [("a", "claim", 9), ("a", "close", 1), ("a", "claim", 3), ("b", "close", 8), ("b", "claim", 2), ("c", "merge", 7), ("c", "close", 9), ("d", "close", 5), ("e", "claim", 2**60 + 1)],
        [("a", "close", 4), ("b", "claim", 9), ("c", "claim", 1), ("d", "other", 6), ("d", "claim", None), ("e", "close", 2**60)],
    ]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = {}
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
            out = changes.claim_states(spark.readStream.schema(schema).parquet(src))
            take = lambda df, n: got.update({r["key"]: (r["outcome"], r["n"]) for r in df.collect()})
            out.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {"a": ("claimed", 4), "b": ("claimed", 3), "c": ("published", 3), "d": ("released", 3), "e": ("claimed", 2)}
