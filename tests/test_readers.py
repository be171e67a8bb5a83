from recunify.sources.readers import align, literal_frame, read_table, read_tiers


def test_literal_frame_quotes_and_types(spark):
    df = literal_frame(spark, [("it's", 1, None), ("back\\slash", 2, "x")], "a string, b int, c string")
    assert [tuple(r) for r in df.collect()] == [("it's", 1, None), ("back\\slash", 2, "x")]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "int", "string"]
    empty = literal_frame(spark, [], "a string, b int")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_read_table_sees_a_rewritten_table(spark):
    from recunify.session import scratch_path
    top = scratch_path(spark, "reread")
    spark.range(3).write.parquet(f"{top}/t.parquet")
    assert read_table(spark, top + "/", "t").count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{top}/t.parquet")
    assert read_table(spark, top, "t").count() == 5


def test_align_fills_and_renames(spark):
    df = literal_frame(spark, [("k1", "n1")], "key string, name string")
    out = align(df, ["mobile", "user_name", "city", "source_type"], renames={"mobile": "key", "user_name": "name"},
                constants={"source_type": "feed"})
    assert [tuple(r) for r in out.collect()] == [("k1", "n1", "", "feed")]


def test_read_tiers_first_matching_prefix(spark):
    df = literal_frame(spark, [("OWN_a",), ("NET_b",), ("zzz",)], "source_type string")
    got = sorted((r.source_type, r.tier) for r in read_tiers(df, "source_type", {1: ("OWN",), 2: ("NET",)}).collect())
    assert got == [("NET_b", 2), ("OWN_a", 1)]


def test_overlapping_tier_prefixes_are_refused(spark):
    import pytest
    df = spark.createDataFrame([("ab",)], "s string")
    with pytest.raises(ValueError, match="also matches"):
        read_tiers(df, "s", {1: ("a",), 2: ("ab",)})
