import os

from pyspark.sql import functions as F

from recunify.operators import catalog, segments as sg
from recunify.plans.queries import QUERIES
from recunify.session import scratch_path
from recunify.sinks import writers
from recunify.sources import standins as si

from conftest import SF001


def test_rendered_ddl_creates_tables(spark):
    root = scratch_path(spark, "ddl_root")
    db_dir = scratch_path(spark, "ddl_db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dw_cust LOCATION '{db_dir}'")
    tables = si.table_metadata(spark, SF001).where(F.col("tablename").isin("cust_0", "cust_1", "cust_2"))
    ddl = catalog.render_ddl(tables, si.column_metadata(spark, SF001), root=root, dialect="spark")
    assert catalog.create_tables(spark, ddl) == 3
    cols = [c.name for c in spark.catalog.listColumns("dw_cust.cust_1")]
    ranks = sorted((int(r.buiscolrank), r.buiscolname) for r in si.column_metadata(spark, SF001)
                   .where("dbtable = 'dw_cust.cust_1'").collect())
    assert cols == [n for _, n in ranks] and len(cols) > 1
    spark.sql("DROP DATABASE dw_cust CASCADE")


def test_hive_ddl_text(spark):
    ddl = {r.dbtable: r.ddl for r in QUERIES["render_ddl"](spark, SF001).collect()}
    text = ddl["dw_cust.cust_0"]
    assert text.startswith("CREATE EXTERNAL TABLE IF NOT EXISTS dw_cust.cust_0(\n")
    assert "STORED AS parquet\nLOCATION '/warehouse/dw_cust/cust_0'" in text


def test_comment_with_separators_keeps_column(spark):
    cols = spark.createDataFrame([("d.t", "a", "a", "string", "x, y: z", 2), ("d.t", "b", "b", "int", "c", 1)],
                                 "dbtable string, dswhcolname string, buiscolname string, buiscoltype string, "
                                 "buiscolcomment string, buiscolrank int")
    out = catalog.column_ddl(cols).first().cols
    assert out == "b int COMMENT 'c',\na string COMMENT 'x, y: z'"


def test_write_segments_per_target(spark):
    root = scratch_path(spark, "segments")
    pub = QUERIES["publish_segments"](spark, SF001)
    sg.write_segments(pub, root, rows_per_file=50)
    back = spark.read.parquet(root)
    assert back.count() == pub.count()
    top = root.replace("file:", "")
    targets = {(db, t) for db in os.listdir(top) if "=" in db for t in os.listdir(f"{top}/{db}") if "=" in t}
    assert targets == {(f"targetdatabase={r.targetdatabase}", f"targettable={r.targettable}") for r in pub.collect()}
    # a later run that evaluated t1 and t2 and selected one row of t1: t2 is cleared, the others stay
    t1 = pub.where(F.col("targettable") == "t1").limit(1)
    names = pub.select("targetdatabase", "targettable").distinct()
    sg.write_segments(t1, root, evaluated=names.where("targettable in ('t1', 't2')"))
    back2 = spark.read.parquet(root)
    assert back2.where("targettable = 't1'").count() == 1
    assert back2.where("targettable = 't2'").count() == 0 < pub.where("targettable = 't2'").count()
    rest = "targettable not in ('t1', 't2')"
    assert back2.where(rest).count() == pub.where(rest).count()


def test_seed_and_write_column_metadata(spark):
    path = scratch_path(spark, "col_meta")
    seeded = QUERIES["seed_columns"](spark, SF001)
    catalog.write_column_metadata(seeded, path)
    back = spark.read.parquet(path)
    n_tables = si.table_metadata(spark, SF001).count()
    n_template = si.column_metadata(spark, SF001).where("dbtable = 'dw_cust.cust_0'").count()
    assert back.count() == (n_tables - 1) * n_template      # cust_1 is excluded by its name, in any database
    assert back.select("dbtable").distinct().count() == n_tables - 1


def test_column_map_excludes_warehouse_names(spark):
    cols = spark.createDataFrame(
        [("d.t", "mobile", "phone", "string", "c", "2"), ("d.t", "tel2", "mobile", "string", "c", "10"),
         ("d.t", "source", "s", "string", "c", "1"), ("d.t", "city", "city", "string", "c", "9"),
         ("d.t", "source_type", "st", "string", "c", "3"), ("d.u", "x", "x", "string", "c", "1")],
        "dbtable string, dswhcolname string, buiscolname string, buiscoltype string, buiscolcomment string, buiscolrank string")
    assert [tuple(r) for r in catalog.column_map(cols, "d.t").collect()] == [("city", "city", "9"), ("tel2", "mobile", "10")]
    assert [x.split()[0] for x in catalog.column_ddl(cols.where("dbtable = 'd.t'")).first().cols.split("\n")] == [
        "s", "phone", "st", "city", "mobile"]


def test_listed_columns_leave_the_driver_in_parts(spark, monkeypatch):
    """Columns of all tables, written some tables at a time; none is left out, whichever write was the last."""
    db = "listed_in_parts"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    try:
        assert catalog.listed_columns(spark, db).collect() == []
        spark.sql(f"CREATE TABLE {db}.a (x int COMMENT 'of x', v varchar(3), p string) USING parquet PARTITIONED BY (p)")
        spark.sql(f"CREATE TABLE {db}.b ({', '.join(f'c{i} double' for i in range(30))}) USING parquet")
        expected = [("a", 1, "x", "int", "of x"), ("a", 2, "v", "string", None), ("a", 3, "p", "string", None)] + [
            ("b", i + 1, f"c{i}", "double", None) for i in range(30)]
        sizes = []
        frame = type(spark).createDataFrame
        monkeypatch.setattr(type(spark), "createDataFrame", lambda s, data, *a, **k: sizes.append(len(data)) or frame(s, data, *a, **k))
        for rows, written in ((2, [3, 30]), (1000, [33])):
            sizes.clear()
            monkeypatch.setattr(catalog, "LISTED_ROWS", rows)
            got = catalog.listed_columns(spark, db)
            assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and sizes == written
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_column_metadata_is_written_by_many_tasks(spark):
    """One small input task: its targets' folders are still dealt over tasks, one file each, and only theirs are replaced."""
    path = scratch_path(spark, "col_meta_tasks")
    rows = spark.createDataFrame([(f"d.t{i % 24}", f"c{i}") for i in range(72)], "dbtable string, buiscolname string").coalesce(1)
    catalog.write_column_metadata(rows, path)
    top = path.replace("file:", "")
    files = {d: [f for f in os.listdir(f"{top}/{d}") if f.endswith(".parquet")] for d in os.listdir(top) if "=" in d}
    assert len(files) == 24 and all(len(f) == 1 for f in files.values())
    assert len({f[0].split("-")[1] for f in files.values()}) > 1  # the writing tasks' numbers
    catalog.write_column_metadata(spark.createDataFrame([("d.t0", "new")], rows.schema), path)
    back = [(r.dbtable, r.buiscolname) for r in spark.read.schema(rows.schema).parquet(path).collect()]
    assert sorted(back) == sorted([("d.t0", "new")] + [(f"d.t{i % 24}", f"c{i}") for i in range(72) if i % 24])


def test_many_partitions_start_no_process_each_and_keep_odd_names(spark):
    """Folders on a local disk without a chmod process each; NULL, '' and names with marks; others' folders stay."""
    forks = lambda: int(next(x for x in open("/proc/stat") if x.startswith("processes")).split()[1])
    path = scratch_path(spark, "odd_names")
    names = [None, "", "a+b c", "50%", "x/y:z=[1]", "é%2Fü", "q'\"#\\?*{^"] + [f"d.t{i}" for i in range(300)]
    rows = spark.createDataFrame([(n, f"c{j}") for n in names for j in range(2)], "dbtable string, buiscolname string").coalesce(1)
    catalog.write_column_metadata(rows.limit(2), path)
    before = forks()
    catalog.write_column_metadata(rows, path)
    assert forks() - before < 300
    by = lambda df: sorted((r.dbtable or "", r.buiscolname) for r in df.collect())
    assert by(writers.read_partitions(spark, path, rows.schema, many="dbtable")) == by(rows)
    assert by(writers.read_partitions(spark, path, rows.schema)) == by(rows)
    catalog.write_column_metadata(rows.where("dbtable = '50%'").limit(1), path)
    assert writers.read_partitions(spark, path, rows.schema, many="dbtable").count() == rows.count() - 1
    numbered = rows.select("dbtable", F.length("buiscolname").alias("n"))  # not all texts: Spark's writer
    other = scratch_path(spark, "odd_numbers")
    catalog.write_column_metadata(numbered.where("dbtable like 'd.t1%'"), other)
    got = writers.read_partitions(spark, other, numbered.schema, many="dbtable")
    assert sorted(map(tuple, got.select("dbtable", "n").collect())) == sorted(map(tuple, numbered.where("dbtable like 'd.t1%'").collect()))
    assert writers.read_partitions(spark, other, numbered.schema, many="dbtable").where("dbtable is null").count() == 0
