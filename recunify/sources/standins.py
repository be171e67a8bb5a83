"""Stand-in feeds derived from the driver's test tables.

The test tables hold no contact data, so each reference input is played by
a deterministic view over one of them (see FIXTURES.md §3).  Every view is
a projection of a whole table -- nothing is sampled or capped -- so the
work of each query grows with the table.  The ``%`` expressions below only
*shape values* (which rows carry an empty field); they never filter rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recunify.functions.codes import code_of
from recunify.functions.dates import day_of, time_of
from recunify.sources.feeds import SOURCE_TYPE
from recunify.sources.readers import literal_frame, read_table

# ---- fixed values -------------------------------------------------------
from recunify.operators.suppression import (  # noqa: E402  (reason codes)
    REASON_AGE, REASON_CHILD, REASON_REFUSE, REASON_SUCCESS)

# Stand-in: order priority plays the outcome title.  3-MEDIUM has no reason
# (CASE without ELSE -> NULL) and marks closed deals instead.
REASON_BY_TITLE = {
    "1-URGENT": REASON_CHILD,
    "2-HIGH": REASON_SUCCESS,
    "4-NOT SPECIFIED": REASON_AGE,
    "5-LOW": REASON_REFUSE,
}
CLOSED_DEAL_TITLE = "3-MEDIUM"

# Source families -> tiers of the golden record (higher tier wins).
CONTACT_TIERS = {1: ("signup", "error"), 2: ("view", "click"), 3: ("purchase",)}

# Segment rules: (source pattern, minage, maxage, minparentage, maxparentage, database, target).
# seg.t1 and seg2.t1 are different targets.
SEGMENT_RULES = [
    ("S%", "5", "8", "30", "33", "seg", "t1"),
    ("P%", "1", "3", "", "", "seg", "t1"),
    ("E%", "", "", "", "", "seg", "t2"),
    ("M%", "", "", "15", "18", "seg", "t2"),
    ("L%", "4", "", "", "", "seg", "t3"),
    ("L%", "x", " 3 ", "", "", "seg", "t4"),
    ("%M_LL", "2", "9", "", "", "seg2", "t1"),
    ("%O%", "", "", "20", "30", "seg2", "t1"),
]
# Target table -> category (the category a target's child suppression uses).
TARGET_CATEGORY = [("t1", "F"), ("t2", "O"), ("t3", "P"), ("t4", "F")]
# ------------------------------------------------------------------------


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base-warehouse stand-in from ``events`` (one row per event)."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    attr_a = F.when(eid % 3 == 0, F.lit("")).when(eid % 5 == 0, F.lit(None)).otherwise(F.col("props"))
    attr_b = (F.when(eid % 4 == 0, F.lit(None)).when(eid % 7 == 0, F.lit(""))
              .otherwise(F.floor("value").cast("int").cast("string")))
    return ev.select(
        F.col("user_id").alias("contact_id"),
        F.col("event_type").alias("source_type"),
        F.concat(F.lit("ch"), (eid % 7).cast("string")).alias("source"),
        attr_a.cast("string").alias("attr_a"),
        attr_b.cast("string").alias("attr_b"),
        day_of("ts").alias("update_day"),
        time_of("ts").alias("update_time"),
        eid.alias("event_id"),
    )


def golden_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden-table stand-in from ``part`` for the segment rules."""
    p = read_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        k.alias("mobile"),
        F.col("p_type").alias("source_type"),
        F.when(k % 4 == 0, F.lit("")).otherwise(size.cast("string")).alias("age"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise((size % 18).cast("string")).alias("child_age"),
        F.when(k % 5 == 0, (size % 15).cast("string")).otherwise(F.lit("")).alias("child_deduced_age"),
        F.when(k % 2 == 0, (size - 2).cast("string")).otherwise(F.lit("")).alias("age_start"),
        F.when(k % 2 == 0, (size + 2).cast("string")).otherwise(F.lit("")).alias("age_end"),
        F.when(k % 7 == 0, F.lit(" ")).when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_brand"))
        .cast("string").alias("city_short"),
    )


def segment_rules(spark: SparkSession) -> DataFrame:
    """Rule metadata table (``metadata_instructs`` layout)."""
    return literal_frame(
        spark, SEGMENT_RULES,
        "source string, minage string, maxage string, minparentage string, "
        "maxparentage string, targetdatabase string, targettable string",
    )


def target_categories(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, TARGET_CATEGORY, "targettable string, category string")


def reason_of(title) -> F.Column:
    return code_of(title, REASON_BY_TITLE)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM-outcome stand-in (and suppression-table stand-in) from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("mobile"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_orderkey").alias("project"),
        F.col("o_orderpriority").alias("title"),
        reason_of("o_orderpriority").alias("source"),
        day_of("o_orderdate").alias("update_day"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call-detail stand-in: a line item is a call of its order's customer,
    ``l_quantity`` its duration in seconds (as integer text), ``l_suppkey``
    the project that placed it."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("mobile"),
        F.col("o_orderstatus").alias("category"),
        F.col("l_suppkey").alias("project"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_quantity").cast("int").cast("string").alias("duration_time"),
        day_of("l_shipdate").alias("update_day"),
    )


def suppression_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression-table stand-in from ``lineitem``, uncut: every line is an
    earlier suppression row of customer ``l_partkey``; its flag and status
    play the reason, first lines belong to the outcome feed's family."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("mobile"),
        F.when(flag == "R", F.lit(REASON_CHILD)).when(flag == "A", F.lit(REASON_SUCCESS))
        .when(status == "O", F.lit(REASON_AGE)).otherwise(F.lit(REASON_REFUSE)).alias("source"),
        F.when(F.col("l_linenumber") == 1, F.lit(SOURCE_TYPE)).otherwise(F.lit("BEHAVIOR_visit")).alias("source_type"),
        day_of("l_shipdate").alias("update_day"),
    )


def closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-deal stand-in: (customer, status) of 3-MEDIUM orders."""
    o = read_table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderpriority") == CLOSED_DEAL_TITLE).select(
        F.col("o_custkey").alias("mobile"), F.col("o_orderstatus").alias("category"))


def prefix_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone-prefix stand-in: 15-char customer-name prefix -> nation name."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("Customer#0000"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("tel"),
        F.col("n_name").alias("city_short"),
    )


def nation_prefix_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-prefix stand-in for the golden parts: leading digits of the key
    -> nation name (the reference maps a 7-digit phone prefix to a city)."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("tel"),
                    F.col("n_name").alias("city_short"))


def customer_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as contacts whose city (market segment) is sometimes blank."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    city = F.when(k % 4 == 0, F.lit(" ")).when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select(k.alias("mobile"), F.col("c_name").alias("user_name"),
                    city.cast("string").alias("city_short"))


def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-catalog stand-in (``metadata_business`` layout): every customer
    is a table, so the catalog grows with the data."""
    c = read_table(spark, sf_dir, "customer")
    name = F.concat(F.lit("cust_"), F.col("c_custkey").cast("string"))
    return c.select(
        F.lit("dw_cust").alias("databasename"),
        name.alias("tablename"),
        F.col("c_name").alias("tbcomment"),
        F.lit("parquet").alias("storage"),
        F.lit("dw_cust").alias("databasepath"),
        name.alias("dbtablepath"),
    )


def column_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-metadata stand-in (``metadata_col_type`` layout): each order is
    a column of its customer's table, ranked by order key (as text).  Some
    warehouse names are those that a column map leaves out."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    name = F.concat(F.lit("o_"), key.cast("string"))
    return o.select(
        F.concat(F.lit("dw_cust.cust_"), F.col("o_custkey").cast("string")).alias("dbtable"),
        F.when(key % 7 == 0, F.lit("mobile")).when(key % 7 == 1, F.lit("source"))
        .when(key % 7 == 2, F.lit("source_type")).otherwise(name).alias("dswhcolname"),
        name.alias("buiscolname"),
        F.lit("string").alias("buiscoltype"),
        F.col("o_orderpriority").alias("buiscolcomment"),
        key.cast("string").alias("buiscolrank"),
    )


def contact_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts with their time: events of a user."""
    return read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("contact_id"), F.col("event_type").alias("source_type"), F.col("ts").alias("contact_time"))


def contact_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts whose attributes are one map; some names depend on the row."""
    eid = F.col("event_id")
    return contacts(spark, sf_dir).select(
        "contact_id", "update_day", "update_time", "event_id",
        F.create_map(F.lit("attr_a"), F.col("attr_a"), F.lit("attr_b"), F.col("attr_b"),
                     F.concat(F.lit("name_"), (eid % 200).cast("string")), F.col("source_type")).alias("attributes"))


def age_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden rows that state an age range."""
    start, end = F.col("age_start").try_cast("int"), F.col("age_end").try_cast("int")
    return golden_parts(spark, sf_dir).where(start.isNotNull() & end.isNotNull()).select(
        "mobile", "source_type", start.alias("age_from"), end.alias("age_to"))


def range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age-range rules from ``supplier``: short and long ones, some open at an end, some empty."""
    k = F.col("s_suppkey")
    return read_table(spark, sf_dir, "supplier").select(
        k.alias("rule_id"),
        F.when(k % 10 != 0, k % 50).cast("int").alias("rule_from"),
        F.when(k % 15 != 0, k % 50 + F.when(k % 7 == 0, 30).otherwise(k % 5 - 1)).cast("int").alias("rule_to"))


def nation_tables(spark: SparkSession, sf_dir: str, database: str) -> DataFrame:
    """Table metadata with a table for each nation."""
    n = read_table(spark, sf_dir, "nation")
    name = F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string"))
    return n.select(F.lit(database).alias("databasename"), name.alias("tablename"), F.col("n_name").alias("tbcomment"),
                    F.lit("parquet").alias("storage"), F.lit("tables").alias("databasepath"), name.alias("dbtablepath"))


def nation_columns(spark: SparkSession, sf_dir: str, database: str) -> DataFrame:
    """Column metadata with a column for each customer of a nation."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    name = F.concat(F.lit("c_"), key.cast("string"))
    return c.select(F.concat(F.lit(f"{database}.nation_"), F.col("c_nationkey").cast("string")).alias("dbtable"),
                    name.alias("dswhcolname"), name.alias("buiscolname"),
                    F.when(key % 3 == 0, "int").when(key % 3 == 1, "string").otherwise("double").alias("buiscoltype"),
                    F.coalesce("c_mktsegment", F.lit("")).alias("buiscolcomment"), key.cast("string").alias("buiscolrank"))
