"""Binding of the shared test tables to the warehouse's two raw inputs.

The warehouse reads a raw POI file and a raw trip file. The test data is a
TPC-H-like star schema, so these functions derive frames with exactly the raw
CSV headers from it, entirely in Spark (joins and one group-by per order):

* raw POI  = supplier JOIN nation JOIN part ON p_partkey = s_suppkey
* raw trip = one row per order that has lines; the visit list is the order's
  supplier keys in (l_linenumber, l_suppkey, l_partkey) order
* dirty trip = raw trip with injected nulls, bad dates, blank list items and
  duplicate rows, for the cleaning checks
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermart.functions.rules import CategoryRules

# Years present in the test tables (orders run from 1995 to 2001).
TEST_YEAR_RANGE = (1995, 2002)

# Category rules of the test binding (part names are English words).
TEST_CATEGORY_RULES = CategoryRules(patterns=(("fastener", "ring|bolt"), ("drive", "gear|rod")))


# Declared schemas of the columns the binding reads (no schema inference:
# inference costs a footer-reading job per scan and hides type drift).
TEST_TABLE_SCHEMAS = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TEST_TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def raw_poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame with the raw POI CSV headers, every column text."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
          .join(p, p.p_partkey == s.s_suppkey))
    key = F.col("s_suppkey")
    label = F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string")) \
             .otherwise(F.regexp_replace("p_name", " ", ";"))
    return j.select(
        key.cast("string").alias("Encrypted_ID"),
        F.col("s_name").alias("Name_ZH"),
        F.col("s_name").alias("Name_EN"),
        F.col("n_name").alias("City_ZH"),
        F.col("n_name").alias("City_EN"),
        (F.lit(4) + (key * 7) % 52).cast("string").alias("Latitude_GCJ02"),
        (F.lit(73) + (key * 11) % 64).cast("string").alias("Longitude_GCJ02"),
        label.alias("Label_ZH"),
        F.col("p_name").alias("Label_EN"),
    )


def _visit_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    return li.groupBy("l_orderkey").agg(
        F.array_join(F.transform(ordered, lambda e: e["l_suppkey"].cast("string")), ";").alias("seq"))


def _raw_trip_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lists = _visit_lists(spark, sf_dir)
    j = o.join(lists, o.o_orderkey == lists.l_orderkey)
    prio = F.col("o_orderpriority")
    partner = (F.when(prio == "1-URGENT", F.lit("Solo"))
                .when(prio == "4-NOT SPECIFIED", F.lit(None).cast("string"))
                .otherwise(prio))
    day = F.date_format("o_orderdate", "yyyy/M/d")
    return j.select(
        F.col("o_orderkey").alias("_k"),
        F.col("o_custkey").cast("string").alias("Anonymized_Blog_ID"),
        day.alias("Retrieval_Date"),
        day.alias("Departure_Date"),
        partner.alias("Travel_Partners"),
        F.col("seq").alias("Visit_Sequence"),
    )


RAW_TRIP_COLUMNS = ["Anonymized_Blog_ID", "Retrieval_Date", "Departure_Date", "Travel_Partners", "Visit_Sequence"]


def raw_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame with the raw trip CSV headers, every column text."""
    return _raw_trip_columns(spark, sf_dir).select(*RAW_TRIP_COLUMNS)


def dirty_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip with dirt injected by order key (every row is kept).

    k % 101 == 0: departure date null; else k % 97 == 0: '/' written as '-';
    k % 7 == 0: ';; ;' appended to the visit list;
    k % 10 == 0: the row appears twice, the copy with partner 'Family'.
    """
    base = _raw_trip_columns(spark, sf_dir)
    k = F.col("_k")
    dep = (F.when(k % 101 == 0, F.lit(None).cast("string"))
            .when(k % 97 == 0, F.regexp_replace("Departure_Date", "/", "-"))
            .otherwise(F.col("Departure_Date")))
    seq = F.when(k % 7 == 0, F.concat(F.col("Visit_Sequence"), F.lit(";; ;"))).otherwise(F.col("Visit_Sequence"))
    dirty = base.withColumn("Departure_Date", dep).withColumn("Visit_Sequence", seq)
    copies = dirty.filter(k % 10 == 0).withColumn("Travel_Partners", F.lit("Family"))
    return dirty.select(*RAW_TRIP_COLUMNS).unionByName(copies.select(*RAW_TRIP_COLUMNS))


#: One label for each default category rule in order, one that hits none, and null.
RULE_LABELS = ("峡谷漂流", "名人故居", "古镇", "高楼", "步行街;商圈", "农庄", "湖泊", "写字楼", None)


def dirty_poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One POI row for each part, with the raw CSV headers and dirt by part key.

    Ids repeat (k % 1500); k % 53, 59, 61, 67, 71 == 0: id, name, city,
    latitude, longitude null; k % 31 == 0: latitude is no number. Labels hit
    every default category rule, none, or are null (k % 9).
    """
    k = F.col("p_partkey")
    text = lambda c: c.cast("string")
    label = F.element_at(F.array(*map(F.lit, RULE_LABELS)), (k % 9 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").select(
        F.when(k % 53 != 0, text(k % 1500)).alias("Encrypted_ID"),
        F.when(k % 59 != 0, F.concat(F.lit("n"), text(k))).alias("Name_ZH"),
        F.col("p_name").alias("Name_EN"),
        F.when(k % 61 != 0, F.concat(F.lit("c"), text(k % 40))).alias("City_ZH"),
        F.concat(F.lit("c"), text(k % 40)).alias("City_EN"),
        F.when(k % 67 == 0, F.lit(None)).when(k % 31 == 0, F.lit("x12")).otherwise(text(1 + (k * 7) % 56)).alias("Latitude_GCJ02"),
        F.when(k % 71 != 0, text(70 + (k * 11) % 68)).alias("Longitude_GCJ02"),
        label.alias("Label_ZH"), F.col("p_name").alias("Label_EN"))


def gappy_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw trip for every order: the visit list is null without lines, the user is null for k % 89 == 0."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lists = _visit_lists(spark, sf_dir)
    day = F.date_format("o_orderdate", "yyyy/M/d")
    return o.join(lists, o.o_orderkey == lists.l_orderkey, "left").select(
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_custkey").cast("string")).alias("Anonymized_Blog_ID"),
        day.alias("Retrieval_Date"), day.alias("Departure_Date"), F.lit("Solo").alias("Travel_Partners"), F.col("seq").alias("Visit_Sequence"))


def write_messy_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw trips as CSV files below ``path``, a line for each, with two orders of columns and broken lines.

    Odd order keys go to files whose header is reversed. k % 11 == 0: the last
    field is missing; else k % 13 == 0: a field too many; else k % 17 == 0: the
    partner starts with a quotation mark that nothing closes.
    """
    k = F.col("_k")
    partner = F.coalesce("Travel_Partners", F.lit(""))
    partner = F.when((k % 11 != 0) & (k % 13 != 0) & (k % 17 == 0), F.concat(F.lit('"'), partner)).otherwise(partner)
    rows = _raw_trip_columns(spark, sf_dir).withColumn("Travel_Partners", partner)
    for odd, columns in ((0, RAW_TRIP_COLUMNS), (1, RAW_TRIP_COLUMNS[::-1])):
        line = (F.when(k % 11 == 0, F.concat_ws(",", *columns[:-1]))
                 .when(k % 13 == 0, F.concat_ws(",", *columns, F.lit("surplus")))
                 .otherwise(F.concat_ws(",", *columns)))
        # one column whose name is the header; separator and quote are characters that no line has
        (rows.where(k % 2 == odd).select(line.alias(",".join(columns)))
         .write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(f"{path}/order={odd}"))


#: Orders from this day on, and those of one earlier quarter whose key divides by three, arrive in a second load.
SECOND_LOAD_FROM, LATE_QUARTER = "2001-01-01", (1997, 2)


def two_loads(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """The raw trips, cut into those of a first load and those that arrive later; every tenth late one comes in both, with another partner.

    ``write`` keeps the trips in a table that both loads read, so they are put together once.
    """
    base = write(_raw_trip_columns(spark, sf_dir), "raw_trips").withColumn("_day", F.to_date("Departure_Date", "yyyy/M/d"))
    k, day = F.col("_k"), F.col("_day")
    late = (F.year(day) == LATE_QUARTER[0]) & (F.quarter(day) == LATE_QUARTER[1]) & (k % 3 == 0)
    second = (day >= SECOND_LOAD_FROM) | late
    first = base.where(~second | (late & (k % 10 == 0))).withColumn("Travel_Partners", F.when(second, F.lit("zz")).otherwise(F.col("Travel_Partners")))
    return first.select(*RAW_TRIP_COLUMNS), base.where(second).select(*RAW_TRIP_COLUMNS)


def skewed_visits(visits: DataFrame, poi_id: str = "1") -> DataFrame:
    """The visits with one place in about a third of them, and no place in some."""
    n = F.length("trip_id") + F.length("poi_id") + F.col("travel_month")
    return visits.withColumn("poi_id", F.when(n % 3 == 0, F.lit(poi_id)).when(n % 17 != 0, F.col("poi_id")))
