"""Driver tables -> model tables.

The test tables are a TPC-H-like star schema plus an event stream.  These
adapters give them the camera-trap model's shape so every operator runs on
real, scale-growing input.  Each adapter has a twin SQL view in
``camstat.plans.sqlviews`` used by the DuckDB oracle; keep them in step.

Mapping (fixed):
* observations  <- events:   image=event_id, camera=user_id, plot=floor(user/4),
                             species=event_type, date_time=ts, confidence=value/500
* cameras       <- customer: site=nation, lon=-90+(key%700)/100, lat=50+((key*7)%550)/100
* deployments   <- orders:   first order date, last finished-order date per customer
* boxes         <- lineitem: image=orderkey, folder=suppkey, x=quantity, y=partkey%100,
                             w=1+discount*100, h=1+tax*100, confidence=discount*10
* cells         <- part:     land-cover raster cells on a 0.1 degree lattice
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.functions.timefn import with_date_keys

# fixed values: species names given to box rows (index = partkey % 9)
BOX_SPECIES = ["Moose", "Caribou", "Black Bear", "Gray Wolf", "Sandhill Crane",
               "Human", "Vehicle", "Unknown", "Other [See more species]"]
# fixed values: free-text species used when the label is the catch-all
OTHER_TEXT = "Red Fox"
# fixed values: scientific names for the observation species
SCIENTIFIC = {"click": "Alces alces", "error": "Rangifer tarandus", "purchase": "Ursus americanus",
              "signup": "Canis lupus", "view": "Antigone canadensis"}
OBS_SPECIES = sorted(SCIENTIFIC)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    df = ev.select(
        F.col("event_id").alias("obs_id"),
        F.col("event_id").cast("string").alias("image_id"),
        F.col("user_id").alias("camera_id"),
        F.floor(F.col("user_id") / 4).alias("plot_id"),
        F.col("event_type").alias("species"),
        F.col("ts").alias("date_time"),
        (F.col("value") / 500).alias("confidence"),
    )
    return with_date_keys(df, "date_time")


def long_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year observations (orders): camera=custkey, species=priority."""
    o = table(spark, sf_dir, "orders")
    df = o.select(F.col("o_orderkey").alias("obs_id"), F.col("o_custkey").alias("camera_id"),
                  F.floor(F.col("o_custkey") / 4).alias("plot_id"),
                  F.col("o_orderpriority").alias("species"), F.col("o_orderdate").alias("date_time"))
    return with_date_keys(df, "date_time")


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("camera_id"), F.floor(k / 4).alias("plot_id"),
                    F.col("c_nationkey").alias("site_id"),
                    (F.lit(-90.0) + (k % 700) / 100).alias("lon"),
                    (F.lit(50.0) + ((k * 7) % 550) / 100).alias("lat"),
                    F.col("c_mktsegment").alias("habitat"))


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("camera_id"))
            .agg(F.to_date(F.min("o_orderdate")).alias("date_deployed"),
                 F.to_date(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))))
                 .alias("date_retrieved")))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sp = F.element_at(F.array(*[F.lit(s) for s in BOX_SPECIES]),
                      (F.col("l_partkey") % len(BOX_SPECIES) + 1).cast("int"))
    return li.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("box_id"),
        F.col("l_orderkey").alias("image_id"),
        F.col("l_suppkey").alias("folder"),
        F.col("l_linenumber").alias("box"),
        F.col("l_quantity").alias("x"),
        (F.col("l_partkey") % 100).cast("double").alias("y"),
        (F.lit(1.0) + F.col("l_discount") * 100).alias("w"),
        (F.lit(1.0) + F.col("l_tax") * 100).alias("h"),
        (F.col("l_discount") * 10).alias("confidence"),
        (F.col("l_linenumber") % 4).alias("category_id"),
        ((F.col("l_orderkey") % 7) == 0).alias("isempty"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(sp).alias("species"),
        (F.col("l_linenumber") == 7).alias("manual"),
        F.when(F.col("l_returnflag") == "R", F.lit("manual"))
         .when(F.col("l_returnflag") == "A", F.lit("prediction,manual"))
         .otherwise(F.lit("prediction")).alias("origin"),
        F.col("l_shipdate").alias("date_time"),
    )


def annotation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in the survey format built from lineitem keys:
    ``P<supp>-<n>_CAM-<k>_DCIM_100RECNX_RCNX<order>x<part>_<box or M1>`` (unique)."""
    li = table(spark, sf_dir, "lineitem")
    box = F.when(F.col("l_linenumber") == 7, F.lit("M1")).otherwise(F.col("l_linenumber").cast("string"))
    id_ = F.concat(F.lit("P"), F.col("l_suppkey").cast("string"), F.lit("-"),
                   (F.col("l_orderkey") % 3 + 1).cast("string"),
                   F.lit("_CAM-"), (F.col("l_partkey") % 4 + 1).cast("string"),
                   F.lit("_DCIM_100RECNX_RCNX"), F.col("l_orderkey").cast("string"), F.lit("x"),
                   F.col("l_partkey").cast("string"), F.lit("_"), box)
    return li.select(id_.alias("id"), F.col("l_orderkey"), F.col("l_linenumber"),
                     F.col("l_partkey"), F.col("l_suppkey"), F.col("l_returnflag"), F.col("l_linestatus"),
                     F.col("l_shipdate"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(k.alias("cell_id"),
                    F.when(k % 2 == 0, F.lit(16)).otherwise(F.lit(17)).alias("utm"),
                    (F.lit(-90.0) + (k % 70) / 10).alias("cx"),
                    (F.lit(50.0) + (F.floor(k / 70) % 56) / 10).alias("cy"),
                    (F.col("p_size") % 13).alias("value"),
                    ((F.col("p_retailprice") % 100) / 100).alias("coverage_fraction"))
