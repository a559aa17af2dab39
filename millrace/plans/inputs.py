"""The driver tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """A file is a document: ``doc_id, lang, text``."""
    return spread(table(spark, folder, "documents").select("doc_id", "lang", "text"))


def resources(spark: SparkSession, folder: str) -> DataFrame:
    """A brand is a constellation, a part type a star, and STANDARD its main one."""
    kind = F.col("p_type")
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("constellation"),
        F.when(kind == "STANDARD", F.lit("Prime")).otherwise(kind).alias("star"),
        F.col("p_size").alias("units"),
    )


def follow_links(spark: SparkSession, folder: str) -> DataFrame:
    """A part follows the orders that hold it; every part is a user."""
    nobody = F.lit(None).cast("bigint")
    users = table(spark, folder, "part").select(F.col("p_partkey").alias("user"), nobody.alias("followed"))
    edges = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("user"), F.col("l_orderkey").alias("followed"))
    return users.unionByName(edges)


def adjacency_lines(spark: SparkSession, folder: str, ids_per_line: int = 50) -> DataFrame:
    """The same graph as ``user: id id ...`` lines: ``value``.

    A user with many ids has several lines of about ``ids_per_line``, dealt by a hash of the row,
    so that no array grows with the busiest user.
    """
    links = follow_links(spark, folder).withColumn("row", F.monotonically_increasing_id())
    lines = links.groupBy("user").agg(F.ceil(F.count("followed") / ids_per_line).alias("lines"))
    dealt = links.join(lines, "user").withColumn("line", F.pmod(F.xxhash64("followed", "row"), F.greatest("lines", F.lit(1))))
    ids = F.array_join(F.transform(F.collect_list("followed"), lambda x: x.cast("string")), " ")
    listed = dealt.groupBy("user", "line").agg(ids.alias("ids"))
    return listed.select(F.concat(F.col("user").cast("string"), F.lit(": "), "ids").alias("value"))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """A customer is a station, and each order a day's reading, without a name as yet.

    The name depends on the station alone, so it is joined to the reduced rows (``named``): raw
    rows are combined before they move, and no task gets all rows of a busy station.
    """
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("station"), F.lit("").alias("name"),
        F.col("o_orderdate").cast("date").alias("date"),
        (price * F.lit(0.9)).alias("tmin"),
        F.when(F.col("o_orderstatus") != "P", price).alias("tmax"),
    )


def named(reduced: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Rows per station with their names."""
    names = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("station"), F.col("c_name").alias("name"))
    return reduced.drop("name").join(names, "station")


def _scaled(factor: Column, offset: Column | None = None) -> Column:
    def change(x: Column) -> Column:
        wide = x.cast("double") * factor
        return wide if offset is None else wide + offset

    return F.transform("embedding", change)


def word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``id, label, vec``, of unequal lengths so that normalising matters."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("label"),
        _scaled((F.col("vec_id") % 7 + 1).cast("double")).alias("vec"),
    )


def plain_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("label"),
        F.col("embedding").alias("vec"),
    )


def shifted_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector, a little off: ``qid, vec``."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("qid"), _scaled(F.lit(0.9), F.lit(0.01)).alias("vec"))


def expected_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The right answer of each query, but a wrong one for every third."""
    right = F.concat(F.lit("w"), F.col("vec_id").cast("string"))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("qid"),
        F.when(F.col("vec_id") % 3 == 0, F.lit("wrong")).otherwise(right).alias("expected"))


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("float").alias("easting"),
        (F.col("c_nationkey") * 100).cast("float").alias("northing"))


def supplier_points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("qid"),
        F.array(F.col("s_acctbal").cast("float"),
                (F.col("s_nationkey") * 100).cast("float")).alias("vec"))
