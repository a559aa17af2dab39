"""From raw documents to a training mix: five stages, each one operator over all that is left.

Every stage takes (spark, docs, sf_dir) and returns a table, which ``run`` writes as Parquet and
rereads for the next.  All but the last return the columns of documents, further ones included.
Null ids are compared as equal values; rows that share an id share their fate, except that of equal
ids with equal texts one row stays in the second stage.  An empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import find_contamination
from millrace.llm.kneser_ney import classify_quality
from millrace.llm.mixing import mix_sources
from millrace.llm.pseudonyms import replace_private
from millrace.llm.queries import PSEUDONYM_KEY, table, trusted_ids
from millrace.llm.simhash import near_duplicates
from millrace.session import materialise

SPANS, COPY = "_pii_spans", "mix_copy"
#: Names the key of the pseudonyms in the Spark configuration.  Whoever has the key can undo them, so a run over real
#: documents sets its own; without one the key of the registered queries is used, which is public.
KEY_SETTING = "spark.millrace.pseudonymKey"


def _by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``ids``, whose key column is _id, on equal or both null ids."""
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, by their perplexity and by that of their rarest trigrams,
    which shows insults in otherwise normal prose."""
    judged = classify_quality(docs, trusted_ids(spark, sf_dir))
    return _by_id(docs, judged.filter("NOT accepted").select(F.col("doc_id").alias("_id")).distinct(), "left_anti")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    marked = near_duplicates(docs)
    kept = marked.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"))
    left = _by_id(docs, kept, "inner")
    own = [docs[name] for name in docs.columns]
    single = left.filter(kept["_rows"] == 1).select(own)
    several = left.filter(kept["_rows"] > 1).select(own).dropDuplicates(["doc_id", "text"])
    return single.unionByName(several)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _by_id(docs, found.select(F.col("doc_id").alias("_id")).distinct(), "left_anti")


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms; n_chars, where there is such a column, follows the new text."""
    replaced = replace_private(docs, spark.conf.get(KEY_SETTING, PSEUDONYM_KEY), found_column=SPANS)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        replaced = replaced.withColumn("n_chars", F.when(F.size(SPANS) > 0, length).otherwise(F.col("n_chars")))
    return replaced.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered in mix_copy from 1."""
    copies = mix_sources(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies")).filter("_copies > 0")
    own = [docs[name] for name in docs.columns if name != COPY]
    return _by_id(docs, copies, "inner").select(*own, F.explode(F.sequence(F.lit(1), copies["_copies"].cast("int"))).alias(COPY))


STAGES = [
    ("quality", quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmarks),
    ("pii", pseudonymous),
    ("mix", mix),
]

#: Model scores, hashes and permutations have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
