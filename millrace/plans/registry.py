"""One query per operator over the driver tables.

Every query reads its tables whole.  Results are flat: arrays are unfolded to rows,
and doubles are rounded where the order of additions may differ between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import vectors as vec
from millrace.functions.dates import decade, julian_day
from millrace.functions.hashing import murmur3_32
from millrace.functions.text import words
from millrace.operators import counting, graph, sketches, totals, trends
from millrace.operators.lsh import SignHash, lsh_index, lsh_nearest, sign_bits
from millrace.operators.lsh_store import StoredIndex
from millrace.operators.neighbours import nearest
from millrace.plans import inputs, reports
from millrace.session import materialise, scratch_dir
from millrace.sources import tables, text
from millrace.streaming.counting import count_arriving, counts_so_far, stream_word_count, text_stream

Query = Callable[[SparkSession, str], DataFrame]

REGISTERS = 1024
BUCKETS = 128
QUALITY_SEED = 0x418B6C16
DECADES = (1990, 2000)
DIMENSIONS = 64
SCHEME = SignHash(planes=16, bits=6, tables=4, seed=1234)
EXACT = 1e-6

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, less a closing underscore."""
    QUERIES[build.__name__.removesuffix("_")] = build
    return build


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


# Added before rounding: larger than the rounding noise of sums, and no round number.
NUDGE = 1.234567e-7


def settled(name: str, digits: int = 4) -> Column:
    """Rounded, for means and slopes of prices: many are exact halves of a last digit.

    Sums in another order may miss a half by a hair; the nudge puts all of them on the
    same side.
    """
    return F.round(F.col(name) + F.lit(NUDGE), digits).alias(name)


# Words

@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return counting.word_count(inputs.corpus(spark, folder))


@query
def word_count_per_doc(spark: SparkSession, folder: str) -> DataFrame:
    return counting.word_count_by(inputs.corpus(spark, folder), ("doc_id",))


@query
def word_count_in_doc(spark: SparkSession, folder: str) -> DataFrame:
    """The same without an exchange, as a document is one row."""
    return counting.word_count_in_rows(inputs.corpus(spark, folder), ("doc_id",))


@query
def word_count_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per language, added up."""
    return counting.merge_counts(counting.word_count_by(inputs.corpus(spark, folder), ("lang",)))


@query
def word_count_merge_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of three corpora, added up."""
    corpora = [inputs.corpus(spark, folder)] + [
        inputs.table(spark, folder, name).select("text") for name in ("conversations", "benchmark")]
    return counting.merge_counts(*[counting.word_count(docs) for docs in corpora])


@query
def word_checksum(spark: SparkSession, folder: str) -> DataFrame:
    return counting.checksum(counting.word_count(inputs.corpus(spark, folder)))


@query
def word_checksum_direct(spark: SparkSession, folder: str) -> DataFrame:
    return counting.corpus_checksum(inputs.corpus(spark, folder))


@query
def word_top10(spark: SparkSession, folder: str) -> DataFrame:
    return counting.top_words(counting.word_count(inputs.corpus(spark, folder)))


@query
def stream_word_count_(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a file stream, counted batch by batch."""
    return stream_word_count(_documents_stream(spark, folder))


@query
def stream_running_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same with totals held as state."""
    return stream_word_count(_documents_stream(spark, folder), stateful=True)


@query
def stream_top10(spark: SparkSession, folder: str) -> DataFrame:
    return counting.top_words(stream_word_count_(spark, folder))


@query
def stream_checksum(spark: SparkSession, folder: str) -> DataFrame:
    return counting.checksum(stream_word_count_(spark, folder))


@query
def stream_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as arriving text files."""
    return stream_word_count(text_stream(spark, _text_files(spark, folder), STREAM_FILES))


@query
def stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving files in batches of bounded bytes, merged to a snapshot after every third."""
    home = scratch_dir(spark, "stream")
    stream = text_stream(spark, _text_files(spark, folder), bytes_per_batch=STREAM_BYTES)
    count_arriving(stream, f"{home}/counts", f"{home}/checkpoint", every=3)
    return counts_so_far(spark, f"{home}/counts")


#: Files a micro-batch, and bytes.
STREAM_FILES, STREAM_BYTES = 16, 4 << 20


def _documents_stream(spark: SparkSession, folder: str, files_per_batch: int = STREAM_FILES) -> DataFrame:
    """The table as a stream of its files, whether it is one file or a folder of them."""
    documents = inputs.table(spark, folder, "documents")
    reader = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", files_per_batch)
    if any("/documents.parquet/" in file for file in documents.inputFiles()[:1]):
        return reader.parquet(f"{folder}/documents.parquet").select("text")
    return reader.option("pathGlobFilter", "documents.parquet").parquet(folder).select("text")


@query
def corpus_report(spark: SparkSession, folder: str) -> DataFrame:
    """Checksum and top list of one stored count."""
    report = reports.corpus_report(inputs.corpus(spark, folder))
    total = report.checksum.select(F.lit("checksum").alias("part"), F.lit("").alias("word"), F.col("checksum").alias("n"))
    return total.unionByName(report.top.select(F.lit("top").alias("part"), "word", "n"))


# Keyed sums

@query
def keyed_sum(spark: SparkSession, folder: str) -> DataFrame:
    return totals.star_totals(inputs.resources(spark, folder))


@query
def keyed_sum_topk(spark: SparkSession, folder: str) -> DataFrame:
    return totals.largest(totals.star_totals(inputs.resources(spark, folder)), 5)


@query
def keyed_sum_all(spark: SparkSession, folder: str) -> DataFrame:
    """k = 0 keeps every group."""
    return totals.largest(totals.star_totals(inputs.resources(spark, folder)), 0)


# Follow graph

def _summary(degrees: DataFrame) -> DataFrame:
    return graph.degree_summary(degrees).withColumn("mean_degree", F.round("mean_degree", 6))


@query
def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    return graph.out_degree(inputs.follow_links(spark, folder))


@query
def follows_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(graph.out_degree(inputs.follow_links(spark, folder)))


@query
def in_degree(spark: SparkSession, folder: str) -> DataFrame:
    return graph.in_degree(inputs.follow_links(spark, folder))


@query
def followers_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(graph.in_degree(inputs.follow_links(spark, folder)))


# Trends

def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return trends.daily_means(inputs.readings(spark, folder))


def _slopes(spark: SparkSession, folder: str) -> DataFrame:
    return trends.station_slopes(_daily(spark, folder))


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return trends.decade_difference(_daily(spark, folder), *DECADES)


@query
def julian_day_(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return inputs.table(spark, folder, "orders").select("o_orderkey", julian_day(day).alias("jdn"))


@query
def decade_(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return inputs.table(spark, folder, "orders").groupBy(decade(day).alias("decade")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def daily_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder).groupBy("decade").agg(
        F.count("avg_t").alias("known"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum("avg_t"), 2).alias("total"))


@query
def group_slope(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.named(_slopes(spark, folder), spark, folder).select("station", "name", settled("beta"))


@query
def group_slope_pairwise(spark: SparkSession, folder: str) -> DataFrame:
    slopes = trends.station_slopes(_daily(spark, folder), "pairwise")
    return inputs.named(slopes, spark, folder).select("station", "name", settled("beta"))


@query
def slope_top5(spark: SparkSession, folder: str) -> DataFrame:
    top = trends.top_by(_slopes(spark, folder), "beta", 5, "station")
    return inputs.named(top, spark, folder).select("station", "name", settled("beta"))


@query
def slope_positive_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return trends.positive_fraction(_slopes(spark, folder), "beta").select(rounded("fraction"))


@query
def slope_five_numbers(spark: SparkSession, folder: str) -> DataFrame:
    row = trends.five_numbers(_slopes(spark, folder), "beta", EXACT)
    return row.select(*[settled(name) for name in trends.FIVE_RANKS])


@query
def slope_quantiles_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The five numbers without a sketch's error, whatever the number of rows."""
    return trends.exact_five_numbers(materialise(_slopes(spark, folder).select("beta"), "slopes"), "beta").select(
        *[settled(name) for name in trends.FIVE_RANKS])


@query
def decade_avg(spark: SparkSession, folder: str) -> DataFrame:
    averages = trends.decade_averages(_daily(spark, folder), DECADES)
    return inputs.named(averages, spark, folder).select("station", "name", "decade", settled("decade_avg"))


@query
def decade_diff(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.named(_changes(spark, folder), spark, folder).select(
        "station", "name", settled("early_avg"), settled("late_avg"), settled("diff_c"))


@query
def decade_diff_top5(spark: SparkSession, folder: str) -> DataFrame:
    top = trends.top_by(_changes(spark, folder), "diff_c", 5, "station")
    return inputs.named(top, spark, folder).select("station", "name", settled("diff_c"))


@query
def decade_diff_positive_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return trends.positive_fraction(_changes(spark, folder), "diff_c").select(rounded("fraction"))


@query
def decade_diff_five_numbers(spark: SparkSession, folder: str) -> DataFrame:
    row = trends.five_numbers(_changes(spark, folder), "diff_c", EXACT)
    return row.select(*[settled(name) for name in trends.FIVE_RANKS])


@query
def climate_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Slopes and decade averages of one scan, side by side."""
    profile = trends.station_profile(_daily(spark, folder), DECADES)
    slopes = trends.slopes_of(profile).select(
        "station", "name", F.lit(0).alias("decade"), settled("beta").alias("value"))
    averages = trends.averages_of(profile).select(
        "station", "name", "decade", settled("decade_avg").alias("value"))
    return inputs.named(slopes.unionByName(averages), spark, folder).select("station", "name", "decade", "value")


@query
def climate_report(spark: SparkSession, folder: str) -> DataFrame:
    """Both summaries of the report, one row each."""
    report = reports.climate_report(inputs.readings(spark, folder), *DECADES, error=EXACT)

    def part(name: str, row: DataFrame) -> DataFrame:
        return row.select(F.lit(name).alias("part"), *[settled(c) for c in row.columns])

    return part("slope", report.slope_summary).unionByName(part("difference", report.difference_summary))


@query
def climate_report_top(spark: SparkSession, folder: str) -> DataFrame:
    """Both top lists of the report."""
    report = reports.climate_report(inputs.readings(spark, folder), *DECADES, error=EXACT)
    slopes = report.top_slopes.select(F.lit("slope").alias("part"), "station", settled("beta").alias("value"))
    changes = report.top_differences.select(F.lit("difference").alias("part"), "station", settled("diff_c").alias("value"))
    return inputs.named(slopes.unionByName(changes), spark, folder).select("part", "station", "name", "value")


# Hashes and sketches

def _words(spark: SparkSession, folder: str) -> DataFrame:
    return words(inputs.corpus(spark, folder))


@query
def hash_murmur3(spark: SparkSession, folder: str) -> DataFrame:
    hashed = murmur3_32(_words(spark, folder).distinct(), "word", 0, "h")
    return murmur3_32(hashed, "word", QUALITY_SEED, "h_seeded")


@query
def hll_jr(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.register_updates(_words(spark, folder).distinct(), "word", REGISTERS).select("word", "j", "r")


@query
def hll_registers(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.hll_registers(_words(spark, folder), "word", REGISTERS)


@query
def hll_estimate(spark: SparkSession, folder: str) -> DataFrame:
    return reports.distinct_words(inputs.corpus(spark, folder), REGISTERS).select(rounded("estimate", 4))


@query
def hll_by_language(spark: SparkSession, folder: str) -> DataFrame:
    """Stored sketches per language, and their roll-up to the whole corpus, which reads no word again."""
    tokens = words(inputs.corpus(spark, folder), keep=("lang",))
    stored = materialise(sketches.hll_sketches(tokens, "word", "lang", REGISTERS), "sketches")
    each = sketches.hll_estimate(stored, REGISTERS, "lang")
    whole = sketches.hll_estimate(sketches.merge_sketches(stored), REGISTERS).select(F.lit("all").alias("lang"), "estimate")
    return each.unionByName(whole).select("lang", rounded("estimate", 4))


@query
def hll_against_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The exact number of distinct words, and whether both estimates come near it."""
    tokens, none = _words(spark, folder), F.lit(None).cast("double")
    # Two scans, one row each, brought together by an aggregation.
    counted = tokens.agg(
        F.count_distinct("word").alias("exact"), F.approx_count_distinct("word", 0.02).cast("double").alias("builtin"), none.alias("ours"))
    estimated = reports.distinct_words(inputs.corpus(spark, folder), REGISTERS).select(
        F.lit(None).cast("bigint").alias("exact"), none.alias("builtin"), F.col("estimate").alias("ours"))
    one_row = counted.unionByName(estimated).agg(*[F.max(name).alias(name) for name in ("exact", "builtin", "ours")])

    def near(estimate: str) -> Column:
        return (F.abs(F.col(estimate) - F.col("exact")) <= 0.1 * F.col("exact")).alias(f"{estimate}_near")

    return one_row.select("exact", near("ours"), near("builtin"))


@query
def hash_bucket_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.hash_histogram(_words(spark, folder).distinct(), "word", BUCKETS, QUALITY_SEED)


@query
def hash_bucket_stats(spark: SparkSession, folder: str) -> DataFrame:
    histogram = sketches.hash_histogram(_words(spark, folder).distinct(), "word", BUCKETS, QUALITY_SEED)
    return sketches.hash_quality(histogram).select(
        "keys", rounded("mean"), rounded("deviation"), F.col("collisions").cast("double").alias("collisions"),
        rounded("probability", 9))


# Vectors

def _unit_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vec.normalise(inputs.word_vectors(spark, folder))


def _word_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every word asks for its neighbours."""
    return inputs.word_vectors(spark, folder).select(F.col("id").alias("qid"), "label")


def _answers(found: DataFrame) -> DataFrame:
    return found.select("qid", "rank", "id", "neighbour", rounded("score"))


@query
def vec_normalize(spark: SparkSession, folder: str) -> DataFrame:
    unfolded = _unit_vectors(spark, folder).select("id", F.posexplode_outer("vec").alias("pos", "x"))
    return unfolded.select(
        "id", "pos", rounded("x"))


@query
def vec_pair_distances(spark: SparkSession, folder: str) -> DataFrame:
    """Dot product and distances of each vector and its shifted copy."""
    a, b = F.col("vec"), F.col("other")
    both = inputs.plain_vectors(spark, folder).join(
        inputs.shifted_queries(spark, folder).select(F.col("qid").alias("id"), F.col("vec").alias("other")), "id")
    both = both.withColumn("aa", vec.squared_norm(a)).withColumn("bb", vec.squared_norm(b))
    expanded = vec.squared_distance_from_norms(a, b, F.col("aa"), F.col("bb"))
    return both.select(
        "id", F.round(vec.dot(a, b), 6).alias("dot"), F.round(vec.euclidean(a, b), 6).alias("distance"),
        F.round(expanded, 6).alias("squared"))


@query
def vec_cosine_top3(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.cosine_neighbours(inputs.word_vectors(spark, folder), _word_queries(spark, folder), 3)
    return _answers(found)


def _nearest_rows(spark: SparkSession, folder: str, metric: str = "l2", **search) -> DataFrame:
    return nearest(inputs.plain_vectors(spark, folder), inputs.shifted_queries(spark, folder), 1, metric, **search)


@query
def vec_nn_l2(spark: SparkSession, folder: str) -> DataFrame:
    return _nearest_rows(spark, folder).select("qid", "id", rounded("score").alias("distance"))


@query
def vec_nn_l2_expanded(spark: SparkSession, folder: str) -> DataFrame:
    return _nearest_rows(spark, folder, "l2_expanded").select("qid", "id", rounded("score").alias("squared"))


@query
def vec_nn_l2_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for queries too many to broadcast, with slices of 200 rows."""
    return _nearest_rows(spark, folder, query_block=100, max_broadcast_bytes=0, slice_rows=200).select(
        "qid", "id", rounded("score").alias("distance"))


@query
def vec_nn_verify(spark: SparkSession, folder: str) -> DataFrame:
    return reports.count_wrong(
        _nearest_rows(spark, folder), inputs.plain_vectors(spark, folder), inputs.expected_labels(spark, folder))


@query
def vec_nn_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return reports.wrong_answers(
        _nearest_rows(spark, folder), inputs.plain_vectors(spark, folder), inputs.expected_labels(spark, folder))


@query
def points_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest customer of each supplier in the plane of balance and nation."""
    points = inputs.customer_points(spark, folder).withColumn("vec", F.array("easting", "northing"))
    return nearest(points, inputs.supplier_points(spark, folder)).select(
        "qid", "id", rounded("score", 4).alias("distance"))


@query
def hyperplane_bits(spark: SparkSession, folder: str) -> DataFrame:
    bits = sign_bits(_unit_vectors(spark, folder), SCHEME.draw_planes(DIMENSIONS))
    return bits.select("id", F.array_join(F.transform("bits", lambda bit: bit.cast("string")), "").alias("bits"))


@query
def lsh_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_index(_unit_vectors(spark, folder), SCHEME).select("tbl", "bucket", "id")


@query
def lsh_top3(spark: SparkSession, folder: str) -> DataFrame:
    return _answers(reports.lsh_neighbours(
        inputs.word_vectors(spark, folder), _word_queries(spark, folder), SCHEME, 3))


@query
def lsh_top3_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for queries too many to broadcast, with buckets cut at 16 rows."""
    return _answers(reports.lsh_neighbours(
        inputs.word_vectors(spark, folder), _word_queries(spark, folder), SCHEME, 3,
        max_broadcast_bytes=0, slice_rows=16))


@query
def lsh_stored_index(spark: SparkSession, folder: str) -> DataFrame:
    """An index built of two thirds of the vectors, appended to, opened again and searched."""
    known, home = inputs.word_vectors(spark, folder), scratch_dir(spark, "lsh-index")
    unit = vec.normalise(known)
    StoredIndex.build(unit.filter("id % 3 > 0"), SCHEME, home).append(unit.filter("id % 3 = 0"))
    return _answers(reports.lsh_neighbours(known, _word_queries(spark, folder), SCHEME, 3, StoredIndex.open(spark, home)))


@query
def lsh_ranking_with_self(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates including the query itself, which leads its own ranking."""
    unit = _unit_vectors(spark, folder)
    asked = unit.select(F.col("id").alias("qid"), "vec")
    found = lsh_nearest(lsh_index(unit, SCHEME), asked, SCHEME, 10)
    return found.select("qid", "rank", "id", rounded("score"))


# Files

def _stored(df: DataFrame, purpose: str, fmt: str = "text", **options: object) -> str:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.options(**options).format(fmt).save(path)
    return path


def _text_files(spark: SparkSession, folder: str) -> str:
    """Documents as text files in folders by language."""
    path = scratch_dir(spark, "corpus")
    inputs.corpus(spark, folder).select("lang", "text").write.partitionBy("lang").text(path)
    return path


@query
def scan_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as text files, walked and counted."""
    return counting.word_count(text.read_corpus(spark, _text_files(spark, folder)))


@query
def scan_hidden_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as text files, half of them below a folder with a hidden name, walked from a glob and counted."""
    docs, path = inputs.corpus(spark, folder).select("doc_id", "lang", "text"), scratch_dir(spark, "corpus")
    for part, below in enumerate(("plain", "plain/_late")):
        docs.filter(F.pmod("doc_id", F.lit(2)) == part).select("lang", "text").write.partitionBy("lang").text(f"{path}/{below}")
    return counting.word_count(text.read_corpus(spark, f"{path}/*"))


@query
def scan_links(spark: SparkSession, folder: str) -> DataFrame:
    """The graph as lines of many ids, read between blanks and not by lines: in-degrees."""
    return graph.in_degree(text.read_links(spark, _stored(inputs.adjacency_lines(spark, folder), "graph")))


@query
def scan_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    """The graph as lines of many ids, parsed back: in-degrees."""
    path = _stored(inputs.adjacency_lines(spark, folder), "graph")
    adjacency = graph.parse_adjacency(text.read_lines(spark, path))
    return graph.in_degree(graph.links(adjacency))


@query
def scan_adjacency_out(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines: ids per line, added up by user."""
    path = _stored(inputs.adjacency_lines(spark, folder), "graph")
    lines = graph.line_out_degree(graph.parse_adjacency(text.read_lines(spark, path)))
    return lines.groupBy("user").agg(F.sum("degree").alias("degree"))


@query
def scan_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Resource rows as comma lines with a header in every file, summed."""
    unused = [F.lit("-").alias(name) for name in ("kind", "mass", "age")]
    rows = inputs.resources(spark, folder).select(
        F.col("constellation").alias("Constellation"), "star", *unused, "units")
    path = _stored(rows, "resources", "csv", header=True)
    return totals.star_totals(tables.read_resources(spark, path))


@query
def scan_climate(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as CSV of two layouts, with quoted names and other columns between, read by name."""
    rows = inputs.named(inputs.readings(spark, folder), spark, folder).select(
        F.col("station").alias("STATION"), F.lit(0.0).alias("ELEVATION"),
        F.concat("name", F.lit(", WY US")).alias("NAME"), F.col("date").alias("DATE"),
        F.col("tmax").alias("TMAX"), F.col("tmin").alias("TMIN"))
    path = scratch_dir(spark, "climate")
    # Half of the files have their columns the other way round, and one more.
    late = F.col("DATE") >= F.lit("1998-01-01").cast("date")
    rows.filter(~late).write.csv(f"{path}/early", header=True)
    rows.filter(late).select(*reversed(rows.columns), F.lit(1).alias("PRCP")).write.csv(f"{path}/late", header=True)
    path = f"{path}/*"
    daily = trends.daily_means(tables.read_climate(spark, path))
    return trends.decade_averages(daily, DECADES).select("station", "name", "decade", settled("decade_avg"))


@query
def scan_points(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored(inputs.customer_points(spark, folder).drop("id"), "points", "csv", header=True)
    points = tables.read_points(spark, path)
    return points.select("label", *[
        F.round(F.col("vec")[i].cast("double"), 4).alias(name) for i, name in enumerate(("easting", "northing"))])


@query
def scan_word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as text in id order, read back with their line numbers."""
    numbers = F.transform("vec", lambda x: x.cast("string"))
    line = F.concat_ws(" ", "label", F.array_join(numbers, " "))
    path = _stored(inputs.plain_vectors(spark, folder).orderBy("id").select(line.alias("value")), "vectors")
    return text.read_word_vectors(spark, path).select(
        "id", "label", F.size("vec").alias("dims"), F.round(vec.squared_norm(F.col("vec")), 5).alias("squared"))


@query
def scan_query_list(spark: SparkSession, folder: str) -> DataFrame:
    """Query words as lines from the last id to the first, read back and looked up."""
    known = inputs.plain_vectors(spark, folder)
    path = _stored(known.orderBy(F.desc("id")).select(F.col("label").alias("value")), "query_words")
    return reports.look_up(text.read_query_list(spark, path), known).select("qid", "label", F.col("skip").alias("id"))


@query
def scan_query_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Query vectors as lines of numbers, read back and answered."""
    numbers = F.transform("vec", lambda x: x.cast("float").cast("string"))
    rows = inputs.shifted_queries(spark, folder).orderBy("qid").select(F.array_join(numbers, " ").alias("value"))
    path = _stored(rows, "query_vectors")
    asked = text.read_query_matrix(spark, path)
    return nearest(inputs.plain_vectors(spark, folder), asked).select("qid", "id", rounded("score", 4).alias("distance"))


@query
def answers_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The answer check with vectors, queries and expected labels all read from text files."""
    def lines(*parts: Column) -> Column:
        return F.concat_ws(" ", *parts).alias("value")

    numbers = F.array_join(F.transform("vec", lambda x: x.cast("float").cast("string")), " ")
    data = _stored(inputs.plain_vectors(spark, folder).orderBy("id").select(lines("label", numbers)), "vectors")
    asked = _stored(inputs.shifted_queries(spark, folder).orderBy("qid").select(lines(numbers)), "query_vectors")
    wanted = _stored(inputs.expected_labels(spark, folder).orderBy("qid").select(F.col("expected").alias("value")), "labels")
    vectors = text.read_word_vectors(spark, data)
    found = nearest(vectors, text.read_query_matrix(spark, asked))
    expected = text.read_query_list(spark, wanted).select("qid", F.col("label").alias("expected"))
    return reports.count_wrong(found, vectors, expected)


@query
def sink_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Totals stored in each format and read back."""
    result = totals.star_totals(inputs.resources(spark, folder))

    def stored(fmt: str) -> DataFrame:
        path = scratch_dir(spark, f"sink-{fmt}")
        tables.write_result(result, path, fmt)
        back = spark.read.schema(result.schema).option("header", True).format(fmt).load(path)
        return back.select(F.lit(fmt).alias("format"), "name", "total")

    parts = [stored(fmt) for fmt in tables.SINK_FORMATS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
