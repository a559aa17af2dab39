"""SQL for the registered queries, to be run by another engine on the same tables."""

from __future__ import annotations

import numpy as np

from millrace.plans.registry import BUCKETS, DIMENSIONS, NUDGE, QUALITY_SEED, REGISTERS, SCHEME

# The white space characters, in the notation of RE2.
BLANK = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def word_rows(table: str, keep: str = "") -> str:
    return (
        f"SELECT {keep} word FROM (SELECT {keep} unnest(regexp_split_to_array(text, '{BLANK}')) AS word"
        f" FROM {table}) WHERE word <> ''"
    )


COUNTS = f"SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({word_rows('documents')}) GROUP BY word"
COUNTS_PER_DOC = (
    f"SELECT doc_id, word, CAST(count(*) AS BIGINT) AS n FROM ({word_rows('documents', 'doc_id,')})"
    " GROUP BY doc_id, word"
)
CHECKSUM = (
    f"SELECT CAST(coalesce(sum(length(word)), 0) AS BIGINT) AS checksum FROM ({word_rows('documents')})"
)
TOP10 = f"{COUNTS} ORDER BY n DESC, word DESC LIMIT 10"

STAR = "CASE WHEN p_type = 'STANDARD' THEN p_brand ELSE p_type || ' ' || p_brand END"
TOTALS = f"SELECT {STAR} AS name, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1"

EDGES = "SELECT l_partkey AS follower, l_orderkey AS followed FROM lineitem"
OUT_DEGREE = (
    f"SELECT u AS user, CAST(sum(c) AS BIGINT) AS degree FROM (SELECT p_partkey AS u, 0 AS c FROM part"
    f" UNION ALL SELECT follower, 1 FROM ({EDGES})) GROUP BY u"
)
IN_DEGREE = (
    f"SELECT u AS user, CAST(sum(c) AS BIGINT) AS degree FROM (SELECT p_partkey AS u, 0 AS c FROM part"
    f" UNION ALL SELECT follower, 0 FROM ({EDGES}) UNION ALL SELECT followed, 1 FROM ({EDGES})) GROUP BY u"
)


def degree_summary(degrees: str) -> str:
    return f"""
WITH d AS ({degrees})
SELECT CAST(count(*) AS BIGINT) AS users,
       (SELECT CAST("user" AS VARCHAR) FROM d ORDER BY degree DESC, CAST("user" AS VARCHAR) DESC LIMIT 1) AS max_user,
       max(degree) AS max_degree, round(sum(degree) / count(*), 6) AS mean_degree,
       CAST(count(*) FILTER (WHERE degree = 0) AS BIGINT) AS none_count
FROM d"""


DAILY = """
SELECT o_custkey AS station, c_name AS name, CAST(o_orderdate AS DATE) AS day,
       date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 2440588 AS jdn,
       CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade,
       (o_totalprice * 0.9::DOUBLE + CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) / 2 AS avg_t
FROM orders JOIN customer ON o_custkey = c_custkey"""
SLOPES = f"""
SELECT station, arg_min(name, day) AS name,
       coalesce(regr_sxy(avg_t, jdn), 0) / nullif(var_pop(jdn) * count(jdn), 0) AS beta
FROM ({DAILY}) GROUP BY station"""
SLOPES_PAIRWISE = f"""
SELECT station, arg_min(name, day) AS name,
       regr_sxy(avg_t, jdn) / nullif(regr_sxx(avg_t, jdn), 0) AS beta
FROM ({DAILY}) GROUP BY station"""
DECADE_AVERAGES = f"""
SELECT station, name, decade, avg(avg_t) AS decade_avg
FROM ({DAILY}) WHERE decade IN (1990, 2000) GROUP BY station, name, decade"""
CHANGES = f"""
WITH a AS ({DECADE_AVERAGES})
SELECT e.station, e.name, e.decade_avg AS early_avg, l.decade_avg AS late_avg,
       (l.decade_avg - 32) * 5 / 9 - (e.decade_avg - 32) * 5 / 9 AS diff_c
FROM a e JOIN a l ON e.station = l.station WHERE e.decade = 1990 AND l.decade = 2000"""


def settled(value: str) -> str:
    """Four digits, exact halves pushed to one side as in the queries."""
    return f"round({value} + {NUDGE}::DOUBLE, 4)"


def positive_share(value: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {value} > 0) AS DOUBLE) / nullif(count(*), 0)"


# The ranks of the five-number summary.
RANKS = {"min_value": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max_value": 1}


def five_numbers(value: str) -> str:
    return ", ".join(f"{settled(f'quantile_disc({value}, {rank})')} AS {name}" for name, rank in RANKS.items())


def report_part(part: str, rows: str, value: str) -> str:
    return (
        f"SELECT '{part}' AS part, {five_numbers(value)}, {settled(positive_share(value))} AS fraction FROM ({rows})"
    )


def murmur3(seed: int, rows: str) -> str:
    """``word, h`` for distinct words; unsigned 32-bit steps in 64-bit arithmetic."""
    def rol(x: str, by: int) -> str:
        return f"((({x} << {by}) | ({x} >> {32 - by})) & 4294967295)"

    def spun(word: str) -> str:
        return (
            f"list_reduce([{word} * 3432918353 & 4294967295],"
            f" lambda a, k: {rol('k', 15)} * 461845907 & 4294967295, 0::UBIGINT)"
        )

    def byte(at: str) -> str:
        return f"CAST(('0x' || substr(hx, 2 * ({at}) + 1, 2)) AS UBIGINT)"

    four = f"({byte('4 * i')} | ({byte('4 * i + 1')} << 8) | ({byte('4 * i + 2')} << 16) | ({byte('4 * i + 3')} << 24))"
    start = "n // 4 * 4"
    tail = (
        f"(CASE WHEN n % 4 > 2 THEN {byte(start + ' + 2')} << 16 ELSE 0::UBIGINT END"
        f" | CASE WHEN n % 4 > 1 THEN {byte(start + ' + 1')} << 8 ELSE 0::UBIGINT END"
        f" | CASE WHEN n % 4 > 0 THEN {byte(start)} ELSE 0::UBIGINT END)"
    )
    return f"""
WITH w AS (SELECT DISTINCT word FROM ({rows})),
b AS (SELECT word, hex(encode(word)) AS hx, CAST(octet_length(encode(word)) AS BIGINT) AS n FROM w),
k AS (SELECT word, n, list_transform(range(0, n // 4), lambda i: {spun(four)}) AS ks, {spun(tail)} AS t FROM b),
s AS (SELECT word, xor(xor(list_reduce(ks, lambda h, k: {rol('xor(h, k)', 13)} * 5 + 3864292196 & 4294967295,
             {seed}::UBIGINT), t), n::UBIGINT) AS h FROM k),
f1 AS (SELECT word, xor(h, h >> 16) * 2246822507 & 4294967295 AS h FROM s),
f2 AS (SELECT word, xor(h, h >> 13) * 3266489909 & 4294967295 AS h FROM f1)
SELECT word, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM f2"""


HASHED = murmur3(0, word_rows("documents"))
HASHED_QUALITY = murmur3(QUALITY_SEED, word_rows("documents"))
UPDATES = f"""
SELECT word, CAST(h & {REGISTERS - 1} AS INTEGER) AS j,
       CAST(CASE WHEN h = 0 THEN 0 ELSE 33 - length(bin(h)) END AS INTEGER) AS r FROM ({HASHED})"""
REACHED = f"SELECT j, max(r) AS r FROM ({UPDATES}) GROUP BY j"
def estimate(reached: str, by: str = "", group: str = "") -> str:
    return f"""
WITH z AS (SELECT {by} 0.7213 / (1 + 1.079 / {REGISTERS}.0) * {REGISTERS}.0 * {REGISTERS}.0
                  / (sum(CASE WHEN r > 0 THEN pow(2.0::DOUBLE, -r) END) + {REGISTERS} - count(*) FILTER (WHERE r > 0)) AS raw,
                  {REGISTERS} - count(*) FILTER (WHERE r > 0) AS empty FROM ({reached}) {group})
SELECT {by} round(CASE WHEN raw <= 2.5 * {REGISTERS} AND empty > 0 THEN {REGISTERS} * ln({REGISTERS}.0 / empty)
                  WHEN raw > 4294967296.0 / 30 THEN -4294967296.0 * ln(1 - raw / 4294967296.0)
                  ELSE raw END, 4) AS estimate FROM z"""


ESTIMATE = estimate(REACHED)
ESTIMATE_BY_LANGUAGE = "SELECT * FROM (" + estimate(
    f"SELECT lang, j, max(r) AS r FROM ({UPDATES}) JOIN (SELECT DISTINCT lang, word FROM ({word_rows('documents', 'lang,')})) USING (word)"
    " GROUP BY lang, j", "lang,", "GROUP BY lang") + ")"
HISTOGRAM = f"""
SELECT b AS bucket, CAST(count(word) AS BIGINT) AS n
FROM range({BUCKETS}) every(b) LEFT JOIN ({HASHED_QUALITY}) ON h & {BUCKETS - 1} = b GROUP BY b"""
QUALITY = f"""
WITH f AS ({HISTOGRAM}), s AS (SELECT CAST(sum(n) AS BIGINT) AS keys, avg(n) AS mean, stddev_pop(n) AS deviation,
                               CAST(sum(n * (n - 1) // 2) AS DOUBLE) AS collisions FROM f)
SELECT keys, round(mean, 6) AS mean, round(deviation, 6) AS deviation, collisions,
       round(collisions / (keys * (keys - 1) / 2), 9) AS probability FROM s"""

SCALED = (
    "SELECT vec_id AS id, 'w' || vec_id AS label,"
    " list_transform(embedding, lambda x: x::DOUBLE * (vec_id % 7 + 1)) AS v FROM embeddings"
)
UNIT = (
    f"SELECT id, label, list_transform(v, lambda x: x / nullif(sqrt(list_dot_product(v, v)), 0)) AS v"
    f" FROM ({SCALED})"
)
PLAIN = "SELECT vec_id AS id, 'w' || vec_id AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
SHIFTED = (
    "SELECT vec_id AS qid, list_transform(embedding, lambda x: x::DOUBLE * 0.9::DOUBLE + 0.01::DOUBLE) AS q FROM embeddings"
)
EXPECTED = (
    "SELECT vec_id AS qid, CASE WHEN vec_id % 3 = 0 THEN 'wrong' ELSE 'w' || vec_id END AS expected FROM embeddings"
)
NEAREST = f"""
SELECT qid, id, label, d FROM (
  SELECT qid, id, label, d, row_number() OVER (PARTITION BY qid ORDER BY d, id) AS rk FROM (
    SELECT qid, id, label, list_distance(v, q) AS d FROM ({SHIFTED}) CROSS JOIN ({PLAIN}))) WHERE rk = 1"""


def list_literal(matrix: np.ndarray) -> str:
    rows = (", ".join(repr(value) for value in row) for row in matrix.tolist())
    return "[" + ", ".join(f"[{row}]" for row in rows) + "]"


PLANES = list_literal(SCHEME.draw_planes(DIMENSIONS))
PICKS = list_literal(SCHEME.draw_picks())
BITS = f"""
SELECT id, label, v, list_transform(planes, lambda p: CASE WHEN list_dot_product(v, p) > 0 THEN 1 ELSE 0 END) AS bits
FROM ({UNIT}), (SELECT CAST({PLANES} AS DOUBLE[][]) AS planes)"""
BUCKET_ROWS = f"""
SELECT CAST(t - 1 AS INTEGER) AS tbl,
       array_to_string(list_transform(picks[t], lambda i: bits[i + 1]), '') AS bucket, id, label, v
FROM ({BITS}), (SELECT {PICKS} AS picks), range(1, {SCHEME.tables + 1}) numbers(t)"""


def lsh_ranking(k: int, with_self: bool) -> str:
    others = "" if with_self else "WHERE a.id <> b.id"
    return f"""
WITH bk AS ({BUCKET_ROWS}),
pairs AS (SELECT DISTINCT a.id AS qid, b.id AS id FROM bk a JOIN bk b ON a.tbl = b.tbl AND a.bucket = b.bucket {others}),
u AS ({UNIT}),
scored AS (SELECT qid, pairs.id, y.label AS neighbour, list_dot_product(y.v, x.v) AS score
           FROM pairs JOIN u x ON x.id = qid JOIN u y ON y.id = pairs.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id DESC) AS rk FROM scored)
SELECT qid, CAST(rk AS INTEGER) AS rank, id, {'' if with_self else 'neighbour,'} round(score, 6) AS score
FROM ranked WHERE rk <= {k}"""


COSINE = f"""
WITH u AS ({UNIT}),
ranked AS (SELECT a.id AS qid, b.id, b.label AS neighbour, list_dot_product(a.v, b.v) AS score,
                  row_number() OVER (PARTITION BY a.id ORDER BY list_dot_product(a.v, b.v) DESC, b.id) AS rk
           FROM u a JOIN u b ON a.id <> b.id)
SELECT qid, CAST(rk AS INTEGER) AS rank, id, neighbour, round(score, 6) AS score FROM ranked WHERE rk <= 3"""

POINTS = """
SELECT qid, id, round(d, 4) AS distance FROM (
  SELECT s_suppkey AS qid, c_custkey AS id, d, row_number() OVER (PARTITION BY s_suppkey ORDER BY d, c_custkey) AS rk
  FROM (SELECT s_suppkey, c_custkey,
               sqrt(pow(c_acctbal::FLOAT::DOUBLE - s_acctbal::FLOAT::DOUBLE, 2)
                    + pow(c_nationkey * 100.0::DOUBLE - s_nationkey * 100.0::DOUBLE, 2)) AS d
        FROM supplier CROSS JOIN customer)) WHERE rk = 1"""


def oracles() -> dict[str, str]:
    """SQL by query name."""
    merged = " UNION ALL ".join(word_rows(name) for name in ("documents", "conversations", "benchmark"))
    beta = f"SELECT station, name, {settled('beta')} AS beta FROM ({SLOPES})"
    nearest_rows = f"SELECT qid, id, round(d, 6) AS distance FROM ({NEAREST})"
    answers = f"({EXPECTED}) e LEFT JOIN ({NEAREST}) f ON e.qid = f.qid"
    verified = (
        "SELECT CAST(count(*) AS BIGINT) AS queries,"
        f" CAST(count(*) FILTER (WHERE label IS DISTINCT FROM expected) AS BIGINT) AS wrong FROM {answers}")
    return {
        "word_count": COUNTS,
        "word_count_per_doc": COUNTS_PER_DOC,
        "word_count_in_doc": COUNTS_PER_DOC,
        "word_count_merge": COUNTS,
        "word_count_merge_tables":
            f"SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({merged}) GROUP BY word",
        "word_checksum": CHECKSUM,
        "word_checksum_direct": CHECKSUM,
        "word_top10": TOP10,
        "stream_word_count": COUNTS,
        "stream_running_counts": COUNTS,
        "stream_text_files": COUNTS,
        "stream_compacted": COUNTS,
        "corpus_report":
            f"SELECT 'checksum' AS part, '' AS word, checksum AS n FROM ({CHECKSUM})"
            f" UNION ALL SELECT 'top', word, n FROM ({TOP10})",
        "stream_top10": TOP10,
        "stream_checksum": CHECKSUM,
        "keyed_sum": TOTALS,
        "keyed_sum_topk": f"{TOTALS} ORDER BY total DESC, name DESC LIMIT 5",
        "keyed_sum_all": TOTALS,
        "out_degree": OUT_DEGREE,
        "follows_summary": degree_summary(OUT_DEGREE),
        "in_degree": IN_DEGREE,
        "followers_summary": degree_summary(IN_DEGREE),
        "julian_day":
            "SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 2440588"
            " AS INTEGER) AS jdn FROM orders",
        "decade":
            "SELECT CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade, CAST(count(*) AS BIGINT) AS n"
            " FROM orders GROUP BY 1",
        "daily_mean":
            f"SELECT decade, CAST(count(avg_t) AS BIGINT) AS known, CAST(count(*) AS BIGINT) AS n,"
            f" round(sum(avg_t), 2) AS total FROM ({DAILY}) GROUP BY decade",
        "group_slope": beta,
        "group_slope_pairwise": f"SELECT station, name, {settled('beta')} AS beta FROM ({SLOPES_PAIRWISE})",
        "slope_top5":
            f"SELECT station, name, {settled('beta')} AS beta FROM"
            f" (SELECT * FROM ({SLOPES}) ORDER BY beta DESC NULLS LAST, station LIMIT 5)",
        "slope_positive_fraction": f"SELECT round({positive_share('beta')}, 6) AS fraction FROM ({SLOPES})",
        "slope_quantiles_exact": f"SELECT {five_numbers('beta')} FROM ({SLOPES})",
        "slope_five_numbers": f"SELECT {five_numbers('beta')} FROM ({SLOPES})",
        "decade_avg": f"SELECT station, name, decade, {settled('decade_avg')} AS decade_avg FROM ({DECADE_AVERAGES})",
        "decade_diff":
            f"SELECT station, name, {settled('early_avg')} AS early_avg, {settled('late_avg')} AS late_avg,"
            f" {settled('diff_c')} AS diff_c FROM ({CHANGES})",
        "decade_diff_top5":
            f"SELECT station, name, {settled('diff_c')} AS diff_c FROM"
            f" (SELECT * FROM ({CHANGES}) ORDER BY diff_c DESC NULLS LAST, station LIMIT 5)",
        "decade_diff_positive_fraction": f"SELECT round({positive_share('diff_c')}, 6) AS fraction FROM ({CHANGES})",
        "decade_diff_five_numbers": f"SELECT {five_numbers('diff_c')} FROM ({CHANGES})",
        "climate_profile":
            f"SELECT station, name, 0 AS decade, {settled('beta')} AS value FROM ({SLOPES}) UNION ALL"
            f" SELECT station, name, decade, {settled('decade_avg')} FROM ({DECADE_AVERAGES})",
        "climate_report":
            f"{report_part('slope', SLOPES, 'beta')} UNION ALL {report_part('difference', CHANGES, 'diff_c')}",
        "climate_report_top":
            f"SELECT 'slope' AS part, station, name, {settled('beta')} AS value FROM"
            f" (SELECT * FROM ({SLOPES}) ORDER BY beta DESC NULLS LAST, station LIMIT 5) UNION ALL"
            f" SELECT 'difference', station, name, {settled('diff_c')} FROM"
            f" (SELECT * FROM ({CHANGES}) ORDER BY diff_c DESC NULLS LAST, station LIMIT 5)",
        "hash_murmur3":
            f"SELECT a.word, a.h, b.h AS h_seeded FROM ({HASHED}) a JOIN ({HASHED_QUALITY}) b ON a.word = b.word",
        "hll_jr": UPDATES,
        "hll_registers": REACHED,
        "hll_estimate": ESTIMATE,
        "hll_by_language": f"{ESTIMATE_BY_LANGUAGE} UNION ALL SELECT 'all', estimate FROM ({ESTIMATE})",
        "hll_against_exact":
            "SELECT CAST(count(DISTINCT word) AS BIGINT) AS exact, true AS ours_near, true AS builtin_near"
            f" FROM ({word_rows('documents')})",
        "hash_bucket_histogram": HISTOGRAM,
        "hash_bucket_stats": QUALITY,
        "vec_normalize":
            f"SELECT id, CAST(i - 1 AS INTEGER) AS pos, round(v[i], 6) AS x"
            f" FROM ({UNIT}), range(1, {DIMENSIONS + 1}) places(i)",
        "vec_pair_distances":
            f"SELECT id, round(list_dot_product(v, q), 6) AS dot, round(list_distance(v, q), 6) AS distance,"
            f" round(list_dot_product(v, v) + list_dot_product(q, q) - 2 * list_dot_product(v, q), 6) AS squared"
            f" FROM ({PLAIN}) JOIN ({SHIFTED}) ON id = qid",
        "vec_cosine_top3": COSINE,
        "vec_nn_l2": nearest_rows,
        "vec_nn_l2_expanded": f"SELECT qid, id, round(d * d, 6) AS squared FROM ({NEAREST})",
        "vec_nn_l2_cells": nearest_rows,
        "vec_nn_verify": verified,
        "answers_from_files": verified,
        "vec_nn_mismatches":
            f"SELECT e.qid, label AS got, expected FROM {answers} WHERE label IS DISTINCT FROM expected",
        "points_nearest": POINTS,
        "hyperplane_bits": f"SELECT id, array_to_string(bits, '') AS bits FROM ({BITS})",
        "lsh_buckets": f"SELECT tbl, bucket, id FROM ({BUCKET_ROWS})",
        "lsh_top3": lsh_ranking(3, False),
        "lsh_top3_cells": lsh_ranking(3, False),
        "lsh_stored_index": lsh_ranking(3, False),
        "lsh_ranking_with_self": lsh_ranking(10, True),
        "scan_text_files": COUNTS,
        "scan_hidden_files": COUNTS,
        "scan_links": f"SELECT CAST(\"user\" AS VARCHAR) AS user, degree FROM ({IN_DEGREE})",
        "scan_adjacency": f"SELECT CAST(\"user\" AS VARCHAR) AS user, degree FROM ({IN_DEGREE})",
        "scan_adjacency_out": f"SELECT CAST(\"user\" AS VARCHAR) AS user, degree FROM ({OUT_DEGREE})",
        "scan_resources": TOTALS,
        "scan_climate":
            f"SELECT CAST(station AS VARCHAR) AS station, name || ', WY US' AS name, decade,"
            f" {settled('decade_avg')} AS decade_avg FROM ({DECADE_AVERAGES})",
        "scan_points":
            "SELECT c_name AS label, round(c_acctbal::FLOAT::DOUBLE, 4) AS easting,"
            " round(c_nationkey * 100.0::DOUBLE, 4) AS northing FROM customer",
        "scan_word_vectors":
            "SELECT row_number() OVER (ORDER BY id) - 1 AS id, label, CAST(len(v) AS INTEGER) AS dims,"
            f" round(list_dot_product(v, v), 5) AS squared FROM ({PLAIN})",
        "scan_query_list":
            f"SELECT row_number() OVER (ORDER BY id DESC) - 1 AS qid, label, id FROM ({PLAIN})",
        "scan_query_matrix": f"SELECT qid, id, round(d, 4) AS distance FROM ({NEAREST})",
        "sink_formats":
            f"SELECT format, name, total FROM ({TOTALS}), (VALUES ('parquet'), ('json'), ('csv')) formats(format)",
    }
