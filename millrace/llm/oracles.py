"""SQL with the same result for the queries that SQL can express."""

from __future__ import annotations

QUALITY_RULES = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS pos, words FROM parts WHERE len(words) >= 5),
starts AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words[pos:pos + 4]) AS n FROM windows),
gaps AS (
  SELECT doc_id, least(5, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, 5)) AS gap
  FROM starts WHERE n >= 2),
repeats AS (SELECT doc_id, sum(gap)::BIGINT AS n_repeat_words FROM gaps GROUP BY doc_id),
counted AS (
  SELECT doc_id, t, words, lines, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 2 * n_dup_lines > n_lines
         OR 2 * length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) > word_chars
         OR 2 * length(regexp_replace(t, '[^\p{L}]', '', 'g')) < word_chars
         OR 3 * len(list_filter(words, lambda x: regexp_matches(x, '(!|\.\.\.|…)$'))) > n_words
         OR 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[•‣*-][\x20\x09]'))) > 9 * n_lines
         OR (n_words >= 100 AND 20 * len(list_distinct(words)) < n_words) AS rejected
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged
"""

SUBSTRING_DEDUP = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM texts WHERE len(words) >= 13),
firsts AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY words[pos:pos + 12]) AS least FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM firsts WHERE least < doc_id),
spans AS (
  SELECT doc_id, count(*)::BIGINT AS n_removed, count(*) FILTER (WHERE fresh)::BIGINT AS n_spans
  FROM (SELECT doc_id, pos, coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 1, true) AS fresh FROM gone)
  GROUP BY doc_id),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
  FROM places ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# The length of a formatted turn: its tags, its text, and a backslash for each control string or backslash.
CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '</?s>')) + len(regexp_extract_all(text, '\\'))
            + len(regexp_extract_all(text, '\[/?(INST|SYS|OUT|TURN)[\] ]'))
            + CASE role WHEN 'user' THEN 18 WHEN 'system' THEN 16 WHEN 'assistant' THEN 20 ELSE 19 + length(role) END AS chars
  FROM turns),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sum(chars)::BIGINT AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
       sha256(learnt) AS loss_sha256, formatted_chars, false AS rewrites
FROM whole
"""

# CRC-32 of the decimal digits, bit by bit: a byte is added, then eight steps (marked 256) follow.
CHECKSUM = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split({id}::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, list_transform(range(8), lambda k: 256::BIGINT))))),
    lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""

PERIODIC_RUNS = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, """ + CHECKSUM.format(id="doc_id") + r""" AS h
  FROM documents),
planned AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts),
repeated AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
    lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) END AS words
  FROM planned),
places AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(words) AS word FROM repeated),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM places x JOIN places y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc_id, p, min(i) AS start, count(*) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs) GROUP BY doc_id, p, island),
runs AS (
  SELECT doc_id, start, length, min(p) AS period FROM islands WHERE length >= greatest(6, 4 * p) GROUP BY doc_id, start, length),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS place FROM runs),
listed AS (
  SELECT doc_id, count(*)::BIGINT AS n_runs, max(start) FILTER (WHERE place = 1) AS start, max(length) FILTER (WHERE place = 1) AS length,
         max(period) FILTER (WHERE place = 1) AS period,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM ranked GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations),
original AS (SELECT conv_id, list(said ORDER BY place) AS seq FROM turns GROUP BY conv_id),
wanted AS (
  SELECT conv_id, seq, """ + CHECKSUM.format(id="conv_id") + r""" % 9 AS h, conv_id - ((conv_id % 5) + 5) % 5 AS first FROM original),
rebuilt AS (
  SELECT w.conv_id, list_concat(coalesce(o.seq[1:h], []), w.seq[h + 1:]) AS seq
  FROM wanted w LEFT JOIN original o ON o.conv_id = w.first),
prefixes AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT seq[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '') AS ends
  FROM prefixes GROUP BY ALL),
families AS (
  SELECT n.path, n.depth, n.conv_id, n.n_convs, n.ends, count(c.path) AS n_children,
         (n.n_convs - 1) * coalesce(strlen(n.path[-1].text), 0) AS saved
  FROM nodes n LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path GROUP BY ALL),
above AS (SELECT path[1:k] AS path, saved, n_children FROM (SELECT *, unnest(range(depth + 1)) AS k FROM families)),
sums AS (
  SELECT path, sum(saved)::BIGINT AS saved_tokens, (count(*) FILTER (WHERE n_children = 0))::BIGINT AS n_leaves FROM above GROUP BY path)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, sha256(f.ends) AS ends_sha256
FROM families f JOIN sums s ON s.path = f.path LEFT JOIN nodes p ON f.depth > 0 AND p.path = f.path[1:f.depth - 1]
"""

ORACLES = {
    "op2_quality_rules": QUALITY_RULES,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op9_chat_format": CHAT_FORMAT,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_prefix_trie": PREFIX_TRIE,
}
