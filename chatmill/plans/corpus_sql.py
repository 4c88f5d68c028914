"""DuckDB SQL of the queries in ``corpus.py``."""

from __future__ import annotations

from ..functions.text import NON_ALNUM_RE
from ..operators.shuffle import MULTIPLIER, PRIME, round_keys
from ..sources.digest import PRIME as PRIME_61
from . import queries as Q
from .oracle import SQL as SQL_OF
from .oracle import CHOICES, CONFIG, DEF, KEY, NUMERIC, RESULTS, RS, SPLIT, TRIPLES, US, extract_num, norm, ntok, valid

SQL: dict[str, str] = {}


def _network(rows: str) -> str:
    """The keyed permutation of ``p`` on the grid ``a`` x ``b``, half-round by half-round."""
    sql = f"SELECT *, p // b AS u, p % b AS v FROM ({rows})"
    for r, key in enumerate(round_keys(Q.SEED)):
        y = f"((v * {MULTIPLIER} + {key}) % {PRIME})"
        sql = f"SELECT * EXCLUDE (u, v), v AS u, (u + ({y} * {y} + {key}) % {PRIME}) % {'b' if r % 2 else 'a'} AS v FROM ({sql})"
    return f"SELECT source, doc_id, copy, n, a, b, u * b + v AS p, steps + 1 AS steps FROM ({sql})"


SQL["shuffled_order"] = f"""
WITH RECURSIVE {TRIPLES}, {CONFIG}, {SPLIT},
g AS (SELECT *, CAST(floor(sqrt(n)) AS BIGINT) + 1 AS a FROM (
        SELECT source, doc_id, copy, row_number() OVER (ORDER BY source, doc_id, copy) - 1 AS p, count(*) OVER () AS n FROM mixed)),
walk AS (
  SELECT source, doc_id, copy, n, a, n // a + 1 AS b, p, 0 AS steps FROM g
  UNION ALL
  {_network("SELECT * FROM walk WHERE steps = 0 OR p >= n")})
SELECT source, doc_id, copy, p AS position, CASE WHEN p < floor(n * 0.95::DOUBLE) THEN 'train' ELSE 'validation' END AS split
FROM walk WHERE steps > 0 AND p < n"""

SQL["json_lines_scan"] = f"""
WITH {TRIPLES}
SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS line, doc_id % 12 NOT IN (7, 8) AS json_ok,
       CASE WHEN doc_id % 12 NOT IN (7, 8, 10) THEN md5(q0) END AS question_md5
FROM d0"""

_LANGUAGE = "list_extract(['python', 'None', 'True', '3', 'sql', 'False', '2.5'], CAST(m AS INTEGER) + 1)"
_HEAD = f"'system{RS}' || "
_USER, _ASSISTANT = (f" || '{US}{r}{RS}' || " for r in ("user", "assistant"))

SQL["clean_mixed"] = f"""
WITH {TRIPLES},
b AS (SELECT doc_id, doc_id % 6 AS k, doc_id % 7 AS m, s, q, r, s_ok, {valid('q')} AS q_ok, {valid('r')} AS r_ok FROM tv),
c AS (SELECT doc_id, list_extract(['chats', 'lists', 'triples', 'code', 'pairs', 'logs'], CAST(k AS INTEGER) + 1) AS source,
             CASE WHEN k = 0 AND m <> 0 AND q_ok AND r_ok THEN {_HEAD}{DEF}{_USER}q{_ASSISTANT}r
                  WHEN k = 1 AND r_ok THEN {_HEAD}{DEF} || CASE WHEN q_ok THEN ''{_USER}q ELSE '' END{_ASSISTANT}r{_ASSISTANT}r
                  WHEN k = 2 AND q_ok AND r_ok THEN {_HEAD}CASE WHEN s_ok AND m <> 1 THEN s ELSE {DEF} END{_USER}q{_ASSISTANT}r
                  WHEN k = 3 AND q_ok AND r_ok AND length(r) >= 30 AND length(q) >= 15 THEN
                       {_HEAD}{DEF}{_USER}'Write a ' || {_LANGUAGE} || ' function that does the following:' || chr(10) || chr(10) || q
                       {_ASSISTANT}'```' || {_LANGUAGE} || chr(10) || r || chr(10) || '```'
                  WHEN k = 4 AND m <> 2 AND q_ok AND r_ok THEN {_HEAD}{DEF}{_USER}q{_ASSISTANT}r END AS body,
             k, q_ok FROM b)
SELECT doc_id, source, CASE WHEN k = 5 THEN 'skipped' WHEN body IS NULL THEN 'conversion_failed' ELSE 'converted' END AS status,
       CASE WHEN body IS NOT NULL THEN CAST(CASE WHEN k = 1 THEN 3 + CAST(q_ok AS INTEGER) ELSE 3 END AS BIGINT) END AS n_messages, md5(body) AS fingerprint
FROM c"""

SQL["length_quantiles"] = f"""
WITH {TRIPLES}, {CONFIG}, {SPLIT},
t AS (SELECT doc_id, {ntok("CASE WHEN s_ok THEN s ELSE " + DEF + " END")} + {ntok('q')} + {ntok('r')} + 15 AS n_tokens FROM tv WHERE ok)
SELECT split, count(*) AS examples, CAST(sum(n_tokens) AS BIGINT) AS total_tokens, max(n_tokens) AS longest,
       count(*) FILTER (WHERE n_tokens > {Q.MAX_LEN}) AS examples_cut, round(quantile_cont(n_tokens, 0.5), 6) AS median, round(quantile_cont(n_tokens, 0.95), 6) AS p95
FROM splitted JOIN t USING (doc_id) GROUP BY split"""

SQL["capped_scan"] = """
SELECT doc_id, source, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn,
         CASE source WHEN 'src0' THEN NULL WHEN 'src1' THEN 25 WHEN 'src2' THEN 1001 WHEN 'src3' THEN 500000 ELSE 7 END AS cap FROM documents)
WHERE cap IS NULL OR rn <= cap"""

_P = f"{PRIME_61}::HUGEINT"

SQL["dataset_digest"] = f"""
WITH l AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i,
                  CAST('0x' || substr(md5('line:' || doc_id || ' ' || translate(coalesce(text, ''), chr(10) || chr(13), '  ')), 1, 15) AS BIGINT)::HUGEINT AS d
           FROM documents)
SELECT source, count(*) AS n_lines,
       concat_ws('-', count(*), CAST(sum(d % {_P}) AS HUGEINT) % {_P}, CAST(sum(i * d % {_P}) AS HUGEINT) % {_P}) AS digest
FROM l GROUP BY source"""

SQL["sql_quality_filter"] = f"""
WITH n AS (SELECT doc_id, {norm('text')} AS t FROM documents)
SELECT doc_id, length(t) AS norm_length, length(regexp_replace(t, '{NON_ALNUM_RE}', '', 'g')) AS alnum_chars,
       sha256('user:' || length(t) || ':' || t) AS content_key FROM n WHERE {valid('t')}"""

SQL["sql_answers"] = f"""
WITH {CHOICES}, {NUMERIC}
SELECT 'choice' AS kind, item_id, CAST(pidx AS DOUBLE) AS answer FROM chgraded
UNION ALL SELECT 'gold', item_id, ground_truth FROM numgraded
UNION ALL SELECT 'number', item_id, {extract_num('response')} FROM pred"""

SQL["load_manifest"] = f"""
WITH {TRIPLES}
SELECT source, count(*) AS loaded, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid FROM tv GROUP BY source"""

SQL["request_stream"] = """
WITH r AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id % 2 = 0 AS chat FROM events),
v AS (SELECT event_id, CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL WHEN chat THEN 'chat' ELSE 'completion' END AS shape, coalesce(
        CASE WHEN event_id % 101 = 0 THEN 'not JSON' WHEN event_id % 103 = 0 THEN 'neither messages nor prompt' END,
        CASE WHEN event_type = 'signup' AND chat THEN 'messages empty' WHEN event_type = 'signup' THEN 'prompt is no text' END,
        CASE WHEN NOT value / 100 BETWEEN 0.0 AND 2.0 THEN 'temperature out of range [0.0, 2.0]' END,
        CASE WHEN NOT user_id * 30 BETWEEN 1 AND 4096 THEN 'max_tokens out of range [1, 4096]' END,
        CASE WHEN event_type <> 'error' AND NOT k / 100.0::DOUBLE BETWEEN 0.0 AND 1.0 THEN 'top_p out of range [0.0, 1.0]' END,
        CASE WHEN chat AND NOT 1.0::DOUBLE + k / 50.0::DOUBLE BETWEEN 1.0 AND 2.0 THEN 'repetition_penalty out of range [1.0, 2.0]' END) AS reason FROM r)
SELECT event_id, shape, reason IS NULL AS accepted, reason FROM v"""

SQL["stream_first_copies"] = f"""
WITH {TRIPLES}
SELECT source, {KEY} AS content_key, min(doc_id) AS doc_id FROM tv WHERE ok GROUP BY ALL"""

_CHECKS = f"""
v AS ({SQL_OF['file_verdicts']}),
e AS (SELECT *, line_count + CASE WHEN name = 'src3' THEN 1 ELSE 0 END AS n FROM v),
checks AS (
  SELECT name, 'File exists' AS check, TRUE AS passed, 'found' AS detail FROM e
  UNION ALL SELECT 'not downloaded', 'File exists', FALSE, 'absent'
  UNION ALL SELECT name, 'Non-zero size', line_count > 0, line_count || ' lines' FROM e
  UNION ALL SELECT name, 'JSONL parseable', parse_ok, CASE WHEN parse_ok THEN 'every line' ELSE 'not line ' || first_bad_line END FROM e
  UNION ALL SELECT name, 'Expected fields', CASE WHEN name <> 'src4' THEN fields_ok END,
                   CASE WHEN name = 'src4' THEN 'no contract' WHEN fields_ok THEN 'every line' ELSE 'no ' || missing_field || ' on line ' || fields_line END FROM e
  UNION ALL SELECT name, 'Line count', line_count = n, line_count || ' of ' || n FROM e)"""

SQL["check_table"] = f"WITH {_CHECKS} SELECT name, \"check\", passed, detail FROM checks"

SQL["check_summary"] = f"""
WITH {_CHECKS}
SELECT name, count(*) FILTER (WHERE passed) AS checks_passed, count(*) AS checks_total, bool_and(coalesce(passed, TRUE)) AS passed FROM checks GROUP BY name"""

SQL["download_summary"] = """
WITH m AS (SELECT source, CASE CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 5 WHEN 1 THEN 'skipped' WHEN 2 THEN 'failed' ELSE 'success' END AS status,
                  count(*) AS n, sum(strlen(text)) AS bytes FROM documents GROUP BY ALL)
SELECT count(*) AS total_datasets, count(*) FILTER (WHERE status <> 'failed') AS successful, count(*) FILTER (WHERE status = 'failed') AS failed,
       CAST(sum(n) AS BIGINT) AS total_examples, CAST(sum(bytes) AS BIGINT) AS total_size_bytes FROM m"""

SQL["combined_report"] = f"""
WITH {RESULTS},
l AS (SELECT count(*) FILTER (WHERE toxic = 0) AS correct, count(*) AS total FROM labels)
SELECT benchmark, metric, score, correct, total, 'Mmlu Score' AS title FROM scored WHERE benchmark = 'mmlu'
UNION ALL
SELECT 'humaneval', 'pass@1', round(CAST(correct AS DOUBLE) * 100 / total, 2), correct, total, 'Humaneval Score' FROM l"""

_LINE = "'| ' || {0} || ' | ' || {1} || ' | ' || {2} || '% | ' || CASE WHEN {3} IS NULL THEN '—' ELSE {3} || '%' END || ' | ' || CASE WHEN {4} IS NULL THEN '—' WHEN {4} >= 0 THEN printf('+%.1f%%', {4}) ELSE printf('%.1f%%', {4}) END || ' |'"

SQL["report_rows"] = f"""
WITH {RESULTS},
j AS (SELECT benchmark, metric, score, nullif(baseline, 0) AS baseline, round(score - nullif(baseline, 0), 1) AS delta FROM scored LEFT JOIN baselines USING (benchmark)),
a AS (SELECT count(*) AS n, coalesce(round(avg(score), 2), 0.0) AS score FROM scored),
b AS (SELECT avg(baseline) AS baseline FROM baselines),
r AS (SELECT *, row_number() OVER (ORDER BY accuracy DESC, first_seen) AS p, count(*) OVER () AS n FROM subj),
s AS (SELECT 'top' AS section, p AS position, subject, accuracy FROM r WHERE p <= 10
      UNION ALL SELECT 'bottom', p - (n - 10), subject, accuracy FROM r WHERE n > 10 AND p > n - 10)
SELECT 'results' AS section, CAST(2 + row_number() OVER (ORDER BY benchmark) AS BIGINT) AS position, {_LINE.format('benchmark', 'metric', 'score', 'baseline', 'delta')} AS line FROM j
UNION ALL SELECT 'results', n + 3, {_LINE.format("'**Average**'", "'mean'", 'score', 'baseline', 'round(score - baseline, 1)')} FROM a, b
UNION ALL SELECT section, position + 2, '| ' || subject || ' | ' || printf('%.1f%%', accuracy) || ' |' FROM s
UNION ALL VALUES ('results', 1, '| Benchmark | Metric | Score | Baseline | Delta |'), ('results', 2, '|---|---|---|---|---|'), ('top', 1, '| Subject | Accuracy |'),
                 ('top', 2, '|---|---|'), ('bottom', 1, '| Subject | Accuracy |'), ('bottom', 2, '|---|---|')"""

SQL["test_programs"] = f"""
WITH {TRIPLES},
p AS (SELECT doc_id, q0 || r0 || chr(10) || chr(10) || lang || chr(10) || chr(10) || 'check(' || source || ')' || chr(10) AS program FROM d0)
SELECT doc_id, length(program) AS program_length, md5(program) AS program_md5 FROM p"""

SQL["truncated_prompts"] = f"""
WITH t AS (SELECT doc_id, {ntok("coalesce(text, '')")} AS n FROM documents)
SELECT doc_id, n > 300 AS was_truncated, least(n, 300) AS n_ids, least(n, 300) AS attended FROM t"""
