"""DuckDB SQL equivalents of the registered queries (the correctness gate).

The SQL is written row-wise (window functions and aggregates over turns)
where the Spark side uses array functions, so the two are independent
derivations of the same semantics.  Regex patterns and fixed strings come
from the same constants as the Spark code; the patterns are valid in both
Java regex and RE2.
"""

from __future__ import annotations

from ..functions import answers as A
from ..functions.chat import IM_END, IM_START
from ..functions.text import CONTROL_CHARS_RE, NON_ALNUM_RE, STRIP_RE, UNICODE_SPACE_CLASS
from ..operators.convert import DEFAULT_SYSTEM
from ..operators.tokens import TOKEN_RE
from . import queries as Q

RS = "␞"  # role/content separator of the fingerprint
US = "␟"  # message separator of the fingerprint


def lit(s: str) -> str:
    """SQL string literal; newlines become chr(10)."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted)


def norm(e: str) -> str:
    x = f"nfc_normalize(coalesce({e}, ''))"
    x = f"regexp_replace({x}, '{CONTROL_CHARS_RE}', '', 'g')"
    x = f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({x}, '{STRIP_RE}', '', 'g')"


def valid(e: str) -> str:
    return (f"(length({e}) BETWEEN 5 AND 32768 AND "
            f"length(regexp_replace({e}, '{NON_ALNUM_RE}', '', 'g')) * 10 >= length({e}))")


def strip(e: str) -> str:
    return f"regexp_replace({e}, '{STRIP_RE}', '', 'g')"


def ntok(e: str) -> str:
    return f"len(regexp_extract_all({e}, '{TOKEN_RE}', 0))"


DEF = lit(DEFAULT_SYSTEM)


def fp3(system: str, user: str, assistant: str) -> str:
    return (f"md5('system{RS}' || {system} || '{US}user{RS}' || {user} || '{US}assistant{RS}' || {assistant})")


# --- shared CTEs --------------------------------------------------------------

TRIPLES = f"""
d0 AS (SELECT doc_id, source, lang, text, source AS sp,
              split_part(text, chr(10), 1) AS q0,
              CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS r0
       FROM documents),
tn AS (SELECT doc_id, source, {norm('sp')} AS s, {norm('q0')} AS q, {norm('r0')} AS r FROM d0),
tv AS (SELECT *, {valid('q')} AND {valid('r')} AS ok, {valid('s')} AS s_ok FROM tn)"""

ALTERNATING = f"""
a0 AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, text FROM conversations),
an AS (SELECT conv_id, count(*) AS n_raw FROM conversations GROUP BY conv_id),
av AS (SELECT conv_id, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS r, {norm('text')} AS c FROM a0),
ak AS (SELECT * FROM av WHERE {valid('c')}),
ag AS (SELECT conv_id, count(*) AS nk, bool_or(r = 'user') AS has_user, bool_or(r = 'assistant') AS has_asst,
              string_agg(r, ',' ORDER BY i) AS roles, string_agg(r || '{RS}' || c, '{US}' ORDER BY i) AS body
       FROM ak GROUP BY conv_id),
alt AS (SELECT ag.* FROM ag JOIN an USING (conv_id) WHERE n_raw >= 2 AND nk + 1 >= 3)"""

CONFIG = """
cfg AS (SELECT DISTINCT source,
          CASE WHEN source = 'src0' THEN NULL WHEN source = 'src1' THEN 0 WHEN source = 'src2' THEN 1000 ELSE 40 END AS cap,
          CASE WHEN source = 'src3' THEN 2.5::DOUBLE WHEN source = 'src4' THEN 0.5::DOUBLE
               WHEN source = 'src5' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
        FROM documents),
cr AS (SELECT d.doc_id, d.source, cfg.cap, cfg.weight,
              row_number() OVER (PARTITION BY d.source ORDER BY md5('42:' || CAST(d.doc_id AS VARCHAR)), d.doc_id) AS rn
       FROM documents d JOIN cfg USING (source)),
capped AS (SELECT doc_id, source, weight FROM cr WHERE cap IS NULL OR cap <= 0 OR rn <= cap),
whole AS (SELECT source, doc_id,
                 unnest(range(0, CAST(CASE WHEN weight > 1 THEN floor(weight) ELSE 1 END AS BIGINT))) AS copy
          FROM capped),
ex AS (SELECT source, doc_id, weight, count(*) OVER (PARTITION BY source) AS n,
              row_number() OVER (PARTITION BY source ORDER BY md5('43:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
       FROM capped WHERE weight > 1 AND weight - floor(weight) > 0),
extra AS (SELECT source, doc_id, CAST(floor(weight) AS BIGINT) AS copy FROM ex
          WHERE rn <= floor(n * (weight - floor(weight)))),
sampled AS (SELECT source, doc_id, copy FROM whole UNION ALL SELECT source, doc_id, copy FROM extra)"""

SPLIT = f"""
mixed AS (SELECT s.source, s.doc_id, s.copy FROM sampled s JOIN tv USING (doc_id) WHERE tv.ok),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || source || ':' || CAST(doc_id AS VARCHAR) || ':'
                                                    || CAST(copy AS VARCHAR)), source, doc_id, copy) AS rn,
                 count(*) OVER () AS n FROM mixed),
splitted AS (SELECT source, doc_id, copy,
                    CASE WHEN rn <= floor(n * 0.95::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM ranked)"""


def extract_num(e: str) -> str:
    h = f"regexp_extract({e}, '{A.HASH_ANSWER_RE}', 1)"
    runs = f"regexp_extract_all({e}, '{A.ANY_NUMBER_RE}', 0)"
    return (f"CASE WHEN {e} IS NULL OR {e} = '' THEN NULL ELSE coalesce("
            f"CASE WHEN {h} <> '' THEN TRY_CAST(replace({h}, ',', '') AS DOUBLE) END, "
            f"CASE WHEN len({runs}) > 0 THEN TRY_CAST(replace({runs}[-1], ',', '') AS DOUBLE) END) END")


def extract_choice(e: str) -> str:
    up = f"upper({strip(e)})"
    first = f"substr({up}, 1, 1)"
    found = f"regexp_extract({up}, '{A.STANDALONE_CHOICE_RE}', 1)"
    return (f"CASE WHEN {e} IS NULL OR {e} = '' THEN NULL ELSE CAST(coalesce("
            f"CASE WHEN {first} IN ('A', 'B', 'C', 'D') THEN strpos('ABCD', {first}) - 1 END, "
            f"CASE WHEN {found} <> '' THEN strpos('ABCD', {found}) - 1 END) AS INTEGER) END")


NUMERIC = f"""
per AS (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS qty,
               CAST(sum(CASE WHEN l_linenumber <= 6 THEN l_quantity END) AS BIGINT) AS qty6
        FROM lineitem GROUP BY l_orderkey),
gold AS (SELECT o.o_orderkey AS item_id, '#### ' || format('{{:,}}', per.qty) AS answer
         FROM orders o JOIN per ON o.o_orderkey = per.l_orderkey),
pred AS (SELECT l_orderkey AS item_id, 'Summing ' || CAST(n_lines AS VARCHAR) || ' lines gives '
                || CAST(qty6 AS VARCHAR) || '.' AS response FROM per WHERE qty6 IS NOT NULL),
ng AS (SELECT gold.item_id, answer, response FROM gold LEFT JOIN pred USING (item_id)),
nx AS (SELECT item_id, {extract_num('answer')} AS ground_truth, {extract_num('response')} AS predicted FROM ng),
numgraded AS (SELECT item_id, ground_truth, predicted,
                     coalesce(predicted IS NOT NULL AND ground_truth IS NOT NULL
                              AND abs(predicted - ground_truth) < 1e-6, FALSE) AS correct FROM nx)"""

CHOICES = f"""
ce AS (SELECT event_id AS item_id, event_type, CAST(event_id % 4 AS INTEGER) AS answer,
              event_type || '-' || CAST(CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 10) AS BIGINT) AS VARCHAR) AS subject,
              substr('ABCD', CAST((event_id + user_id) % 4 + 1 AS INTEGER), 1) AS letter,
              user_id % 5 AS style FROM events),
cp AS (SELECT *, CASE style WHEN 0 THEN letter WHEN 1 THEN 'Answer: ' || letter WHEN 2 THEN 'The (' || letter || ')'
                 WHEN 3 THEN 'zzz' ELSE lower(letter) || ' is right' END AS response FROM ce),
chgraded AS (SELECT *, coalesce(pidx = answer, FALSE) AS correct
             FROM (SELECT *, {extract_choice('response')} AS pidx FROM cp)),
subj AS (SELECT subject, count(*) FILTER (WHERE correct) AS correct, count(*) AS total, min(item_id) AS first_seen,
                round(CAST(count(*) FILTER (WHERE correct) AS DOUBLE) * 100 / count(*), 1) AS accuracy
         FROM chgraded GROUP BY subject)"""

RESULTS = f"""
{NUMERIC},
{CHOICES},
results AS (
  SELECT 'humaneval' AS benchmark, 'pass@1' AS metric, count(*) FILTER (WHERE quality = 1) AS correct, count(*) AS total
  FROM labels
  UNION ALL SELECT 'gsm8k', 'accuracy', count(*) FILTER (WHERE correct), count(*) FROM numgraded
  UNION ALL SELECT 'mmlu', 'accuracy', count(*) FILTER (WHERE correct), count(*) FROM chgraded),
scored AS (SELECT benchmark, metric, round(CAST(correct AS DOUBLE) * 100 / total, 2) AS score, correct, total FROM results),
baselines(benchmark, baseline) AS (VALUES ('humaneval', 79.9::DOUBLE), ('gsm8k', 82.6::DOUBLE), ('mmlu', 74.2::DOUBLE))"""


SQL: dict[str, str] = {}

SQL["normalize_text"] = f"""
SELECT doc_id, length(t) AS norm_length, md5(t) AS norm_md5
FROM (SELECT doc_id, {norm('text')} AS t FROM documents)"""

SQL["quality_filter"] = f"""
SELECT doc_id, length(t) AS norm_length, length(regexp_replace(t, '{NON_ALNUM_RE}', '', 'g')) AS alnum_chars
FROM (SELECT doc_id, {norm('text')} AS t FROM documents) WHERE {valid('t')}"""

SQL["convert_turns"] = f"""
WITH t AS (SELECT conv_id, turn, role AS r, {norm('text')} AS c FROM conversations
           WHERE role IN ('system', 'user', 'assistant')),
v AS (SELECT * FROM t WHERE {valid('c')}),
g AS (SELECT conv_id, bool_or(r = 'user') AND bool_or(r = 'assistant') AS ok, bool_or(r = 'system') AS has_sys,
             count(*) AS n, string_agg(r, ',' ORDER BY turn) AS roles,
             string_agg(r || '{RS}' || c, '{US}' ORDER BY turn) AS body
      FROM v GROUP BY conv_id)
SELECT conv_id, CASE WHEN has_sys THEN n ELSE n + 1 END AS n_messages,
       CASE WHEN has_sys THEN roles ELSE 'system,' || roles END AS roles,
       has_sys AS has_system_turn,
       md5(CASE WHEN has_sys THEN body ELSE 'system{RS}' || {DEF} || '{US}' || body END) AS fingerprint
FROM g WHERE ok"""

SQL["convert_alternating"] = f"""
WITH {ALTERNATING}
SELECT conv_id, nk + 1 AS n_messages, 'system,' || roles AS roles,
       md5('system{RS}' || {DEF} || '{US}' || body) AS fingerprint
FROM alt"""

SQL["convert_triples"] = f"""
WITH {TRIPLES}
SELECT doc_id, NOT s_ok AS system_is_default,
       {fp3(f"CASE WHEN s_ok THEN s ELSE {DEF} END", 'q', 'r')} AS fingerprint
FROM tv WHERE ok"""

SQL["convert_code_pairs"] = f"""
WITH p AS (SELECT page_id, {norm('html')} AS c,
                  {norm("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS d FROM pages),
k AS (SELECT page_id, {lit('Write a html function that does the following:' + chr(10) + chr(10))} || d AS u,
             '```html' || chr(10) || c || chr(10) || '```' AS a
      FROM p WHERE {valid('c')} AND {valid('d')} AND length(c) >= 30 AND length(d) >= 15)
SELECT page_id, length(u) AS user_length, length(a) AS assistant_length, {fp3(DEF, 'u', 'a')} AS fingerprint
FROM k"""

SQL["convert_qa"] = f"""
WITH o AS (SELECT o_orderkey,
                  {norm("'Order ' || CAST(o_orderkey AS VARCHAR) || ' was placed by customer ' || CAST(o_custkey AS VARCHAR) || '. What is its status and priority?'")} AS q,
                  {norm("'Status ' || o_orderstatus || ', priority ' || o_orderpriority || '.'")} AS a
           FROM orders)
SELECT o_orderkey, {fp3(DEF, 'q', 'a')} AS fingerprint FROM o WHERE {valid('q')} AND {valid('a')}"""

KEY = "sha256('user:' || length(q) || ':' || q || '|assistant:' || length(r) || ':' || r)"

SQL["dedup_first"] = f"""
WITH {TRIPLES},
k AS (SELECT doc_id, source, {KEY} AS content_key FROM tv WHERE ok)
SELECT doc_id, source, content_key
FROM (SELECT *, row_number() OVER (PARTITION BY source, content_key ORDER BY doc_id) AS rn FROM k) WHERE rn = 1"""

SQL["clean_outcomes"] = f"""
WITH {TRIPLES},
l AS (SELECT tv.*, strpos(d0.text, chr(10)) > 0 AS has_fields,
             CASE WHEN strpos(d0.text, chr(10)) > 0 THEN TRUE ELSE coalesce(json_valid(d0.text), FALSE) END AS parsed_ok
      FROM tv JOIN d0 USING (doc_id)),
c AS (SELECT *, parsed_ok AND has_fields AND ok AS converted FROM l),
k AS (SELECT *, CASE WHEN converted THEN {KEY} END AS ck FROM c),
f AS (SELECT *, row_number() OVER (PARTITION BY source, converted, ck ORDER BY doc_id) AS rn FROM k),
o AS (SELECT source, CASE WHEN NOT parsed_ok THEN 'parse_error' WHEN NOT converted THEN 'conversion_failed'
                          WHEN rn > 1 THEN 'duplicate' ELSE 'kept' END AS outcome FROM f),
cnt AS (SELECT source, count(*) AS input, count(*) FILTER (WHERE outcome = 'kept') AS output,
               count(*) FILTER (WHERE outcome = 'parse_error') AS parse_error,
               count(*) FILTER (WHERE outcome = 'conversion_failed') AS conversion_failed,
               count(*) FILTER (WHERE outcome = 'duplicate') AS duplicate
        FROM o GROUP BY source)
SELECT CASE WHEN grouping(source) = 1 THEN 'Total' ELSE source END AS source,
       CAST(sum(input) AS BIGINT) AS input, CAST(sum(output) AS BIGINT) AS output,
       CAST(sum(input - output) AS BIGINT) AS dropped,
       CAST(sum(parse_error) AS BIGINT) AS parse_error, CAST(sum(conversion_failed) AS BIGINT) AS conversion_failed,
       CAST(sum(duplicate) AS BIGINT) AS duplicate,
       CASE WHEN sum(input) > 0 THEN CAST(sum(output) AS DOUBLE) * 100 / CAST(sum(input) AS BIGINT) END AS retention_pct
FROM cnt GROUP BY ROLLUP (source)"""

SQL["clean_rows"] = f"""
WITH {TRIPLES},
l AS (SELECT tv.*, strpos(d0.text, chr(10)) > 0 AS has_fields,
             CASE WHEN strpos(d0.text, chr(10)) > 0 THEN TRUE ELSE coalesce(json_valid(d0.text), FALSE) END AS parsed_ok
      FROM tv JOIN d0 USING (doc_id)),
c AS (SELECT *, parsed_ok AND has_fields AND ok AS converted FROM l),
k AS (SELECT *, CASE WHEN converted THEN {KEY} END AS content_key FROM c),
f AS (SELECT *, row_number() OVER (PARTITION BY source, converted, content_key ORDER BY doc_id) AS rn FROM k)
SELECT doc_id, source, CASE WHEN NOT parsed_ok THEN 'parse_error' WHEN NOT converted THEN 'conversion_failed'
                            WHEN rn > 1 THEN 'duplicate' ELSE 'kept' END AS outcome, content_key
FROM f"""

SQL["validate_examples"] = f"""
WITH {ALTERNATING}
SELECT conv_id, nk + 1 AS n_messages, (nk + 1 >= 2 AND has_user AND has_asst) AS valid_example FROM alt"""

SQL["cap_per_source"] = f"""
WITH {CONFIG}
SELECT source, doc_id FROM capped"""

SQL["oversample"] = f"""
WITH {CONFIG}
SELECT source, doc_id, copy FROM sampled"""

SQL["mix_split"] = f"""
WITH {TRIPLES}, {CONFIG}, {SPLIT}
SELECT source, doc_id, copy, split FROM splitted"""

SQL["source_distribution"] = f"""
WITH {TRIPLES}, {CONFIG}, {SPLIT},
c AS (SELECT source, count(*) AS n FROM splitted WHERE split = 'train' GROUP BY source),
ru AS (SELECT CASE WHEN grouping(source) = 1 THEN 'Total' ELSE source END AS source,
              CAST(sum(n) AS BIGINT) AS count, grouping(source) AS g FROM c GROUP BY ROLLUP (source))
SELECT source, count, CAST(count AS DOUBLE) * 100 / max(CASE WHEN g = 1 THEN count END) OVER () AS percent FROM ru"""

SQL["split_leakage"] = f"""
WITH {TRIPLES}, {CONFIG}, {SPLIT}
SELECT source, doc_id, count(DISTINCT split) AS n_splits, count(*) AS copies
FROM splitted GROUP BY source, doc_id HAVING count(DISTINCT split) > 1"""

SQL["render_chat"] = f"""
SELECT conv_id, length(chat) AS chat_length, md5(chat) AS chat_md5
FROM (SELECT conv_id, string_agg('{IM_START}' || role || chr(10) || text || '{IM_END}' || chr(10), '' ORDER BY turn) AS chat
      FROM conversations GROUP BY conv_id)"""

L = Q.MAX_LEN

SQL["token_stats"] = f"""
WITH {TRIPLES},
m AS (SELECT doc_id, {ntok("CASE WHEN s_ok THEN s ELSE " + DEF + " END")} AS cs, {ntok('q')} AS cq, {ntok('r')} AS cr
      FROM tv WHERE ok),
per AS (SELECT cs + cq + cr + 15 AS uncut, least(cs + cq + cr + 15, {L}) AS len,
               greatest(0, least(cs + cq + 10 + cr + 4, {L}) - (cs + cq + 10 + 3)) AS lab FROM m)
SELECT count(*) AS total_examples, round(avg(len), 1) AS avg_length, round(median(len), 1) AS median_length,
       min(len) AS min_length, max(len) AS max_length, round(coalesce(stddev_samp(len), 0), 1) AS stdev_length,
       round(avg(lab), 1) AS avg_labeled_tokens, CAST(sum(len) AS BIGINT) AS total_tokens,
       CAST(sum(lab) AS BIGINT) AS total_labeled_tokens,
       round(avg(CASE WHEN len >= {L} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1) AS pct_at_max_length,
       CAST(sum(uncut) AS BIGINT) AS total_tokens_uncut, max(uncut) AS max_length_uncut,
       count(*) FILTER (WHERE uncut > {L}) AS examples_cut
FROM per"""

CONV_TOKENS = f"""
m AS (SELECT conv_id, turn, role, {ntok('text')} AS c, {ntok("role || chr(10)")} AS h FROM conversations),
o AS (SELECT *, c + h + 3 AS mlen,
             coalesce(sum(c + h + 3) OVER (PARTITION BY conv_id ORDER BY turn
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM m),
g AS (SELECT conv_id, CAST(least(sum(mlen), {L}) AS BIGINT) AS total_tokens,
             CAST(sum(CASE WHEN role = 'assistant' THEN greatest(0, least(s + 1 + h + c + 1, {L}) - (s + 1 + h)) ELSE 0 END)
                  AS BIGINT) AS labeled_tokens
      FROM o GROUP BY conv_id)"""

SQL["label_coverage"] = f"""
WITH {CONV_TOKENS}
SELECT conv_id, total_tokens, labeled_tokens, total_tokens - labeled_tokens AS masked_tokens,
       CAST(labeled_tokens AS DOUBLE) * 100 / total_tokens AS labeled_pct FROM g"""

SQL["pad_batches"] = f"""
WITH {CONV_TOKENS},
b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // {Q.PAD_BATCH} AS batch FROM g)
SELECT conv_id, batch,
       CAST(ceil(CAST(max(total_tokens) OVER (PARTITION BY batch) AS DOUBLE) / 8) * 8 AS BIGINT) AS padded_length,
       CAST(ceil(CAST(max(total_tokens) OVER (PARTITION BY batch) AS DOUBLE) / 8) * 8 AS BIGINT) AS ids_length,
       labeled_tokens
FROM b"""

_CHOICE_HEAD = f"{IM_START}system\n{A.CHOICE_SYSTEM_PROMPT}{IM_END}\n{IM_START}user\n"
_CHOICE_TAIL = f"\n\nAnswer:{IM_END}\n{IM_START}assistant\n"

SQL["build_choice_prompts"] = f"""
WITH p AS (SELECT p_partkey,
                  {lit(_CHOICE_HEAD)} || 'Which of these describes part ' || p_name || '?' || chr(10) || chr(10)
                  || 'A. ' || p_brand || chr(10) || 'B. ' || p_type || chr(10) || 'C. ' || p_name || chr(10)
                  || 'D. Size ' || CAST(p_size AS VARCHAR) || {lit(_CHOICE_TAIL)} AS prompt
           FROM part)
SELECT p_partkey, length(prompt) AS prompt_length, md5(prompt) AS prompt_md5 FROM p"""

_RSTRIP = f"{UNICODE_SPACE_CLASS}+\\z"
_HIT = " OR ".join(["l = ''", "starts_with(l, '#')"] + [f"starts_with(l, {lit(p)})" for p in A.CODE_LINE_PREFIXES])

SQL["extract_code"] = f"""
WITH r AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'Here is the code:' || chr(10) || '```python' || chr(10) || text
                               || chr(10) || '```' || chr(10) || 'Done.' ELSE text END AS response FROM documents),
x AS (SELECT doc_id, response,
             CASE WHEN regexp_matches(response, '{A.FENCED_CODE_RE}')
                  THEN {strip(f"regexp_extract(response, '{A.FENCED_CODE_RE}', 1)")} END AS fenced,
             list_transform(string_split(response, chr(10)), lambda l: regexp_replace(l, '{_RSTRIP}', '', 'g')) AS lines
      FROM r),
y AS (SELECT *, coalesce(list_position(list_transform(lines, lambda l: {_HIT}), TRUE), 0) AS p FROM x),
z AS (SELECT doc_id, coalesce(fenced, CASE WHEN p > 0 THEN array_to_string(list_slice(lines, p, len(lines)), chr(10)) END,
                              response) AS code FROM y)
SELECT doc_id, length(code) AS code_length, md5(code) AS code_md5 FROM z"""

SQL["numeric_answers"] = f"""
WITH {NUMERIC}
SELECT item_id AS o_orderkey, ground_truth, predicted, correct FROM numgraded"""

SQL["choice_accuracy_by_subject"] = f"""
WITH {CHOICES}
SELECT subject, correct, total, accuracy FROM subj"""

SQL["running_accuracy"] = f"""
WITH {CHOICES}
SELECT item_id AS event_id, event_type, row_number() OVER w AS running_rows,
       CAST(sum(CAST(correct AS BIGINT)) OVER w AS BIGINT) AS running_correct,
       CAST(sum(CAST(correct AS BIGINT)) OVER w AS DOUBLE) * 100 / row_number() OVER w AS running_accuracy,
       row_number() OVER w % 100 = 0 AS is_report_point
FROM chgraded
WINDOW w AS (PARTITION BY event_type ORDER BY item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

SQL["baseline_delta"] = f"""
WITH {RESULTS},
j AS (SELECT s.*, nullif(b.baseline, 0) AS baseline FROM scored s LEFT JOIN baselines b USING (benchmark)),
k AS (SELECT *, round(score - baseline, 1) AS delta FROM j)
SELECT benchmark, metric, score, correct, total, baseline, delta,
       CASE WHEN delta IS NULL THEN '—' WHEN delta > 0 THEN printf('+%.1f', delta) WHEN delta < 0 THEN printf('%.1f', delta)
            ELSE '0.0' END AS delta_text,
       CASE WHEN delta IS NULL THEN '—' WHEN delta >= 0 THEN printf('+%.1f%%', delta) ELSE printf('%.1f%%', delta) END
           AS delta_markdown
FROM k"""

SQL["report_summary"] = f"""
WITH {RESULTS},
s AS (SELECT count(*) AS num_benchmarks, coalesce(round(avg(score), 2), 0.0) AS average_score FROM scored),
b AS (SELECT avg(baseline) AS baseline_average FROM baselines)
SELECT num_benchmarks, average_score, baseline_average, round(average_score - baseline_average, 1) AS overall_delta
FROM s, b"""

SQL["subject_top_bottom"] = f"""
WITH {CHOICES},
r AS (SELECT *, row_number() OVER (ORDER BY accuracy DESC, first_seen) AS position, count(*) OVER () AS n FROM subj)
SELECT 'top' AS list, position, subject, accuracy FROM r WHERE position <= 10
UNION ALL
SELECT 'bottom' AS list, position, subject, accuracy FROM r WHERE n > 10 AND position > n - 10"""

SQL["pass_at_k"] = """
WITH g AS (SELECT d.source, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS c
           FROM labels l JOIN documents d USING (doc_id) GROUP BY d.source)
SELECT source, n, c,
       round(CASE WHEN c <= 0 THEN 0.0::DOUBLE WHEN n - c < 10 THEN 1.0::DOUBLE
                  ELSE 1.0::DOUBLE - list_reduce(list_transform(range(n - c + 1, n + 1),
                                                                lambda i: 1.0::DOUBLE - 10.0::DOUBLE / i),
                                                 lambda a, b: a * b) END, 6) AS pass_at_10
FROM g"""

_CONTRACT_VALUES = ", ".join(
    f"('{name}', [{', '.join(repr(k) for k in req)}])" for name, req in Q.EVENT_CONTRACTS)

SQL["required_fields"] = f"""
WITH c(name, required) AS (VALUES {_CONTRACT_VALUES}),
h AS (SELECT event_type AS name, props, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line_no
      FROM events),
j AS (SELECT h.name, h.line_no,
             list_filter(c.required, lambda f: NOT list_contains(json_keys(h.props), f))[1] AS first_missing
      FROM h JOIN c ON h.name = c.name)
SELECT name, count(*) AS lines_checked,
       min(CASE WHEN first_missing IS NOT NULL THEN line_no END) AS first_failing_line,
       arg_min(first_missing, CASE WHEN first_missing IS NOT NULL THEN line_no END) AS missing_field,
       min(CASE WHEN first_missing IS NOT NULL THEN line_no END) IS NULL AS passed
FROM j GROUP BY name"""

SQL["incremental_clean"] = f"""
WITH {TRIPLES}
SELECT DISTINCT source, {KEY} AS content_key FROM tv WHERE ok"""

SQL["holdout_sources"] = """
SELECT source, count(*) AS documents FROM documents
WHERE source NOT IN ('src17', 'src18', 'src19') GROUP BY source"""

SQL["capped_ingest"] = """
SELECT source, doc_id
FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)
WHERE rn <= 25"""

SQL["json_roundtrip"] = f"""
SELECT conv_id, 'unknown' AS source, count(*) AS n_messages,
       md5(string_agg(role || '{RS}' || text, '{US}' ORDER BY turn)) AS fingerprint
FROM conversations GROUP BY conv_id"""

_GEN = f"{IM_END}\n{IM_START}assistant\n"
_CODE_HEAD = f"{IM_START}system\n{A.CODE_SYSTEM_PROMPT}{IM_END}\n{IM_START}user\n{A.CODE_USER_TEMPLATE_HEAD}"
_MATH_HEAD = f"{IM_START}system\n{A.MATH_SYSTEM_PROMPT}{IM_END}\n{IM_START}user\n"

SQL["benchmark_prompts"] = f"""
WITH p AS (SELECT item_id, {lit(_CODE_HEAD)} || text || {lit(_GEN)} AS code,
                  {lit(_MATH_HEAD)} || text || {lit(_GEN)} AS math FROM benchmark)
SELECT item_id, length(code) AS code_prompt_length, md5(code) AS code_prompt_md5,
       length(math) AS math_prompt_length, md5(math) AS math_prompt_md5 FROM p"""

SQL["choice_details"] = f"""
WITH {CHOICES}
SELECT c.item_id, e.props AS question, c.subject,
       substr('ABCD', c.answer + 1, 1) AS ground_truth,
       coalesce(substr('ABCD', c.pidx + 1, 1), '?') AS predicted, c.correct
FROM chgraded c JOIN events e ON e.event_id = c.item_id"""

_MD_DELTA = ("CASE WHEN delta IS NULL THEN '—' WHEN delta >= 0 THEN printf('+%.1f%%', delta) "
             "ELSE printf('%.1f%%', delta) END")

SQL["markdown_report"] = f"""
WITH {RESULTS},
j AS (SELECT s.*, nullif(b.baseline, 0) AS baseline FROM scored s LEFT JOIN baselines b USING (benchmark)),
k AS (SELECT *, round(score - baseline, 1) AS delta FROM j)
SELECT benchmark, '| ' || benchmark || ' | ' || metric || ' | ' || CAST(score AS VARCHAR) || '% | '
       || CASE WHEN baseline IS NULL THEN '—' ELSE CAST(baseline AS VARCHAR) || '%' END || ' | '
       || {_MD_DELTA} || ' |' AS line
FROM k"""

SQL["clean_summary_table"] = SQL["clean_outcomes"].split("SELECT CASE WHEN grouping(source)")[0] + """
SELECT source AS dataset, 'success' AS status, format('{:,}', input) AS input, format('{:,}', output) AS output,
       format('{:,}', input - output) AS dropped,
       CASE WHEN input > 0 THEN printf('%.1f%%', CAST(output AS DOUBLE) * 100 / input) ELSE '—' END AS retention,
       '—' AS size
FROM cnt"""

SQL["training_plan"] = f"""
WITH {TRIPLES}, {CONFIG}, {SPLIT},
t AS (SELECT count(*) AS train_examples FROM splitted WHERE split = 'train'),
p(profile, batch_size, grad_accumulation, epochs, warmup_ratio) AS (
  VALUES ('local', 1, 16, 1, 0.05::DOUBLE), ('cloud', 1, 32, 3, 0.05::DOUBLE)),
s AS (SELECT profile, train_examples, batch_size, grad_accumulation, warmup_ratio,
             CAST(floor(floor(train_examples / batch_size) / grad_accumulation) * epochs AS BIGINT) AS total_steps
      FROM t, p)
SELECT profile, train_examples, total_steps, CAST(greatest(1, floor(total_steps * warmup_ratio)) AS BIGINT) AS warmup_steps,
       CAST(batch_size * grad_accumulation AS BIGINT) AS effective_batch
FROM s"""

SQL["request_validation"] = """
WITH r AS (SELECT event_id, event_type = 'signup' AS no_messages, value / 100 AS temperature, user_id * 30 AS max_tokens,
                  coalesce(CASE WHEN event_type = 'error' THEN NULL
                                ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) / 100.0::DOUBLE END, 0.9::DOUBLE) AS top_p,
                  1.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS INTEGER) / 50.0::DOUBLE AS repetition_penalty
           FROM events),
v AS (SELECT *, coalesce(
        CASE WHEN no_messages THEN 'messages empty' END,
        CASE WHEN NOT temperature BETWEEN 0.0 AND 2.0 THEN 'temperature out of range [0.0, 2.0]' END,
        CASE WHEN NOT max_tokens BETWEEN 1 AND 4096 THEN 'max_tokens out of range [1, 4096]' END,
        CASE WHEN NOT top_p BETWEEN 0.0 AND 1.0 THEN 'top_p out of range [0.0, 1.0]' END,
        CASE WHEN NOT repetition_penalty BETWEEN 1.0 AND 2.0 THEN 'repetition_penalty out of range [1.0, 2.0]' END)
        AS reason FROM r)
SELECT event_id, temperature, max_tokens, top_p, repetition_penalty, reason IS NULL AS valid, reason FROM v"""

SQL["usage"] = f"""
WITH {CONV_TOKENS.replace(str(L), str(1 << 40))},
n AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id)
SELECT g.conv_id, total_tokens - labeled_tokens AS prompt_tokens, labeled_tokens AS completion_tokens,
       total_tokens, CASE WHEN turns - 2 > 0 THEN CAST(labeled_tokens AS DOUBLE) / (turns - 2) ELSE 0.0::DOUBLE END
       AS tokens_per_second
FROM g JOIN n USING (conv_id)"""

SQL["label_coverage_arrays"] = SQL["label_coverage"]

SQL["oversample_fractional"] = f"""
WITH {CONFIG}
SELECT source, doc_id, copy FROM extra"""

SQL["label_mask"] = f"""
WITH {CONV_TOKENS.replace("g AS (", "g0 AS (")},
spans AS (SELECT conv_id, s + 1 + h AS lab_start, least(s + 1 + h + c + 1, {L}) AS lab_end
          FROM o WHERE role = 'assistant' AND s + 1 + h < {L})
SELECT g0.conv_id, g0.labeled_tokens,
       CAST(min(spans.lab_start) AS BIGINT) AS first_labeled, CAST(max(spans.lab_end) - 1 AS BIGINT) AS last_labeled
FROM g0 LEFT JOIN spans USING (conv_id)
GROUP BY g0.conv_id, g0.labeled_tokens"""

SQL["manifest_summary"] = SQL["clean_outcomes"].split("SELECT CASE WHEN grouping(source)")[0] + """
SELECT count(*) AS sources, CAST(sum(input) AS BIGINT) AS total_input, CAST(sum(output) AS BIGINT) AS total_output,
       CAST(sum(input - output) AS BIGINT) AS total_dropped,
       count(*) FILTER (WHERE input - output = 0) AS sources_without_drops
FROM cnt"""

SQL["file_verdicts"] = f"""
WITH {TRIPLES},
l AS (SELECT d0.doc_id, d0.source AS name,
             CASE WHEN strpos(d0.text, chr(10)) > 0 THEN TRUE ELSE coalesce(json_valid(d0.text), FALSE) END AS parsed_ok,
             strpos(d0.text, chr(10)) > 0 AS has_fields,
             row_number() OVER (PARTITION BY d0.source ORDER BY d0.doc_id) AS line_no
      FROM d0),
cnt AS (SELECT name, count(*) AS line_count FROM l GROUP BY name),
p AS (SELECT name, min(CASE WHEN NOT parsed_ok THEN line_no END) AS first_bad_line FROM l GROUP BY name),
f AS (SELECT name, min(CASE WHEN NOT has_fields THEN line_no END) AS fields_line FROM l GROUP BY name),
e AS (SELECT source AS name, count(*) AS num_examples FROM documents GROUP BY source)
SELECT cnt.name, cnt.line_count, p.first_bad_line, p.first_bad_line IS NULL AS parse_ok,
       f.fields_line IS NULL AS fields_ok, CASE WHEN f.fields_line IS NOT NULL THEN 'system_prompt' END AS missing_field,
       f.fields_line, CASE WHEN e.num_examples > 0 THEN cnt.line_count = e.num_examples ELSE TRUE END AS count_ok,
       p.first_bad_line IS NULL AND f.fields_line IS NULL
         AND CASE WHEN e.num_examples > 0 THEN cnt.line_count = e.num_examples ELSE TRUE END AS passed
FROM cnt LEFT JOIN p USING (name) LEFT JOIN f USING (name) LEFT JOIN e USING (name)"""
