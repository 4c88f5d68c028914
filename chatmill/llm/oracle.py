"""DuckDB SQL for the queries that SQL can express."""

_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP7 = f"""
WITH t AS (SELECT doc_id, {_LOW.format('text')} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(low) AS text_sha256
FROM t WINDOW w AS (PARTITION BY low)
"""

_WORDS = f"regexp_extract_all({_LOW.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS run
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS run
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, run)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_TAIL = "(?:/?(?:INST|SYS|ANS|ROLE)\\]|:\\]|/?s>)"
_OP10 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(text, '([\\[<])(\\\\*{_TAIL})', '\\1\\\\\\2', 'g') AS safe,
             regexp_replace(role, '([\\[<])(\\\\*{_TAIL})', '\\1\\\\\\2', 'g') AS safe_role FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(safe) + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 9
                    ELSE 16 + length(safe_role) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP11 = f"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOW.format('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
      GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, k, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS first, array_to_string(w[cut + 1 : k], ' ') AS rest
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
           FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = first JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
         WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""

SQL = {"op11_collocations": _OP11, "op10_chat_format": _OP10, "op7_exact_dedup": _OP7, "op8_decontaminate": _OP8}
