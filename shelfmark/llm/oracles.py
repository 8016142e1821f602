"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

#: A-Z alone in lower case; a null text is an empty one.
NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH normal AS (SELECT doc_id, {NORMAL} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM normal
"""

SPLIT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2 = f"""
WITH w AS (SELECT doc_id, {SPLIT.format("coalesce(text, '')")} AS ws FROM documents),
runs AS (SELECT doc_id, k, array_to_string(ws[k:k + 49], ' ') AS run FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS k FROM w WHERE len(ws) >= 50)),
firsts AS (SELECT run, min(doc_id) AS first FROM runs GROUP BY run),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS j FROM runs JOIN firsts USING (run) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(removed.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {SPLIT.format(NORMAL)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.size + nb.size - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN n USING (doc_id)
"""

TERMS = r"unnest(regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

OP13 = f"""
WITH said AS (SELECT doc_id, {TERMS.format("text")} AS term FROM documents),
held AS (SELECT doc_id, term, count(*) AS tf FROM said GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY 1),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {TERMS.format("text")} AS term FROM benchmark)),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN held USING (term) JOIN size USING (doc_id), whole GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

OP11 = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({NORMAL}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
said AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM piece),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM said GROUP BY 1),
f AS (SELECT lang, p, len(p) AS m, count(*) AS a FROM (SELECT lang, ws[i:i + m - 1] AS p FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM said, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m)) GROUP BY lang, p),
candidate AS (SELECT lang, p, m, a, array_to_string(p, ' ') AS phrase FROM f WHERE m >= 2 AND a >= 100),
cut AS (SELECT c.lang, c.phrase, c.m, c.a, k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:c.m] JOIN total ON total.lang = c.lang),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM worst w WHERE NOT EXISTS (SELECT 1 FROM candidate x WHERE x.lang = w.lang AND x.m > w.m AND x.a >= w.a AND contains(' ' || x.phrase || ' ', ' ' || w.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {"op1_exact_dedup": OP1, "op2_substring_dedup": OP2, "op8_near_dedup": OP8, "op11_phrase_growth": OP11, "op13_wand_search": OP13}
