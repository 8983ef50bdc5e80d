"""DuckDB SQL for the corpus queries that SQL can express on whole tables, by plain joins of all pairs."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Lengths of repeated windows, doubled from 50 words to more than any text of the tables has.
_LEVELS = [50 << n for n in range(11)]


def _doubled(length: int) -> str:
    """CTEs for the windows of twice ``length`` words that repeat in another document, from those of ``length``."""
    return f"""
both_{length} AS (
    SELECT x.doc_id, x.pos, md5(x.h || y.h) AS h
    FROM repeated_{length} x JOIN repeated_{length} y ON x.doc_id = y.doc_id AND y.pos = x.pos + {length}
),
repeated_{2 * length} AS (
    SELECT doc_id, pos, h FROM both_{length}
    WHERE h IN (SELECT h FROM both_{length} GROUP BY h HAVING min(doc_id) < max(doc_id))
)"""


def _words(pattern: str, lower: bool) -> str:
    text = "coalesce(text, '')"
    if lower:
        text = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({text}, '{pattern}')"


_VECTORS = """
vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""
_SCORE = "list_inner_product(q.v, c.v)::BIGINT"

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words(_SPACED, True)} AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM docs
),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS digest FROM grams GROUP BY doc_id),
classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY digest) AS class_id FROM sets),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sets s ON s.doc_id = a JOIN sets t ON t.doc_id = b
    WHERE 100 * c >= 90 * (s.n + t.n - c)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, l.component_id, coalesce(c.class_id, d.doc_id) AS class_id
FROM docs d JOIN least l ON l.a = d.doc_id LEFT JOIN classes c ON c.doc_id = d.doc_id
""",
    "op2_substring_dedup": f"""
WITH docs AS (SELECT doc_id, {_words(_SPACED, False)} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
windows AS (
    SELECT doc_id, pos, md5(string_agg(word, ' ') OVER ahead) AS h, count(*) OVER ahead AS n FROM words
    WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
),
full_windows AS (SELECT doc_id, pos, h FROM windows WHERE n = 50),
firsts AS (SELECT h, min(doc_id) AS first, max(doc_id) AS last FROM full_windows GROUP BY h),
repeated AS (SELECT doc_id, pos, first FROM full_windows JOIN firsts USING (h) WHERE first < last),
repeated_50 AS (SELECT doc_id, pos, h FROM full_windows JOIN firsts USING (h) WHERE first < last),
{','.join(map(_doubled, _LEVELS[:-1]))},
levels AS (
    SELECT doc_id, max(length) AS longest FROM ({' UNION ALL '.join(f"SELECT doc_id, {n} AS length FROM repeated_{n}" for n in _LEVELS)})
    GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, pos + unnest(range(50)) AS pos FROM repeated WHERE first < doc_id),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS rest
    FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
    sha256(coalesce(k.rest, '')) AS kept_sha256,
    coalesce(longest, 0)::INTEGER AS longest_repeat
FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN levels USING (doc_id)
""",
    "op7_benchmark_decontamination": f"""
WITH docs AS (SELECT doc_id, {_words(_LETTERS, True)} AS w FROM documents),
items AS (
    SELECT item_id::VARCHAR AS item, {_words(_LETTERS, True)} AS w FROM benchmark WHERE item_id IS NOT NULL
),
patterns AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, unnest(list_transform(
        range(1, len(w) - least(13, len(w)) + 2),
        lambda i: array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' '))) AS g
    FROM items WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM patterns),
spread AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest(list_transform(
        range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS g
    FROM docs JOIN lengths ON len(w) >= n
),
found AS (SELECT doc_id, pos, spread.n, item FROM spread JOIN patterns ON spread.n = patterns.n AND spread.g = patterns.g),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, pos + unnest(range(n)) AS pos FROM found) GROUP BY doc_id),
told AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN told USING (doc_id)
""",
    "op12_hard_negatives": f"""
WITH {_VECTORS},
labelled AS (
    SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM vectors WHERE label IS NOT NULL
),
scored AS (
    SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, {_SCORE} AS score
    FROM labelled q JOIN labelled c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
    "op13_exact_top_k": f"""
WITH {_VECTORS}
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_SCORE} DESC, c.vec_id)::INTEGER AS rank,
    c.vec_id, {_SCORE} AS score
FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
QUALIFY rank <= 5
""",
}
