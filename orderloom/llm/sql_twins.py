"""DuckDB SQL for the queries that SQL can say."""

from __future__ import annotations

_WORDS = r"""list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

_FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

NGRAM_JACCARD_STEPS = f"""
worded AS (
    SELECT doc_id, {_WORDS.format(text=_FOLDED)} AS w FROM {{docs}}
),
shingle AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
            WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2),
                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g
        FROM worded)
),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
linked AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM shingle x JOIN shingle y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN sized sa ON sa.doc_id = a JOIN sized sb ON sb.doc_id = b
    WHERE 185 * shared >= 85 * (sa.n + sb.n)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM {{docs}}
    UNION
    SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
)
"""

NGRAM_JACCARD = (
    "WITH RECURSIVE "
    + NGRAM_JACCARD_STEPS.format(docs="documents")
    + """
SELECT a AS doc_id, coalesce(max(n), 0) AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN sized ON sized.doc_id = a GROUP BY a
"""
)

QUALITY_STEPS = rf"""
split AS (
    SELECT *, {_WORDS.format(text="coalesce(text, '')")} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
),
trigram AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
        unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g
    FROM split WHERE len(w) >= 3
),
place AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM trigram
    ) CROSS JOIN (VALUES (0), (1), (2)) offsets(k) WHERE times > 1 GROUP BY doc_id
),
measured AS (
    SELECT split.*, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', ''))
            AS BIGINT) AS n_symbols,
        CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN place USING (doc_id)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        100 * n_symbols > 10 * word_chars AS many_symbols,
        100 * n_dup_lines > 30 * n_lines AS many_lines
    FROM measured
),
rule AS (
    SELECT source, count(*) AS n, unnest(['base', 'symbols', 'lines']) AS rule,
        unnest([count(*) FILTER (base_failed), count(*) FILTER (many_symbols),
            count(*) FILTER (many_lines)]) AS f
    FROM judged GROUP BY source
),
prior AS (
    SELECT rule, sum(f) / sum(n) AS m, sum(1.0 * f * f / n) / sum(n) AS q,
        count(*) / sum(n) AS h FROM rule GROUP BY rule
),
strength AS (
    SELECT rule, m, CASE WHEN q - m * m - m * (1 - m) * h > 0
        THEN greatest(m * (1 - m) / (q - m * m - m * (1 - m) * h) - 1, 0) END AS s FROM prior
),
bad_host AS (
    SELECT DISTINCT source FROM rule JOIN strength USING (rule)
    WHERE coalesce((f + s * m) / (n + s), m) > 0.5
)
"""

QUALITY_RULES = (
    f"WITH {QUALITY_STEPS}"
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT EXISTS (
        SELECT 1 FROM bad_host WHERE bad_host.source IS NOT DISTINCT FROM judged.source) AS kept
FROM judged
"""
)

MIXING = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, (1.0::DOUBLE / count(*) OVER ()) * sum(n) OVER () / n AS rate FROM sizes
),
draw AS (
    SELECT d.*, rate, (CAST('0x' || substr(md5('17:' || doc_id || ':1'), 1, 13) AS BIGINT)
        + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
),
step AS (
    SELECT source, k, sum(CASE WHEN k = 0 THEN exp(-rate)
        ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END) OVER (
        PARTITION BY source ORDER BY k) AS below
    FROM rates CROSS JOIN range(0, 200) ks(k)
),
counted AS (
    SELECT draw.*, (SELECT count(*) FROM step
        WHERE step.source IS NOT DISTINCT FROM draw.source AND below < u) AS k FROM draw
),
copies AS (SELECT * EXCLUDE (k, u), unnest(range(0, k)) AS c FROM counted)
SELECT doc_id, text, lang, source, n_chars, CAST(c AS INTEGER) AS _copy, rate AS _rate,
    (CAST('0x' || substr(md5('order17:' || doc_id || ':' || c), 1, 13) AS BIGINT) + 0.5::DOUBLE)
        / 4503599627370496::DOUBLE AS _order
FROM copies
"""

HARD_NEGATIVES = """
WITH parts AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
usable AS (
    SELECT vec_id, label FROM parts
    GROUP BY vec_id, label HAVING bool_and(x IS NOT NULL AND isfinite(x))),
whole AS (
    SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM parts SEMI JOIN usable USING (vec_id)),
scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, CAST(sum(a.x * c.x) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.i = c.i
    WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id GROUP BY 1, 2),
labelled AS (
    SELECT s.*, a.label = c.label AS same
    FROM scores s JOIN usable a ON a.vec_id = anchor_id JOIN usable c ON c.vec_id = other_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM labelled WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score,
           n.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                              ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
    FROM positives p JOIN labelled n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""

COLLOCATIONS = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
pieces AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
    SELECT lang, list_slice(ws, i, i + k - 1) AS ph, k, count(*) AS a
    FROM starts, (SELECT unnest(range(1, 6)) AS k)
    WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 100),
sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, ph, k, a, unnest(range(1, k + 1)) AS b FROM grams WHERE k > 2),
inner_parts AS (SELECT *, unnest(range(b, k + 1)) AS e FROM places),
longest AS (
    SELECT lang, list_slice(ph, b, e) AS ph, max(a) AS longer
    FROM inner_parts WHERE e - b + 1 < k GROUP BY ALL),
kept AS (
    SELECT g.* FROM grams g LEFT JOIN longest USING (lang, ph)
    WHERE k >= 2 AND NOT coalesce(100 * longer >= 100 * a, false)),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (
    SELECT c.lang, c.ph, c.a, c.cut, x.a AS l, y.a AS r, s.n,
           CAST((1000::HUGEINT * c.a * s.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cuts c
    JOIN grams x ON x.lang = c.lang AND x.ph = list_slice(c.ph, 1, c.cut)
    JOIN grams y ON y.lang = c.lang AND y.ph = list_slice(c.ph, c.cut + 1, c.k)
    JOIN sizes s ON s.lang = c.lang),
lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) AS place FROM scored),
ranked AS (
    SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score,
           row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank
    FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
