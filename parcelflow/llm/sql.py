"""DuckDB SQL of the queries that SQL can express, written without the operators' classes or strings."""

#: the runs of letters, digits and characters beyond ASCII, A-Z lowered
_TERMS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = f"""
WITH cut AS (SELECT doc_id, {_TERMS.format("text")} AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM cut WHERE len(terms) > 0),
stat AS (SELECT COUNT(*) AS n_docs, CAST(SUM(n) AS BIGINT) AS n_terms FROM sized),
held AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM sized) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w
           FROM held, stat GROUP BY term, n_docs),
asked AS (SELECT item_id, term, COUNT(*) AS times
          FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
sizes AS (SELECT doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM sized, stat),
scored AS (SELECT item_id, doc_id, CAST(SUM(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM asked JOIN weight USING (term) JOIN held USING (term) JOIN sizes USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

SUBSTRING_DEDUP = r"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
started AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM cut WHERE len(words) >= 13),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS seq FROM started),
earliest AS (SELECT seq, MIN(doc_id) AS lo FROM windows GROUP BY seq HAVING MIN(doc_id) < MAX(doc_id)),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos
         FROM (SELECT w.doc_id, w.pos, unnest(range(0, 13)) AS k FROM windows w JOIN earliest USING (seq) WHERE lo < w.doc_id)),
single AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM cut),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM single ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
counted AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""
