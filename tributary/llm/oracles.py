"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SPACED = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STATEMENTS: dict[str, str] = {
    "op5_benchmark_decontamination": f"""
        WITH item AS (
            SELECT cast(item_id AS varchar) AS item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}') AS w
            FROM benchmark
        ),
        item_window AS (
            SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS words
            FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(i) WHERE len(w) > 0
        ),
        sizes AS (SELECT DISTINCT size FROM item_window),
        doc AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}'), []) AS w
            FROM documents
        ),
        doc_window AS (
            SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
            FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS r(i) WHERE len(w) >= size
        ),
        hit AS (SELECT doc_id, i, size, item FROM doc_window JOIN item_window USING (size, words)),
        hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + size)) AS r(p) GROUP BY doc_id),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op7_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        sized AS (
            SELECT *, length('### : ') + length('</turn>') + 1
                + CASE WHEN role IN ('user', 'system', 'assistant') THEN length(role) ELSE length('Role=') + 2 * strlen(role) END
                + length(text)
                + CASE WHEN contains(text, '###') OR contains(text, '</turn>') OR regexp_matches(text, '#\\+#|<\\+/turn>')
                    THEN len(regexp_extract_all(replace(text, '#', chr(1) || chr(2)), chr(2) || '\\*' || chr(1)))
                        + len(regexp_extract_all(text, '<\\*/turn>'))
                    ELSE 0 END AS shown
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
               sum(shown)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op11_ngram_jaccard_join": f"""
        WITH RECURSIVE word AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{SPACED}'), []) AS w FROM documents
        ),
        own AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(
                [array_to_string(w[i : i + least(3, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(3, len(w)) + 2)])) END AS s
            FROM word
        ),
        class AS (SELECT s, row_number() OVER () AS class, len(s) AS n FROM (SELECT DISTINCT s FROM own WHERE len(s) > 0)),
        shingle AS (SELECT class, n, unnest(s) AS x FROM class),
        link AS (
            SELECT a.class AS a, b.class AS b FROM shingle a JOIN shingle b ON a.x = b.x AND a.class <> b.class
                AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.class, b.class, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)
        ),
        reach AS (SELECT class AS a, class AS b FROM class UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        root AS (SELECT a AS class, min(b) AS root FROM reach GROUP BY a),
        placed AS (SELECT doc_id, len(own.s) AS n, root FROM own LEFT JOIN class ON own.s = class.s LEFT JOIN root USING (class))
        SELECT doc_id, n AS n_shingles, CASE WHEN root IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY root) END AS component_id
        FROM placed""",
    "op13_ranked_search": f"""
        WITH term AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) AS term FROM documents
        ),
        size AS (SELECT doc_id, count(*) AS n FROM term GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
        item AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERMS}')) AS term FROM benchmark
        ),
        found AS (SELECT doc_id, term, count(*) AS tf FROM term WHERE term IN (SELECT term FROM item) GROUP BY doc_id, term),
        weight AS (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM found GROUP BY term), total
        ),
        measure AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM size, total),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM item JOIN found USING (term) JOIN weight USING (term) JOIN measure USING (doc_id) GROUP BY item_id, doc_id
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
