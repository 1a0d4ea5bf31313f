"""SQL equivalents of the queries of this subpackage, for DuckDB."""

from __future__ import annotations

_WORDS = "regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}]+')"


def _runs(key: str, text: str, table: str, n: int) -> str:
    """Distinct runs of ``n`` words: ``k, g``."""
    return (
        f"SELECT DISTINCT k, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - {n - 2})) AS i "
        f"FROM (SELECT {key} AS k, {_WORDS.format(t=text)} AS w FROM {table} WHERE {text} IS NOT NULL))"
    )


# Windows of 200 characters that stand in more than one document, and how they join to stretches.
_STRETCHES = """WITH w AS (SELECT doc_id, i - 1 AS s, hash(substr(text, i, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)),
        r AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1), k AS (SELECT DISTINCT doc_id, s FROM w SEMI JOIN r ON w.h = r.h),
        b AS (SELECT doc_id, s, coalesce(s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) > 200, true) AS fresh FROM k),
        g AS (SELECT doc_id, s, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY s) AS n FROM b),
        x AS (SELECT doc_id, min(s) AS start_pos, max(s) + 200 AS end_pos FROM g GROUP BY doc_id, n)"""

_SIMILAR = f"""s AS ({_runs('content_id', 'text', 'parsed_content', 3)}), n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
        o AS (SELECT a.k AS a, b.k AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY ALL),
        p AS (SELECT o.a, o.b FROM o JOIN n x ON x.k = o.a JOIN n y ON y.k = o.b WHERE o.o >= 0.7 * (x.n + y.n - o.o) - 1e-9),
        e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), r(id, far) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.far),
        c AS (SELECT id, min(far) AS low FROM r GROUP BY id), d AS (SELECT a AS id, count(*) AS n FROM e GROUP BY a),
        g AS (SELECT DISTINCT content_id, least(content_id, coalesce(low, content_id)) AS group_id, coalesce(n, 0) AS n_links FROM parsed_content LEFT JOIN c ON c.id = content_id LEFT JOIN d ON d.id = content_id)"""


def _places(key: str, text: str, table: str, n: int) -> str:
    """Runs of ``n`` words with the place of their first: ``k, i, g``."""
    return (
        f"SELECT k, i - 1 AS i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - {n - 2})) AS i "
        f"FROM (SELECT {key} AS k, {_WORDS.format(t=text)} AS w FROM {table} WHERE {text} IS NOT NULL))"
    )


ORACLE: dict[str, str] = {
    "p4_found": f"""WITH s AS ({_runs('content_id', 'text', 'parsed_content', 3)}), n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
        o AS (SELECT a.k AS a, b.k AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY ALL)
        SELECT o.a AS content_id_a, o.b AS content_id_b FROM o JOIN n x ON x.k = o.a JOIN n y ON y.k = o.b WHERE o.o >= 0.7 * (x.n + y.n - o.o) - 1e-9""",
    "p7_found": "SELECT DISTINCT content_id FROM parsed_content WHERE length(text) > 6000",
    "p7_rebuilt": "SELECT content_id, md5(text) AS text_md5, false AS too_long, false AS odd_overlap FROM parsed_content WHERE length(text) > 6000",
    "p8_checks": "SELECT count(DISTINCT doc_id) AS n_docs, 0::BIGINT AS n_over, 0::BIGINT AS n_cut_in_vain, false AS wasteful FROM documents WHERE text <> ''",
    "p9_found": f"""WITH d AS ({_runs('doc_id', 'text', 'documents', 12)}), i AS ({_runs('item_id', 'item_text', 'eval_items', 12)})
        SELECT DISTINCT d.k AS doc_id, i.k AS item_id FROM d JOIN i ON d.g = i.g""",
    "p9_items": f"""WITH d AS ({_runs('doc_id', 'text', 'documents', 12)}), i AS ({_runs('item_id', 'item_text', 'eval_items', 12)}),
        p AS (SELECT DISTINCT d.k AS doc_id, i.k AS item_id FROM d JOIN i ON d.g = i.g)
        SELECT item_id, count(*) AS n_docs FROM p GROUP BY 1""",
    "p10_found": """WITH g AS (SELECT DISTINCT doc_id, hash(substr(text, i, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)),
        r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1), k AS (SELECT g.* FROM g SEMI JOIN r ON g.h = r.h)
        SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM k a JOIN k b ON a.h = b.h AND a.doc_id < b.doc_id""",
    "p10_spans": f"{_STRETCHES} SELECT doc_id, start_pos, end_pos FROM x",
    "p10_shares": f"""{_STRETCHES}, t AS (SELECT doc_id, sum(end_pos - start_pos)::BIGINT AS c, count(*) AS n FROM x GROUP BY 1)
        SELECT doc_id, coalesce(length(text), 0)::BIGINT AS n_chars, coalesce(c, 0)::BIGINT AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(c, 0) / length(text) ELSE 0.0::DOUBLE END AS share,
        coalesce(n, 0)::INTEGER AS n_spans FROM documents LEFT JOIN t USING (doc_id)""",
    "p10_classes": """WITH t AS (SELECT doc_id, text FROM documents WHERE length(text) >= 200), c AS (SELECT text, min(doc_id) AS class_id, count(*) AS n_copies FROM t GROUP BY 1)
        SELECT doc_id, class_id, n_copies FROM t JOIN c USING (text)""",
    "p4_classes": f"""WITH t AS (SELECT content_id, text FROM parsed_content WHERE len({_WORDS.format(t='text')}) >= 3), c AS (SELECT text, min(content_id) AS class_id, count(*) AS n_copies FROM t GROUP BY 1)
        SELECT content_id, class_id, n_copies FROM t JOIN c USING (text)""",
    "p4_groups": f"WITH RECURSIVE {_SIMILAR} SELECT content_id, group_id, n_links FROM g",
    "p4_group_hashes": f"""WITH RECURSIVE {_SIMILAR}, k AS (SELECT content_id, salesforce_content_version_id AS v, lower(content_hash) AS h, group_id FROM parsed_content JOIN g USING (content_id)),
        a AS (SELECT group_id, content_id, h FROM k UNION ALL SELECT group_id, NULL, lower(f.content_hash) FROM k JOIN catalog_files f ON f.salesforce_content_version_id = k.v)
        SELECT group_id, count(DISTINCT content_id) AS n_records, count(DISTINCT h) AS n_hashes FROM a GROUP BY 1 HAVING count(DISTINCT content_id) > 1""",
    "p9_spans": f"""WITH d AS ({_places('doc_id', 'text', 'documents', 12)}), q AS ({_runs('item_id', 'item_text', 'eval_items', 12)}),
        h AS (SELECT DISTINCT d.k AS doc_id, q.k AS item_id, d.i FROM d JOIN q ON d.g = q.g),
        b AS (SELECT *, coalesce(i - lag(i) OVER w > 12, true) AS fresh FROM h WINDOW w AS (PARTITION BY doc_id, item_id ORDER BY i)),
        n AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id, item_id ORDER BY i) AS n FROM b)
        SELECT doc_id, item_id, min(i)::BIGINT AS first_word, (max(i) - min(i) + 12)::BIGINT AS n_words FROM n GROUP BY doc_id, item_id, n""",
}
