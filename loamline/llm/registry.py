"""All queries of this subpackage, by name, with their SQL where SQL can say the same."""

from __future__ import annotations

from loamline.llm import queries as q


def queries() -> dict:
    return {
        "p1_pieces": q.p1_pieces,
        "p1_cover": q.p1_cover,
        "p1_found": q.p1_found,
        "p2_groups": q.p2_groups,
        "p2_found": q.p2_found,
        "p3_residue": q.p3_residue,
        "p3_found": q.p3_found,
        "p3_kept": q.p3_kept,
        "p7_lines": q.p7_lines,
        "p7_found": q.p7_found,
        "p7_pages": q.p7_pages,
        "p8_leaks": q.p8_leaks,
        "p8_found": q.p8_found,
        "p9_mix": q.p9_mix,
        "p9_shares": q.p9_shares,
        "p10_shares": q.p10_shares,
        "p10_found": q.p10_found,
        "p10_make_up": q.p10_make_up,
    }


_WORDS = "list_distinct(regexp_extract_all(lower(coalesce({t}, '')), '[\\p{{L}}\\p{{N}}]+'))"
_RUNS = "SELECT {key}, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS run FROM {table}"


_LINKED = (
    f"WITH RECURSIVE t AS (SELECT item_id, {_WORDS.format(t='title')} AS w, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(url), '#.*$', ''), "
    "'([?&])(?:(?:utm_source|utm_medium|utm_campaign|utm_term|utm_content|gclid|fbclid|mc_cid|mc_eid)=[^&]*&?)+', '\\1', 'g'), '[?&]$', ''), '^https?://(?:[wW]{3}[.])?', '') AS u FROM rss_items), "
    "k AS (SELECT item_id, w, lower(regexp_extract(u, '^[^/?]*')) || regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', ''), '/+', '/', 'g') || '?' || regexp_extract(u, '[?](.*)$', 1) AS u FROM t), "
    "e AS (SELECT a.item_id AS a, b.item_id AS b FROM k a JOIN k b ON a.item_id <> b.item_id WHERE a.u = b.u OR (len(a.w) > 0 AND len(list_intersect(a.w, b.w)) >= 0.6 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))))), "
    "r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)"
)


def oracle_sql() -> dict[str, str]:
    every = lambda table, key: f"SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL"
    return {
        "p1_found": (
            "SELECT DISTINCT id FROM pdf_chunks JOIN chunk_profiles c ON c.doc_kind = pdf_chunks.metadata.doc_kind WHERE id IS NOT NULL AND greatest(length(text) // 4, 1) > max_tokens"
        ),
        "p1_cover": (
            "SELECT id, metadata.ingest_version AS ingest_version, metadata.doc_kind AS doc_kind, CAST(sum(length(text)) AS BIGINT) AS chars, true AS within FROM pdf_chunks WHERE text IS NOT NULL GROUP BY ALL"
        ),
        "p2_found": f"{_LINKED} SELECT DISTINCT a AS item_id_a, b AS item_id_b FROM r WHERE a < b",
        "p2_groups": f"{_LINKED}, g AS (SELECT a, min(b) AS b FROM r GROUP BY a) SELECT item_id, least(item_id, coalesce(b, item_id)) AS grp FROM (SELECT DISTINCT item_id FROM rss_items WHERE item_id IS NOT NULL) LEFT JOIN g ON a = item_id",
        "p8_found": (
            f"WITH d AS ({every('documents', 'doc_id')}), i AS ({every('eval_items', 'item_id')}), dr AS ({_RUNS.format(key='doc_id', table='d WHERE len(w) >= 12')}), "
            f"ir AS ({_RUNS.format(key='item_id', table='i WHERE len(w) >= 12')}) SELECT DISTINCT doc_id, item_id FROM dr JOIN ir USING (run)"
        ),
    }
