"""DuckDB oracles for the registered queries (same column names and types)."""

from __future__ import annotations


def _guid(expr: str) -> str:
    h = f"md5({expr})"
    return ("(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            "substr({h},17,4) || '-' || substr({h},21,12))").format(h=h)


EVENT_KEYS = ("event_id", "user_id", "event_type", "props", "ts")


def _escaped(col: str) -> str:
    """Value text with backslash and '|' escaped, NULL as the two characters \\N."""
    text = f"CAST({col} AS VARCHAR)"
    return rf"coalesce(replace(replace({text}, '\', '\\'), '|', '\|'), '\N')"


DOC_KEY = "('doc_' || CAST(d.doc_id AS VARCHAR) || '.txt')"
NESTED_KEY = "(d.source || '/doc_' || CAST(d.doc_id AS VARCHAR) || '.txt')"
UPLOADED = "EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)"
LABELLED = "EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
SRC = ("event_id AS ID, user_id AS POLICY_ID, event_type AS COMPANY, props AS BROKER, "
       "ts AS MODIFIED")
BODY_FACTS = "CAST(strlen(d.text) AS BIGINT) AS size, sha1(d.text) AS sha1"

ORACLES: dict[str, str] = {
    "object_metadata": """
        SELECT 'binder_' || user_id || '.pdf' AS key, CAST(strlen(props) AS BIGINT) AS size,
               CAST(user_id AS VARCHAR) AS policy_id, event_type AS company
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) WHERE rn = 1""",
    "reconcile_targets": f"""
        SELECT {DOC_KEY} AS key,
               CASE WHEN d.lang = 'es' THEN 'stray' WHEN d.lang = 'de' THEN 'removed'
                    WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
                    THEN 'changed' WHEN d.lang = 'fr' THEN 'replaced' ELSE 'same' END AS state,
               CASE WHEN d.lang = 'es' THEN 'none' WHEN d.lang = 'de' THEN 'upload_new'
                    WHEN d.lang = 'fr' OR EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
                    THEN 'upload_changed' ELSE 'skip' END AS action
        FROM documents d
        UNION ALL SELECT 'page_' || CAST(page_id AS VARCHAR), 'stray', 'none' FROM pages""",
    "incr_composite_nulls": """
        SELECT event_id AS ID, user_id AS POLICY_ID,
               CASE WHEN event_type <> 'error' THEN event_type END AS COMPANY,
               props AS BROKER, ts AS MODIFIED FROM events""",
    "incr_late_nulls": """
        SELECT event_id AS ID, CAST(1 AS BIGINT) AS n_times,
               CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' OR event_id % 7 <> 0 THEN ts END AS MODIFIED,
               CAST(CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN 1
                         WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 2 ELSE 3 END AS BIGINT) AS run_no
        FROM events""",
    "export_repeated_ids": """
        WITH s AS (SELECT 'binder_' || o_custkey || '-' || o_orderstatus || '.pdf' AS key, o_orderdate,
                          o_orderkey || ':' || o_orderpriority AS body FROM orders)
        SELECT key, CAST(strlen(body) AS BIGINT) AS size, sha1(body) AS sha1
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY key ORDER BY o_orderdate DESC, strlen(body) DESC, sha1(body) DESC) AS rn
              FROM s) WHERE rn = 1""",
    "sync_prefix": f"""
        SELECT d.doc_id AS id, {DOC_KEY} AS filename FROM documents d
        WHERE NOT starts_with({DOC_KEY}, 'doc_5')
           OR EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id)""",
    "readd_after_delete": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS} FROM documents d WHERE strlen(d.text) > 0""",
    "object_listing": """
        SELECT url AS key, CAST(strlen(html) AS BIGINT) AS size FROM pages
        WHERE url LIKE 'https://%' AND url LIKE '%.html'""",
    "listing_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM pages WHERE url LIKE '%.html'",
    "distinct_keys": "SELECT DISTINCT source AS key FROM documents WHERE source IS NOT NULL",
    "blob_roundtrip": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS} FROM documents d WHERE strlen(d.text) > 0""",
    "complete_listing": f"""
        SELECT {NESTED_KEY} AS key, CAST(strlen(d.text) AS BIGINT) AS size FROM documents d""",
    "prefix_listing": f"""
        SELECT {NESTED_KEY} AS key, CAST(strlen(d.text) AS BIGINT) AS size FROM documents d
        WHERE starts_with({NESTED_KEY}, 'src1')""",
    "file_listing": f"""
        SELECT {NESTED_KEY} AS key, CAST(strlen(d.text) AS BIGINT) AS size FROM documents d
        WHERE strlen(d.text) > 0 AND {NESTED_KEY} LIKE 'src1%'""",
    "pending_blobs": f"""
        SELECT {_guid(DOC_KEY)} AS guid, {DOC_KEY} AS filename, {BODY_FACTS}
        FROM documents d WHERE NOT {UPLOADED}""",
    "blobs_by_id": f"""
        SELECT d.doc_id AS id, {_guid(DOC_KEY)} AS guid, {DOC_KEY} AS filename, {BODY_FACTS}
        FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "pruned_lookup": f"""
        SELECT d.doc_id AS id, {_guid(DOC_KEY)} AS guid, {DOC_KEY} AS filename, {BODY_FACTS}
        FROM documents d WHERE d.doc_id % 20 = 3""",
    "save_by_id": f"""
        SELECT 'by_id/' || {DOC_KEY} AS key, {BODY_FACTS} FROM documents d
        WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND strlen(d.text) > 0""",
    "new_objects": f"""
        SELECT {DOC_KEY} AS key, CAST(strlen(d.text) AS BIGINT) AS size
        FROM documents d WHERE NOT {LABELLED}""",
    "orphan_keys": f"""
        SELECT DISTINCT {DOC_KEY} AS key FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id)""",
    "orphan_delete": f"""
        SELECT d.doc_id AS id, {DOC_KEY} AS filename FROM documents d
        WHERE EXISTS (SELECT 1 FROM pages p WHERE p.page_id = d.doc_id)""",
    "size_skip_plan": f"""
        SELECT {DOC_KEY} AS key, CAST(strlen(d.text) AS BIGINT) AS size,
               CASE WHEN {LABELLED} THEN d.n_chars END AS target_size,
               CASE WHEN NOT {LABELLED} THEN 'upload_new'
                    WHEN strlen(d.text) = d.n_chars THEN 'skip'
                    ELSE 'upload_changed' END AS action
        FROM documents d""",
    "incr_timestamp": f"SELECT {SRC} FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
    "incr_id": f"SELECT {SRC} FROM events WHERE event_id > 7500",
    "incr_composite": """
        SELECT o_orderkey AS ID, o_custkey AS POLICY_ID, o_orderstatus AS COMPANY,
               o_orderpriority AS BROKER, o_orderdate AS MODIFIED FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
           OR (o_orderdate = TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey > 7000)""",
    "incr_composite_keys": f"""
        SELECT {SRC} FROM events
        WHERE event_id > (SELECT max(event_id) FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00')""",
    "bookmark_runs": """
        WITH r AS (
            SELECT CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN 1
                        WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 2 ELSE 3 END AS run_no,
                   ts, event_id
            FROM events WHERE ts IS NOT NULL AND event_id IS NOT NULL),
        a AS (SELECT run_no, count(*) AS n_rows, max(ts) AS hw_modified FROM r GROUP BY run_no)
        SELECT CAST(a.run_no AS BIGINT) AS run_no, CAST(a.n_rows AS BIGINT) AS n_rows,
               CAST(0 AS BIGINT) AS n_failed, a.hw_modified,
               (SELECT max(r.event_id) FROM r WHERE r.run_no = a.run_no AND r.ts = a.hw_modified) AS hw_id
        FROM a""",
    "retry_failures": f"""
        SELECT {SRC} FROM events
        WHERE ts > TIMESTAMP '2024-01-15 00:00:00' OR event_type = 'error'""",
    "record_hash": """
        SELECT event_id AS ID, sha1(coalesce(CAST(event_id AS VARCHAR), '') ||
            coalesce(CAST(user_id AS VARCHAR), '') || coalesce(event_type, '') ||
            coalesce(props, '') || coalesce(CAST(ts AS VARCHAR), '')) AS RECORD_HASH
        FROM events""",
    "safe_record_hash": f"""
        SELECT event_id AS ID, sha1(concat_ws('|', {", ".join(_escaped(c) for c in EVENT_KEYS)}))
               AS SAFE_HASH
        FROM events""",
    "key_text": """
        SELECT event_id AS ID, concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
            event_type, props, CAST(ts AS VARCHAR)) AS CALCULATED_HASH FROM events""",
    "apply_mapping": """
        SELECT event_id AS ID, CAST(user_id AS VARCHAR) AS POLICY_ID, CAST(ts AS VARCHAR) AS MODIFIED
        FROM events""",
    "json_full": f"SELECT {SRC} FROM events",
    "json_projected": "SELECT ts AS MODIFIED FROM events",
    "batch_report": """
        SELECT CAST((rn - 1) // 100 + 1 AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_files,
               CAST(sum(size) AS BIGINT) AS n_bytes
        FROM (SELECT row_number() OVER (ORDER BY doc_id) AS rn, strlen(text) AS size FROM documents)
        GROUP BY 1""",
    "ordered_first_n": f"SELECT {SRC} FROM events ORDER BY ts, event_id LIMIT 100",
    "key_derivation": """
        SELECT page_id, split_part(url, '/', 3) AS bucket,
               array_to_string(string_split(url, '/')[4:], '/') AS prefix,
               array_to_string(string_split(url, '/')[4:], '/') || '/binder_' || CAST(page_id AS VARCHAR) || '.pdf' AS object_key,
               replace(url, 'https://', '') AS stripped,
               'downloads/' || replace(array_to_string(string_split(url, '/')[4:], '/'), '/', '') AS local_path
        FROM pages""",
    "registry_append": f"""
        SELECT d.doc_id AS id, {_guid(DOC_KEY)} AS guid, {DOC_KEY} AS filename, {BODY_FACTS},
               false AS uploaded_to_s3
        FROM documents d""",
    "mark_uploaded": f"""
        SELECT d.doc_id AS id, ({UPLOADED} OR d.lang <> 'de') AS uploaded_to_s3 FROM documents d""",
    "latest_per_key": """
        SELECT user_id AS POLICY_ID, ts AS MODIFIED, event_id AS ID, event_type AS COMPANY
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) WHERE rn = 1""",
    "run_report": """
        WITH latest AS (
            SELECT user_id, props
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                  FROM events) WHERE rn = 1)
        SELECT CAST(1 AS BIGINT) AS run, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(count(*) AS BIGINT) AS n_ok, CAST(0 AS BIGINT) AS n_skipped,
               CAST(0 AS BIGINT) AS n_failed, CAST(sum(strlen(props)) AS BIGINT) AS bytes_written,
               CAST(count(DISTINCT user_id) AS BIGINT) AS n_policies
        FROM latest
        UNION ALL
        SELECT CAST(2 AS BIGINT), CAST(count(*) AS BIGINT), CAST(0 AS BIGINT),
               CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
               CAST(count(DISTINCT user_id) AS BIGINT)
        FROM latest""",
    "transform_hook": """
        SELECT event_id AS ID, concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
            event_type, props, CAST(ts AS VARCHAR)) AS CALCULATED_HASH FROM events""",
    "compact_registry": f"""
        WITH q AS (SELECT doc_id, max(coalesce(quality, 0)) AS quality FROM labels GROUP BY doc_id),
        r AS (SELECT d.*, q.quality FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id WHERE strlen(d.text) > 0)
        SELECT {NESTED_KEY} AS key, {BODY_FACTS},
               (SELECT count(*) FROM r WHERE quality = 0)::BIGINT AS n_first,
               (SELECT count(*) FROM r WHERE quality <> 0)::BIGINT AS n_second
        FROM r d WHERE quality IS NULL""",
    "hook_once": """
        WITH latest AS (SELECT user_id FROM events GROUP BY user_id)
        SELECT sink, n_rows, n_evaluated FROM (
            SELECT 'json' AS sink, count(*) AS n_rows, count(*) AS n_evaluated FROM events
            UNION ALL SELECT 'json_projected', count(*), count(*) FROM events
            UNION ALL SELECT 'objects', (SELECT count(*) FROM latest), count(*) FROM events)""",
    "chunked_bodies": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS},
               greatest((strlen(d.text) + 1023) // 1024, 1)::BIGINT AS n_chunks FROM documents d""",
    "stream_ingest": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS} FROM documents d WHERE strlen(d.text) > 0""",
    "stream_registry": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS} FROM documents d WHERE strlen(d.text) > 0""",
    "stream_retry": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS},
               CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 2 ELSE 1 END::BIGINT AS n_rows
        FROM documents d WHERE strlen(d.text) > 0""",
    "load_new_objects": f"""
        SELECT {NESTED_KEY} AS key, {BODY_FACTS} FROM documents d
        WHERE NOT {LABELLED} AND strlen(d.text) > 0""",
}
