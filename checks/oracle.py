"""DuckDB SQL for each query, written from the raw columns without going through a parse result."""

from __future__ import annotations

_UPSERT = """
            SELECT document_id, coalesce(t.source_name, s.source_name) AS source_name, coalesce(t.source_type, s.source_type) AS source_type,
                   coalesce(t.original_path, s.original_path) AS original_path,
                   CASE WHEN s.k THEN s.staging_path ELSE t.staging_path END AS staging_path,
                   coalesce(t.file_name, s.file_name) AS file_name,
                   CASE WHEN s.k THEN s.file_size_bytes ELSE t.file_size_bytes END AS file_size_bytes,
                   CASE WHEN s.k THEN s.content_hash ELSE t.content_hash END AS content_hash,
                   CASE WHEN s.k THEN s.sync_status ELSE t.sync_status END AS sync_status,
                   CASE WHEN s.k THEN s.sync_error ELSE t.sync_error END AS sync_error,
                   CASE WHEN s.k THEN s.synced_at ELSE t.synced_at END AS synced_at,
                   coalesce(t.registered_at, s.registered_at) AS registered_at,
                   CASE WHEN s.k THEN s.pipeline_run_id ELSE t.pipeline_run_id END AS pipeline_run_id
            FROM registry t FULL JOIN (SELECT *, true AS k FROM resync) s USING (document_id)"""

_CTES = {
    "modes": """
        SELECT doc_id, text, '/' || source || '/' || doc_id || '.txt' AS source_path, 'run_' || lang AS pipeline_run_id, mode,
               CASE WHEN mode = 'raise' OR doc_id % 3 <> 0 THEN 2 END AS odd
        FROM documents CROSS JOIN (VALUES ('raise'), ('null')) m(mode)""",
    "files": """
        SELECT d.doc_id, d.lang, d.n_chars, d.source AS source_name,
               ['volume', 'sharepoint', 'google_drive', 'adls'][(d.doc_id % 4 + 1)::INT] AS source_type,
               '/' || d.source || '/' || d.doc_id || '.txt' AS original_path,
               'doc_' || (d.doc_id // 2) || '.txt' AS file_name,
               strlen(d.text)::BIGINT AS file_size_bytes, md5(d.text) AS content_hash,
               'run_' || d.lang AS pipeline_run_id,
               TIMESTAMP '2024-01-01' + to_seconds(d.doc_id // 10) AS synced_at,
               l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "registry": """
        SELECT md5(source_name || ':' || original_path) AS document_id, source_name, source_type, original_path,
               CASE WHEN toxic IS DISTINCT FROM 1 THEN original_path END AS staging_path,
               file_name, file_size_bytes,
               CASE WHEN toxic IS DISTINCT FROM 1 THEN content_hash END AS content_hash,
               CASE WHEN toxic IS DISTINCT FROM 1 THEN 'synced' ELSE 'failed' END AS sync_status,
               CASE WHEN toxic = 1 THEN 'unreadable' END AS sync_error,
               CAST(synced_at AS VARCHAR) AS synced_at, CAST(synced_at AS VARCHAR) AS registered_at, pipeline_run_id
        FROM files""",
    "raw": """
        SELECT source_name, staging_path AS source_path, file_name, file_size_bytes, pipeline_run_id
        FROM registry WHERE sync_status = 'synced'""",
    "log": """
        SELECT md5(original_path) AS document_id, source_name, original_path AS source_path, file_name, status,
               (doc_id // 40 + 1)::INT AS batch_id,
               CASE WHEN status = 'processing' THEN 0 ELSE 1 END::INT AS attempt_number,
               CASE WHEN status = 'failed' THEN 'no text' END AS error_message,
               CASE WHEN status = 'completed' THEN 7 END::INT AS elements_extracted,
               CASE WHEN status = 'completed' THEN 1 END::INT AS pages_parsed,
               CASE WHEN status = 'completed' THEN n_chars END AS parse_duration_ms,
               synced_at AS started_at,
               CASE WHEN status <> 'processing' THEN synced_at + INTERVAL 60 SECOND END AS completed_at,
               pipeline_run_id, doc_id
        FROM (SELECT *, CASE WHEN toxic = 1 THEN 'processing' WHEN quality = 0 THEN 'failed'
                             ELSE 'completed' END AS status FROM files)""",
    "lines": """
        SELECT doc_id, lang, source, len(ls) AS n, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS i
        FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents)""",
    "docs": """
        SELECT doc_id, source AS source_name, '/' || source || '/' || doc_id || '.txt' AS source_path,
               'doc_' || (doc_id // 2) || '.txt' AS file_name,
               TIMESTAMP '2024-01-01' + to_seconds(doc_id // 10) AS parsed_at, 'run_' || lang AS pipeline_run_id
        FROM documents""",
    "errors": "SELECT doc_id, (i // 12)::INT AS page_id FROM lines WHERE length(x) > 1000",
    "all_elements": """
        SELECT d.*, (l.i)::INT AS element_id,
               CASE WHEN i = 0 THEN 'title' WHEN i % 11 = 10 THEN 'figure' WHEN i % 7 = 6 THEN 'table'
                    ELSE 'text' END AS element_type,
               CASE WHEN i % 11 <> 10 THEN x END AS content,
               CASE WHEN i % 11 = 10 THEN left(x, 40) END AS ai_description,
               CASE WHEN i % 13 = 12 THEN 0 WHEN i % 9 = 8 THEN 2 ELSE 1 END AS boxes,
               i, 50 + least(length(x), 500) AS r
        FROM lines l JOIN docs d ON l.doc_id = d.doc_id""",
    "elements": """
        SELECT e.source_name, e.source_path, e.file_name, element_id, element_type, content, ai_description,
               '[{"coord":[50,' || (40 + i % 12 * 60) || ',' || r || ',' || (80 + i % 12 * 60) || '],"page_id":'
                 || (i // 12) || '}' || CASE WHEN boxes = 2 THEN ',{"coord":[50,40,' || r || ',80],"page_id":'
                 || (i // 12 + 1) || '}' ELSE '' END || ']' AS bounding_box_json,
               (i // 12 + b)::INT AS page_id, b::INT AS bbox_index, 50::INT AS bbox_x1,
               (CASE WHEN b = 0 THEN 40 + i % 12 * 60 ELSE 40 END)::INT AS bbox_y1, r::INT AS bbox_x2,
               (CASE WHEN b = 0 THEN 80 + i % 12 * 60 ELSE 80 END)::INT AS bbox_y2,
               e.doc_id IN (SELECT doc_id FROM errors) AS has_parse_errors, parsed_at, pipeline_run_id
        FROM all_elements e JOIN (VALUES (0), (1)) v(b) ON b < boxes""",
    "doc_pages": """
        SELECT d.*, p::INT AS page_number, '/img/' || d.doc_id || '/' || p || '.png' AS image_uri
        FROM (SELECT doc_id, unnest(range(max(i) // 12 + 1)) AS p FROM lines GROUP BY doc_id) g
        JOIN docs d ON g.doc_id = d.doc_id""",
    "pages_": """
        SELECT p.source_name, p.source_path, p.file_name, page_number, image_uri,
               p.doc_id IN (SELECT doc_id FROM errors) AS has_parse_errors,
               e.page_id IS NOT NULL AS page_has_error, parsed_at, pipeline_run_id
        FROM doc_pages p LEFT JOIN errors e ON p.doc_id = e.doc_id AND p.page_number = e.page_id""",
    "text_elements": """
        SELECT source_name, source_path, file_name, i::INT AS element_id,
               CASE WHEN i = 0 THEN 'title' ELSE 'text' END AS element_type, x AS content,
               (i // 12)::INT AS page_id, 0::INT AS bbox_index, (40 + i % 12 * 60)::INT AS bbox_y1,
               (50 + least(length(x), 500))::INT AS bbox_x2,
               '[{"coord":[50,' || (40 + i % 12 * 60) || ',' || (50 + least(length(x), 500)) || ','
                 || (80 + i % 12 * 60) || '],"page_id":' || (i // 12) || '}]' AS bounding_box_json, lang
        FROM lines l JOIN docs d ON l.doc_id = d.doc_id""",
    "before": """
        SELECT original_path AS source_path,
               CASE WHEN quality = 0 THEN md5(content_hash || '1') ELSE content_hash END AS content_hash
        FROM files WHERE quality IS NOT NULL""",
    "new_docs": """
        SELECT * FROM registry r WHERE sync_status = 'synced'
        AND CASE WHEN EXISTS (SELECT 1 FROM before b WHERE b.source_path = r.staging_path)
            THEN NOT EXISTS (SELECT 1 FROM before b WHERE b.source_path = r.staging_path AND b.content_hash = r.content_hash)
            ELSE NOT EXISTS (SELECT 1 FROM before b WHERE b.content_hash = r.content_hash) END""",
    "blobs": """
        SELECT source || '/' || lang || '/' || doc_id || '.' || ['pdf', 'PDF', 'docx', 'txt'][(doc_id % 4 + 1)::INT] AS name,
               CASE WHEN n_chars < 50 THEN 0 ELSE n_chars END AS size
        FROM documents""",
    "tree_files": """
        SELECT 'f' || doc_id AS id, source, lang, mime, ending,
               CASE WHEN ending = '' OR suffix(name, ending) THEN name ELSE name || ending END AS file_name,
               CASE WHEN contains(mime, 'google-apps') THEN 0 ELSE n_chars END AS size
        FROM (SELECT doc_id, source, lang, n_chars, mime,
                     'Doc ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.docx' ELSE '' END AS name,
                     CASE mime WHEN 'application/vnd.google-apps.document' THEN '.docx'
                               WHEN 'application/vnd.google-apps.presentation' THEN '.pptx' ELSE '' END AS ending
              FROM (SELECT *, ['application/pdf', 'application/vnd.google-apps.document', 'image/png',
                               'application/vnd.google-apps.presentation', 'application/zip'][(doc_id % 5 + 1)::INT] AS mime
                    FROM documents))
        WHERE mime <> 'application/zip'""",
    "library": """
        SELECT CASE WHEN lang = 'fr' THEN '' ELSE source || '/' || lang END AS parent_path,
               source || '_' || doc_id || '.PDF' AS name, n_chars AS size
        FROM documents""",
    "per_type": "SELECT file_name, element_type, count(*) AS cnt FROM elements GROUP BY ALL",
    "type_text": """
        SELECT file_name, string_agg(element_type || '=' || cnt, ';' ORDER BY element_type) AS element_types
        FROM per_type GROUP BY file_name""",
    "batched": """
        SELECT *, row_number() OVER (ORDER BY file_size_bytes DESC, source_path) AS rn, count(*) OVER () AS total FROM raw""",
    "html": """
        SELECT page_id, url, unnest(tags) AS t, unnest(bodies) AS b, coalesce(unnest(images), '') AS g,
               generate_subscripts(tags, 1) - 1 AS pos
        FROM (SELECT page_id, url, regexp_extract_all(html, pat, 1) AS tags, regexp_extract_all(html, pat, 2) AS bodies,
                     regexp_extract_all(html, pat, 3) AS images
              FROM (SELECT *, '(?s)<(title|h1|p|li|footer|table)(?:\\s[^>]*)?>(.*?)</(?:title|h1|p|li|footer|table)>|<(img)(?:\\s[^>]*)?>' AS pat
                    FROM pages))""",
    "html_parts": """
        SELECT page_id, url, pos::INT AS pos, CASE WHEN g = 'img' THEN 'img' ELSE t END AS tag,
               CASE WHEN g = 'img' THEN 'figure' WHEN t IN ('title', 'h1') THEN 'title'
                    WHEN t IN ('table', 'footer') THEN t ELSE 'text' END AS element_type,
               CASE WHEN g <> 'img' THEN b END AS body
        FROM html""",
    "list_rows": """
        SELECT file_name, source_name, source_path, total_elements, coalesce(page_numbers, 0) AS total_pages,
               coalesce(last_status, 'unknown') AS status, first_parsed AS parsed_at, element_types, newest AS latest
        FROM (SELECT file_name, source_name, source_path, count(DISTINCT element_id) AS total_elements,
                     CAST(min(parsed_at) AS VARCHAR) AS first_parsed FROM elements GROUP BY ALL)
        LEFT JOIN (SELECT file_name, count(DISTINCT page_number) AS page_numbers FROM pages_ GROUP BY ALL) USING (file_name)
        LEFT JOIN (SELECT file_name, max(status) AS last_status,
                          arg_max(status, CAST(started_at AS VARCHAR) || pipeline_run_id || source_path) AS newest
                   FROM log GROUP BY ALL) USING (file_name)
        LEFT JOIN type_text USING (file_name)""",
    "stats": """
        SELECT 'documents' AS metric, '' AS name, count(DISTINCT file_name) AS value FROM elements
        UNION ALL SELECT 'elements', '', count(*) FROM elements
        UNION ALL SELECT 'pages', '', count(*) FROM pages_
        UNION ALL SELECT 'completed', '', count(DISTINCT file_name) FROM log WHERE status = 'completed'
        UNION ALL SELECT 'failed', '', count(DISTINCT file_name) FROM log WHERE status = 'failed'
        UNION ALL SELECT 'type', element_type, count(*) FROM elements GROUP BY 2
        UNION ALL SELECT 'source', source_name, count(DISTINCT file_name) FROM elements GROUP BY 2""",
    "dims": "SELECT DISTINCT file_name, page_number, 612::INT AS page_width, 792::INT AS page_height FROM doc_pages",
    "boxes": """
        SELECT e.source_path, e.page_id, element_id, bbox_index, bbox_x1, bbox_y1, bbox_x2, bbox_y2,
               d.page_number IS NOT NULL AS known
        FROM elements e LEFT JOIN doc_pages d ON e.source_path = d.source_path AND e.page_id = d.page_number""",
    "extent": """
        SELECT *, greatest(max_y, page_width / 0.75::DOUBLE) AS page_height
        FROM (SELECT *, greatest(max_x, max_y * 0.75::DOUBLE) * 1.02::DOUBLE AS page_width
              FROM (SELECT source_path, page_id, greatest(max(bbox_x2), 1)::DOUBLE AS max_x,
                           greatest(max(bbox_y2), 1)::DOUBLE AS max_y FROM elements GROUP BY 1, 2))""",
    "resync": """
        SELECT md5(source_name || ':' || original_path) AS document_id, source_name, source_type, original_path,
               CASE WHEN NOT failed THEN original_path END AS staging_path, file_name, file_size_bytes,
               CASE WHEN NOT failed THEN content_hash END AS content_hash,
               CASE WHEN failed THEN 'failed' ELSE 'synced' END AS sync_status,
               CASE WHEN failed THEN 'gone' END AS sync_error,
               '2024-01-02 00:00:00' AS synced_at, '2024-01-02 00:00:00' AS registered_at, 'run_resync' AS pipeline_run_id
        FROM (SELECT source_name, 'volume' AS source_type, original_path, 'renamed_' || file_name AS file_name,
                     file_size_bytes + 1 AS file_size_bytes, md5(content_hash || '2') AS content_hash,
                     quality = 0 AS failed FROM files WHERE quality IS NOT NULL
              UNION ALL SELECT 'web', 'adls', url, 'page_' || page_id || '.html', strlen(html), md5(html), false FROM pages)""",
}

# CTEs each one builds on.
_NEEDS = {
    "registry": ["files"],
    "raw": ["registry"],
    "log": ["files"],
    "errors": ["lines"],
    "all_elements": ["lines", "docs"],
    "elements": ["all_elements", "errors"],
    "doc_pages": ["lines", "docs"],
    "pages_": ["doc_pages", "errors"],
    "text_elements": ["lines", "docs"],
    "before": ["files"],
    "new_docs": ["registry", "before"],
    "per_type": ["elements"],
    "type_text": ["per_type"],
    "batched": ["raw"],
    "html_parts": ["html"],
    "list_rows": ["elements", "pages_", "log", "type_text"],
    "stats": ["elements", "pages_", "log"],
    "dims": ["doc_pages"],
    "boxes": ["elements", "doc_pages"],
    "extent": ["elements"],
    "resync": ["files"],
}


def _with(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n]})" for n in order) + " " + body


_STAMPED = "CAST(parsed_at AS VARCHAR) AS parsed_at"
_LOG_COLUMNS = """document_id, source_name, source_path, file_name, {status} AS status, batch_id, {attempt} AS attempt_number,
    {error} AS error_message, elements_extracted, pages_parsed, parse_duration_ms,
    CAST(completed_at AS VARCHAR) AS completed_at, pipeline_run_id"""
_ABFSS = "'abfss://docs@acct.dfs.core.windows.net/' || name AS original_path, regexp_extract(name, '[^/]*$') AS file_name, size AS file_size_bytes"
_TREE = "'gdrive://' || id AS original_path, file_name, size AS file_size_bytes"
_LIBRARY = "parent_path || '/' || name AS original_path, name AS file_name, size AS file_size_bytes"
_ROW = "source_path, element_id, bbox_index, element_type, page_id, pipeline_run_id"
_LAYOUT = "element_id, element_type, content, page_id, bbox_y1, bbox_x2, bounding_box_json"
_AGAIN = f"""SELECT {_ROW} FROM elements WHERE pipeline_run_id <> 'run_fr'
    UNION ALL SELECT source_path, element_id, bbox_index, element_type, page_id, 'run_fr_again' FROM text_elements WHERE lang = 'fr'"""
_LIST = "file_name, source_name, source_path, total_elements, total_pages, status, parsed_at, element_types"
_BALANCE = "SELECT {batch} AS batch_id, count(*) AS documents, sum(file_size_bytes)::BIGINT AS total_bytes FROM batched GROUP BY 1"


def _round_robin(size: int) -> str:
    return f"((rn - 1) % greatest(1, ceil(total / {size})::BIGINT) + 1)::INT"


def _clamped(width: str, height: str, scale_x: str, scale_y: str) -> str:
    return f"""
        SELECT source_path, page_id, element_id, bbox_index, round(l * {scale_x} / w, 6) AS box_x,
               round(t * {scale_y} / h, 6) AS box_y, round((least(greatest(bbox_x2, l), w) - l) * {scale_x} / w, 6) AS box_width,
               round((least(greatest(bbox_y2, t), h) - t) * {scale_y} / h, 6) AS box_height
        FROM (SELECT *, least(greatest(bbox_x1, 0), w) AS l, least(greatest(bbox_y1, 0), h) AS t
              FROM (SELECT *, {width} AS w, {height} AS h FROM {{source}}))
        WHERE least(greatest(bbox_x2, l), w) > l AND least(greatest(bbox_y2, t), h) > t"""


def all_sql() -> dict[str, str]:
    return {
        # Sources
        "src2_name_patterns": _with(["blobs"], """
            SELECT name, lower(name) LIKE '%.pdf' OR lower(name) LIKE '%.docx' AS any_of, false AS upper_any_of,
                   lower(name) LIKE '%.pdf' AS suffix, lower(name) LIKE 'src1%' AS prefix,
                   regexp_full_match(name, 'src[0-4]/.*') AS class,
                   regexp_full_match(name, 'src[^0-4].*/e./.*') AS negated, true AS all FROM blobs"""),
        "src3_blob_manifest": _with(["blobs"], f"SELECT {_ABFSS} FROM blobs WHERE size <> 0 AND regexp_matches(lower(name), '\\.(pdf|docx)$')"),
        "src3_blob_manifest_roots": _with(["blobs"], f"""
            SELECT {_ABFSS} FROM blobs JOIN (VALUES ('src1/'), ('src1/en/'), ('src2/en/')) r(root) ON starts_with(name, root) WHERE size <> 0"""),
        "src3_blob_manifest_flat": _with(["blobs"], f"SELECT {_ABFSS} FROM blobs WHERE size <> 0 AND starts_with(name, 'src1/en/')"),
        "src4_tree_manifest": _with(["tree_files"], f"SELECT {_TREE}, mime AS mime_type FROM tree_files WHERE regexp_matches(lower(file_name), '\\.(pdf|docx|pptx)$')"),
        "src4_tree_manifest_roots": _with(["tree_files"], f"""
            SELECT {_TREE} FROM tree_files UNION ALL SELECT {_TREE} FROM tree_files WHERE source = 'src3'
            UNION ALL SELECT {_TREE} FROM tree_files WHERE source = 'src3' AND lang = 'en'"""),
        "src5_library_manifest": _with(["library"], f"SELECT {_LIBRARY} FROM library"),
        "src5_library_manifest_folders": _with(["library"], f"""
            SELECT {_LIBRARY} FROM library WHERE starts_with(parent_path, 'src1/')
            UNION ALL SELECT {_LIBRARY} FROM library WHERE parent_path = 'src1/en'"""),
        "src5_library_manifest_flat": _with(["library"], f"SELECT {_LIBRARY} FROM library WHERE parent_path IN ('', 'src2/de')"),
        "src8_strip_scheme": "SELECT page_id, 'dbfs:' || url AS path FROM pages",
        "src9_staging_paths": _with(["files"], """
            , old AS (SELECT source_name, original_path, '/old' || original_path AS path,
                             CASE WHEN quality = 1 THEN lang || '.txt' ELSE 'old.txt' END AS name
                      FROM files WHERE quality IS NOT NULL),
            ranked AS (SELECT f.*, f.lang || '.txt' AS name, o.path AS old_path, o.name AS old_name,
                              (row_number() OVER (PARTITION BY f.source_name, f.lang ORDER BY f.original_path) = 1)
                              AND NOT EXISTS (SELECT 1 FROM old x WHERE x.source_name = f.source_name AND x.name = f.lang || '.txt') AS free
                       FROM files f LEFT JOIN old o ON f.source_name = o.source_name AND f.original_path = o.original_path),
            named AS (SELECT *, coalesce(old_name, CASE WHEN free THEN name ELSE lang || '_' || content_hash[1:8] || '.txt' END) AS wanted FROM ranked),
            given AS (SELECT *, CASE WHEN old_name IS NOT NULL THEN wanted
                                     WHEN row_number() OVER (PARTITION BY source_name, wanted, old_name IS NULL ORDER BY original_path) = 1
                                          AND NOT EXISTS (SELECT 1 FROM old x WHERE x.source_name = named.source_name AND x.name = named.wanted) THEN wanted
                                     ELSE lang || '_' || content_hash[1:8] || '_' || md5(original_path)[1:8] || '.txt' END AS final
                      FROM named)
            SELECT source_name, original_path, coalesce(old_path, '/staging/' || source_name || '/' || final) AS staging_path,
                   final AS file_name FROM given"""),
        # Registry
        "src10_load_raw": _with(["raw"], """
            SELECT source_name, source_path, file_name, file_size_bytes,
                   CASE WHEN NOT suffix(source_path, '7.txt') THEN strlen('content of ' || source_path) END AS bytes,
                   CASE WHEN NOT suffix(source_path, '7.txt') THEN md5('content of ' || source_path) END AS content_hash,
                   '2024-03-01 00:00:00' AS ingested_at, 'run_load' AS pipeline_run_id,
                   CASE WHEN suffix(source_path, '7.txt') THEN 'gone' END AS read_error
            FROM raw"""),
        "run5_stage_with_isolation": _with(["files"], """
            SELECT source_name, original_path, CASE WHEN NOT bad THEN original_path END AS staging_path, file_name,
                   CASE WHEN bad THEN file_size_bytes ELSE strlen('content of ' || original_path) END AS file_size_bytes,
                   CASE WHEN NOT bad THEN md5('content of ' || original_path) END AS content_hash, CASE WHEN bad THEN 'gone' END AS sync_error
            FROM (SELECT *, suffix(original_path, '7.txt') AS bad FROM files)"""),
        "snk5_registry_upsert": _with(["registry", "resync"], _UPSERT),
        "snk5_registry_log": _with(["registry", "resync"], _UPSERT),
        "snk6_dedupe_latest": _with(["registry"], """
            SELECT content_hash, document_id, source_name, synced_at, sync_error
            FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY synced_at DESC, document_id DESC) AS rn FROM registry)
            WHERE rn = 1"""),
        "snk7_replace_documents": _with(["elements", "text_elements"], _AGAIN),
        "snk7_current_rows": _with(["elements", "text_elements"], _AGAIN),
        "snk7_superseded_rows": _with(["elements", "text_elements"], _AGAIN),
        "prj1_document_ids": """
            SELECT doc_id, md5(source || ':/' || source || '/' || doc_id || '.txt') AS registry_id,
                   md5('/' || source || '/' || doc_id || '.txt') AS log_id FROM documents""",
        "prj2_content_hash": "SELECT doc_id, md5(text) AS md5_hash, sha256(text) AS sha256_hash, '' AS unreadable_hash FROM documents",
        "prj3_registry_rows": _with(["registry"], """
            SELECT * REPLACE (CASE WHEN sync_error IS NOT NULL THEN left(repeat('unreadable ', 200), 1000) END AS sync_error,
                              '2024-03-01 00:00:00' AS synced_at, '2024-03-01 00:00:00' AS registered_at, 'run_1' AS pipeline_run_id)
            FROM registry"""),
        "prj4_synced_in_run": _with(["registry"], """
            SELECT document_id, staging_path, pipeline_run_id FROM registry WHERE sync_status = 'synced' AND pipeline_run_id = 'run_en'"""),
        "prj6_open_log": _with(["raw"], """
            SELECT md5(source_path) AS document_id, source_name, source_path, file_name, 'queued' AS status, NULL::INT AS batch_id,
                   0::INT AS attempt_number, NULL::VARCHAR AS error_message, NULL::INT AS elements_extracted,
                   NULL::INT AS pages_parsed, NULL::BIGINT AS parse_duration_ms, '2024-03-01 00:00:00' AS started_at,
                   NULL::VARCHAR AS completed_at, pipeline_run_id FROM raw"""),
        # Incremental filter
        "jon1_not_yet_parsed_registry_hash": _with(["registry", "before"], """
            SELECT document_id, staging_path, content_hash, pipeline_run_id FROM registry r
            WHERE sync_status = 'synced' AND NOT EXISTS (
              SELECT 1 FROM registry known JOIN before ON before.source_path = known.staging_path
              WHERE known.content_hash = r.content_hash)"""),
        "jon2_not_yet_parsed_parsed_hash": _with(["new_docs"], "SELECT document_id, staging_path, content_hash, pipeline_run_id FROM new_docs"),
        "jon2_one_per_content": _with(["new_docs"], "SELECT min(staging_path) AS staging_path, content_hash FROM new_docs GROUP BY content_hash"),
        "set2_distinct_hashes": _with(["registry"], "SELECT DISTINCT content_hash FROM registry WHERE content_hash IS NOT NULL"),
        "set1_union_of_roots": _with(["blobs", "library", "tree_files"], f"""
            SELECT {_ABFSS} FROM blobs WHERE size <> 0 AND lower(name) LIKE '%.pdf' UNION ALL SELECT {_LIBRARY} FROM library
            UNION ALL SELECT {_TREE} FROM tree_files WHERE lower(file_name) LIKE '%.pdf'"""),
        # Payload to rows
        "flt1_flatten_elements": _with(["elements"], f"SELECT * REPLACE ({_STAMPED}) FROM elements"),
        "flt1_flatten_elements_outer": _with(["elements"], f"""
            SELECT {_ROW}, bbox_x1, bounding_box_json FROM elements
            UNION ALL SELECT source_path, element_id, NULL, element_type, NULL, pipeline_run_id, NULL, '[]' FROM all_elements WHERE boxes = 0"""),
        "flt2_flatten_pages": _with(["pages_"], f"SELECT * REPLACE ({_STAMPED}) FROM pages_"),
        "flt2_flatten_pages_distinct": _with(["pages_"], f"SELECT DISTINCT * REPLACE ({_STAMPED}) FROM pages_"),
        "flt2_flatten_pages_by_path": _with(["pages_"], f"SELECT * REPLACE ({_STAMPED}) FROM pages_"),
        "flt1_mixed_payloads": _with(["modes"], """
            SELECT mode, source_path, e.id AS element_id, e.type AS element_type, CASE WHEN e.item = 0 THEN text END AS content,
                   e.description AS ai_description, b.page_id, b.pos::INT AS bbox_index,
                   b.x1 AS bbox_x1, b.y1 AS bbox_y1, CASE WHEN e.item = 0 THEN doc_id END::INT AS bbox_x2, CASE WHEN e.item = 0 THEN 4 END::INT AS bbox_y2,
                   doc_id % 4 > 1 AS has_parse_errors
            FROM modes
            CROSS JOIN (VALUES (0, 7, '3', NULL), (1, NULL, NULL, NULL), (2, NULL, NULL, NULL), (3, NULL, NULL, NULL), (4, NULL, NULL, NULL),
                               (5, 5, '{"a":1}', NULL), (6, 8, NULL, NULL), (7, -1, NULL, '[1,2]')) v(item, fixed, type, description)
            CROSS JOIN LATERAL (SELECT v.item, CASE WHEN v.fixed = -1 THEN odd ELSE v.fixed END::INT AS id, v.type, v.description) e
            LEFT JOIN (VALUES (0, 0, 2, 1, 2), (7, 0, NULL, NULL, NULL), (7, 1, 0, NULL, NULL), (7, 2, NULL, 9, 8), (7, 3, NULL, NULL, NULL))
                b(item, pos, page_id, x1, y1) ON b.item = e.item"""),
        "flt2_mixed_payloads": _with(["modes"], """
            SELECT mode, source_path, n::INT AS page_number, CASE n WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN '{"u":1}' ELSE uri END AS image_uri,
                   doc_id % 4 > 1 AS has_parse_errors, doc_id % 4 > 1 AND n IS NOT NULL AS page_has_error
            FROM modes CROSS JOIN (VALUES (0, NULL), (NULL, NULL), (1, NULL), (NULL, 'z')) p(n, uri)"""),
        "flt3_mixed_payloads": _with(["modes"], """
            SELECT mode, source_path, CASE k WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN odd END::INT AS page_id, pipeline_run_id
            FROM modes CROSS JOIN range(4) r(k) WHERE doc_id % 4 > 1"""),
        "flt3_flatten_errors": _with(["errors", "docs"], "SELECT source_path, page_id, pipeline_run_id FROM errors JOIN docs USING (doc_id)"),
        "flt4_payload_sizes": _with(["lines", "docs"], """
            SELECT source_path, pipeline_run_id, count(*)::INT AS elements_extracted, (max(i) // 12 + 1)::INT AS pages_parsed
            FROM lines l JOIN docs d ON l.doc_id = d.doc_id GROUP BY 1, 2"""),
        "flt5_page_dimensions": _with(["dims"], "SELECT * FROM dims"),
        # Extractors
        "udf1_parse_documents_text": _with(["text_elements"], f"SELECT source_path, {_LAYOUT} FROM text_elements"),
        "udf1_parse_documents_python": _with(["text_elements"], f"SELECT source_path, {_LAYOUT} FROM text_elements"),
        "udf2_layout_from_text_sizes": _with(["docs"], """
            SELECT source_path, 'run_1' AS pipeline_run_id, n::INT AS elements_extracted, ((n - 1) // 5 + 1)::INT AS pages_parsed
            FROM docs JOIN (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents) USING (doc_id)"""),
        "udf3_layout_from_html": _with(["html_parts"], """
            SELECT page_id::VARCHAR AS file_name, pos AS element_id, element_type,
                   CASE WHEN tag = 'table' THEN '<table>' || body || '</table>' ELSE body END AS content, (pos // 12)::INT AS page_id,
                   (40 + pos % 12 * 60)::INT AS bbox_y1, (50 + coalesce(least(length(body), 500), 500))::INT AS bbox_x2,
                   '[{"coord":[50,' || (40 + pos % 12 * 60) || ',' || (50 + coalesce(least(length(body), 500), 500)) || ','
                     || (80 + pos % 12 * 60) || '],"page_id":' || (pos // 12) || '}]' AS bounding_box_json
            FROM html_parts"""),
        "udf3_html_parts": _with(["html_parts"], "SELECT page_id, pos, tag, element_type, body FROM html_parts"),
        "udf4_failed_documents": _with(["docs"], """
            SELECT source_path, CASE WHEN strlen(text) > 5000 THEN 0 ELSE len(string_split(text, chr(10))) END::INT AS elements_extracted,
                   (strlen(text) > 5000)::BIGINT AS errors FROM docs JOIN documents USING (doc_id)"""),
        "udf4_bad_encoding": _with(["docs"], """
            SELECT source_path, len(string_split(text, chr(10)))::INT AS elements, doc_id % 7 = 0 AS has_errors
            FROM docs JOIN documents USING (doc_id)"""),
        # Ranks and batches
        "win1_global_rank": _with(["batched"], "SELECT source_path, file_size_bytes, rn FROM batched"),
        "win2_round_robin_batches": _with(["batched"], f"SELECT source_path, file_size_bytes, {_round_robin(40)} AS batch_id FROM batched"),
        "win3_contiguous_batches": _with(["batched"], "SELECT source_path, file_size_bytes, ((rn - 1) // 50 + 1)::INT AS batch_id FROM batched"),
        "agg5_batch_balance": _with(["batched"], _BALANCE.format(batch=_round_robin(40))),
        "ord3_ordered_batches": _with(["batched"], _BALANCE.format(batch=_round_robin(50)) + " ORDER BY total_bytes DESC, batch_id"),
        "win4_top_types": _with(["per_type"], """
            SELECT * FROM (SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY cnt DESC, element_type)::INT AS place,
                                  element_type, cnt FROM per_type) WHERE place <= 3"""),
        # Log
        "jon4_log_transition": _with(["log"], "SELECT " + _LOG_COLUMNS.format(
            status="CASE WHEN hit THEN 'failed' ELSE status END",
            attempt="(CASE WHEN hit THEN 3 ELSE attempt_number END)::INT",
            error="CASE WHEN hit THEN 'it''s late' ELSE error_message END",
        ) + " FROM (SELECT *, status = 'processing' AND pipeline_run_id = 'run_en' AS hit FROM log)"),
        "jon5_apply_counts": _with(["log", "elements", "pages_"], """
            SELECT l.source_path, status, coalesce(e.n, s.n)::INT AS elements_extracted, p.n::INT AS pages_parsed, pipeline_run_id
            FROM log l
            LEFT JOIN (SELECT source_path, count(*) AS n FROM elements GROUP BY 1) e ON l.source_path = e.source_path
            LEFT JOIN (SELECT source_path, count(*) AS n FROM pages_ GROUP BY 1) p ON l.source_path = p.source_path
            LEFT JOIN (SELECT source_path, count(*) AS n FROM all_elements GROUP BY 1) s ON l.source_path = s.source_path"""),
        "run4_fold_log": _with(["log"], """
            SELECT document_id, source_name, source_path, file_name, status, batch_id, attempt_number, error_message,
                   NULL::INT AS elements_extracted, NULL::INT AS pages_parsed, parse_duration_ms,
                   CAST(started_at + INTERVAL 2 SECOND AS VARCHAR) AS started_at,
                   CAST(completed_at AS VARCHAR) AS completed_at, pipeline_run_id FROM log"""),
        "run6_retry_stats": _with(["files"], """
            SELECT pipeline_run_id, count(*) FILTER (toxic < 3) AS batches_completed, count(*) FILTER (toxic >= 3) AS batches_failed,
                   coalesce(sum(documents) FILTER (toxic < 3), 0)::BIGINT AS documents, sum(least(toxic, 3))::BIGINT AS retries
            FROM (SELECT pipeline_run_id, doc_id // 40 AS batch, count(*) AS documents, count(*) FILTER (toxic = 1) AS toxic
                  FROM files GROUP BY 1, 2) GROUP BY 1"""),
        # Aggregates
        "agg1_sync_summary": _with(["registry"], """
            SELECT source_name, sum(listed)::BIGINT AS listed, sum(synced)::BIGINT AS synced, sum(failed)::BIGINT AS failed
            FROM (SELECT source_name, 1 AS listed, (sync_status = 'synced')::INT AS synced, (sync_status = 'failed')::INT AS failed FROM registry
                  UNION ALL SELECT DISTINCT string_split(url, '/')[3], 0, 0, 1 FROM pages)
            GROUP BY ROLLUP (source_name)"""),
        "agg2_ingest_summary": _with(["new_docs"], """
            SELECT pipeline_run_id, synced, synced - coalesce(n, 0) AS already_parsed, coalesce(n, 0) AS to_process
            FROM (SELECT pipeline_run_id, count(*) AS synced FROM registry WHERE sync_status = 'synced' GROUP BY 1)
            LEFT JOIN (SELECT pipeline_run_id, count(*) AS n FROM new_docs GROUP BY 1) USING (pipeline_run_id)"""),
        "agg3_docs_per_source": _with(["raw"], "SELECT source_name, count(*) AS documents FROM raw GROUP BY 1 ORDER BY 1"),
        "agg4_total_bytes": _with(["raw"], "SELECT coalesce(sum(file_size_bytes), 0)::BIGINT AS total_bytes FROM raw"),
        "prj15_megabytes": _with(["raw"], "SELECT source_name, sum(file_size_bytes)::DOUBLE / 1048576 AS megabytes FROM raw GROUP BY 1"),
        "agg6_parse_summary": _with(["docs", "errors", "log"], """
            SELECT pipeline_run_id, parsed, failed, with_errors
            FROM (SELECT pipeline_run_id, count(*) AS parsed, count(*) FILTER (doc_id IN (SELECT doc_id FROM errors)) AS with_errors FROM docs GROUP BY 1)
            JOIN (SELECT pipeline_run_id, count(*) FILTER (status = 'failed') AS failed FROM log GROUP BY 1) USING (pipeline_run_id)"""),
        "agg7_element_rows": _with(["elements"], "SELECT source_path, pipeline_run_id, count(*) AS row_count FROM elements GROUP BY 1, 2"),
        "agg7_page_rows": _with(["pages_"], "SELECT source_path, pipeline_run_id, count(*) AS row_count FROM pages_ GROUP BY 1, 2"),
        "agg8_type_distribution": _with(["elements"], "SELECT element_type, count(*) AS cnt FROM elements GROUP BY 1 ORDER BY 2 DESC, 1"),
        "agg8_type_distribution_of_run": _with(["elements"], """
            SELECT element_type, count(*) AS cnt FROM elements WHERE pipeline_run_id = 'run_en' GROUP BY 1 ORDER BY 2 DESC, 1"""),
        "agg9_distinct_docs": _with(["elements"], "SELECT pipeline_run_id, count(DISTINCT file_name) AS documents FROM elements GROUP BY 1"),
        "agg10_status_counts": _with(["log"], """
            SELECT pipeline_run_id, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed
            FROM log GROUP BY 1"""),
        "agg11_element_rows_per_run": _with(["elements"], "SELECT pipeline_run_id, count(*) AS row_count FROM elements GROUP BY 1"),
        "agg11_page_rows_per_run": _with(["pages_"], "SELECT pipeline_run_id, count(*) AS row_count FROM pages_ GROUP BY 1"),
        "agg12_type_map": _with(["type_text"], "SELECT * FROM type_text"),
        "jon10_type_counts_of_files": _with(["per_type", "log"], """
            SELECT * FROM per_type WHERE file_name IN (SELECT file_name FROM log WHERE status = 'failed')"""),
        "agg13_status_by_file": _with(["log"], "SELECT file_name, max(status) AS status FROM log GROUP BY 1"),
        "agg13_latest_status_by_file": _with(["log"], """
            SELECT file_name, arg_max(status, CAST(started_at AS VARCHAR) || pipeline_run_id || source_path) AS status FROM log GROUP BY 1"""),
        "agg14_files_per_status": _with(["log"], "SELECT status, count(DISTINCT file_name) AS files FROM log GROUP BY 1"),
        "agg15_files_per_source": _with(["elements"], """
            SELECT source_name, count(DISTINCT file_name) AS files FROM elements GROUP BY 1 ORDER BY 2 DESC, 1"""),
        "agg16_success_rate": _with(["log"], """
            SELECT completed, failed, round(100.0::DOUBLE * completed / nullif(completed + failed, 0), 1) AS success_rate
            FROM (SELECT count(DISTINCT file_name) FILTER (status = 'completed') AS completed,
                         count(DISTINCT file_name) FILTER (status = 'failed') AS failed FROM log)"""),
        "agg17_share_of_max": _with(["elements"], """
            SELECT element_type, cnt, round(cnt * 100.0::DOUBLE / greatest(max(cnt) OVER (), 1), 6) AS share
            FROM (SELECT element_type, count(*) AS cnt FROM elements GROUP BY 1)"""),
        "agg18_page_extent": _with(["extent"], """
            SELECT source_path, page_id, round(page_width, 6) AS page_width, round(page_height, 6) AS page_height FROM extent"""),
        # Document queries
        "qry1_documents_overview": _with(["list_rows"], f"SELECT {_LIST} FROM list_rows"),
        "qry1_documents_overview_latest": _with(["list_rows"], f"""
            SELECT {_LIST.replace('status', 'latest AS status')} FROM list_rows
            WHERE lower(file_name) LIKE '%src1%' OR lower(source_name) LIKE '%src1%'"""),
        "qry1_list_documents": _with(["list_rows"], f"SELECT {_LIST} FROM list_rows ORDER BY parsed_at DESC, file_name, source_path LIMIT 25"),
        "qry1_list_documents_after": _with(["list_rows"], f"""
            SELECT {_LIST} FROM list_rows ORDER BY parsed_at DESC, file_name, source_path LIMIT 25 OFFSET 25"""),
        "qry1_list_documents_search": _with(["list_rows"], f"""
            SELECT {_LIST} FROM list_rows WHERE lower(file_name) LIKE '%c_1%5%' OR lower(source_name) LIKE '%c_1%5%'
            ORDER BY parsed_at DESC, file_name, source_path LIMIT 10 OFFSET 10"""),
        "qry1_summarized_overview": _with(["list_rows"], f"SELECT {_LIST} FROM list_rows"),
        "qry1_summarized_list_search": _with(["list_rows"], f"""
            SELECT {_LIST} FROM list_rows WHERE lower(file_name) LIKE '%c_1%5%' OR lower(source_name) LIKE '%c_1%5%'
            ORDER BY parsed_at DESC, file_name, source_path LIMIT 10 OFFSET 10"""),
        "qry1_count_documents": _with(["elements"], """
            SELECT count(DISTINCT file_name) AS total FROM elements WHERE lower(file_name) LIKE '%src_1%' OR lower(source_name) LIKE '%src_1%'"""),
        "prj11_search": _with(["registry"], """
            SELECT 'wildcard' AS how, source_name, file_name, original_path FROM registry
            WHERE lower(file_name) LIKE '%src%_7%' OR lower(source_name) LIKE '%src%_7%'
            UNION ALL SELECT 'literal', source_name, file_name, original_path FROM registry
            WHERE contains(lower(file_name), 'c_1') OR contains(lower(source_name), 'c_1')"""),
        "qry2_document_headers": _with(["elements", "pages_", "log", "type_text"], """
            SELECT file_name, source_name, source_path, total_elements, coalesce(total_pages, 0) AS total_pages, status, parsed_at, element_types
            FROM (SELECT file_name, count(*) AS total_elements FROM elements GROUP BY 1)
            JOIN type_text USING (file_name)
            LEFT JOIN (SELECT file_name, count(*) AS total_pages FROM pages_ GROUP BY 1) USING (file_name)
            LEFT JOIN (SELECT file_name, max(status) AS status, CAST(max(completed_at) AS VARCHAR) AS parsed_at,
                              max(source_name) AS source_name, max(source_path) AS source_path FROM log GROUP BY 1) USING (file_name)"""),
        "qry2_one_document": _with(["elements", "pages_", "log", "type_text"], """
            SELECT file_name, source_name, source_path, total_elements, coalesce(total_pages, 0) AS total_pages, status, parsed_at, element_types
            FROM (SELECT file_name, count(*) AS total_elements FROM elements GROUP BY 1)
            JOIN type_text USING (file_name)
            LEFT JOIN (SELECT file_name, count(*) AS total_pages FROM pages_ GROUP BY 1) USING (file_name)
            LEFT JOIN (SELECT file_name, max(status) AS status, CAST(max(completed_at) AS VARCHAR) AS parsed_at,
                              max(source_name) AS source_name, max(source_path) AS source_path FROM log GROUP BY 1) USING (file_name)
            WHERE file_name = 'doc_7.txt'"""),
        "qry2_document_pages": _with(["elements", "pages_"], """
            SELECT p.file_name, page_number, coalesce(n, 0) AS element_count FROM pages_ p
            LEFT JOIN (SELECT file_name, page_id, count(*) AS n FROM elements GROUP BY 1, 2) e
              ON p.file_name = e.file_name AND p.page_number = e.page_id
            WHERE p.file_name IN (SELECT file_name FROM elements)"""),
        "qry3_page_headers": _with(["pages_", "dims", "log"], """
            SELECT file_name, page_number, image_uri, source_path, page_width, page_height
            FROM (SELECT file_name, page_number, max(image_uri) AS image_uri FROM pages_ GROUP BY 1, 2)
            LEFT JOIN dims USING (file_name, page_number)
            LEFT JOIN (SELECT file_name, max(source_path) AS source_path FROM log GROUP BY 1) USING (file_name)"""),
        "qry3_page_elements": _with(["elements"], """
            SELECT file_name, page_id, element_id, element_type, coalesce(content, '') AS content, ai_description, bbox_x1, bbox_y1,
                   bbox_x2, bbox_y2, bounding_box_json FROM elements"""),
        "qry3_one_page": _with(["elements"], """
            SELECT file_name, page_id, element_id, element_type, coalesce(content, '') AS content, ai_description, bbox_x1, bbox_y1,
                   bbox_x2, bbox_y2, bounding_box_json FROM elements
            WHERE file_name = 'doc_7.txt' AND page_id = 0"""),
        "prj12_defaults": _with(["elements"], """
            SELECT source_path, element_id, bbox_index, coalesce(content, '') AS content, bbox_x1, bbox_y2, bounding_box_json FROM elements
            UNION ALL SELECT source_path, element_id, NULL, coalesce(content, ''), 0, 0, '[]' FROM all_elements WHERE boxes = 0"""),
        "prj13_preview": _with(["elements"], """
            SELECT source_path, element_id, bbox_index,
                   coalesce(nullif(left(content, 300), ''), nullif(left(ai_description, 300), ''), 'No content') AS panel,
                   coalesce(nullif(left(content, 200), ''), nullif(left(ai_description, 200), ''), 'No content')
                     || CASE WHEN length(content) > 200 THEN '...' ELSE '' END AS tooltip
            FROM elements"""),
        "prj14_normalized_boxes": _with(["boxes"], _clamped(
            "CASE WHEN known THEN 612 ELSE 459 END::DOUBLE", "CASE WHEN known THEN 792 ELSE 99 END::DOUBLE", "459::DOUBLE", "99::DOUBLE"
        ).format(source="boxes")),
        "prj14_normalized_boxes_joined": _with(["boxes"], _clamped(
            "CASE WHEN known THEN 612 ELSE 459 END::DOUBLE", "CASE WHEN known THEN 792 ELSE 99 END::DOUBLE", "459::DOUBLE", "99::DOUBLE"
        ).format(source="boxes")),
        "prj14_normalized_boxes_inferred": _with(["boxes", "extent"], _clamped(
            "CASE WHEN known THEN 612 ELSE page_width END::DOUBLE", "CASE WHEN known THEN 792 ELSE page_height END::DOUBLE",
            "459::DOUBLE", "612::DOUBLE"
        ).format(source="boxes JOIN extent USING (source_path, page_id)")),
        "prj16_page_neighbors": _with(["pages_"], """
            SELECT file_name, source_path, page_number, page_number > 0 AS has_previous,
                   page_number < count(*) OVER (PARTITION BY file_name) - 1 AS has_next FROM pages_"""),
        "qry4_corpus_stats": _with(["stats"], "SELECT * FROM stats"),
        "qry4_summarized_stats": _with(["stats"], "SELECT * FROM stats"),
        "qry4_merged_states": _with(["stats"], "SELECT *, true AS near FROM stats"),
        "qry4_dashboard": _with(["stats"], """
            SELECT *, round(100.0::DOUBLE * completed / nullif(completed + failed, 0), 1) AS success_rate
            FROM (SELECT max(value) FILTER (metric = 'documents') AS total_documents, max(value) FILTER (metric = 'pages') AS total_pages,
                         max(value) FILTER (metric = 'elements') AS total_elements, max(value) FILTER (metric = 'completed') AS completed,
                         max(value) FILTER (metric = 'failed') AS failed,
                         string_agg(name || '=' || value, ';' ORDER BY name) FILTER (metric = 'type') AS element_type_distribution,
                         string_agg(name || '=' || value, ';' ORDER BY name) FILTER (metric = 'source') AS source_distribution FROM stats)"""),
        "ord1_newest_documents": _with(["registry"], """
            SELECT document_id, synced_at FROM registry ORDER BY synced_at DESC, document_id LIMIT 50 OFFSET 100"""),
        "ord2_sample_elements": _with(["elements"], """
            SELECT file_name, element_id, element_type, left(content, 200) AS content_preview, page_id, bbox_index,
                   bbox_x1, bbox_y1, bbox_x2, bbox_y2, has_parse_errors
            FROM elements ORDER BY file_name, element_id, bbox_index, source_path, pipeline_run_id LIMIT 50"""),
    }
