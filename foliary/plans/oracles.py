"""DuckDB SQL for the queries of the registry, on the same Parquet tables."""

from __future__ import annotations

from ..operators.catalog import COMPRESS, CONVERT, EXECUTORS, EXTRACT, MULTI_SOURCE, PARAMETERS, PARSE, RESULTS, TASK_TYPES
from ..operators.validation import GENERATION_FILES, OCR_FILES, TRANSLATION_FILES


def _case(of: dict[str, str], what: str = "ext") -> str:
    return f"CASE {what} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in of.items()) + " END"


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_EXT = r"lower(regexp_extract(regexp_extract(regexp_extract({}, '^[^?#]*', 0), '[^/\\]*$', 0), '^.+(\.[^.]*)$', 1))"
_LINES = """l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rn FROM lineitem)"""
_SHAPES = f"""{_LINES},
s AS (SELECT l_orderkey AS slide, CAST(rn - 1 AS INTEGER) AS ord, l_partkey * 1000 AS x, l_suppkey * 10000 AS y, (1 + l_partkey % 50) * 10000 AS w, (1 + l_suppkey % 20) * 10000 AS h, 'L' || rn AS txt
      FROM l WHERE l_linenumber % 7 <> 0)"""
_KINDS = "[" + ", ".join(f"'{t}'" for t in TASK_TYPES) + "]"
_LOG = f"""log AS (SELECT user_id AS task_id, ({_KINDS})[CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % {len(TASK_TYPES)} + 1] AS type,
      CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status, ts, event_id AS seq FROM events)"""
_MANIFEST = """f AS (SELECT doc_id, source, 'doc-' || doc_id || ['.pdf', '.pptx', '.docx', '.key', '.txt'][doc_id % 5 + 1] AS name, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS hash FROM documents)"""
_LATEST = "SELECT task_id, arg_max(status, (ts, seq)) AS status, max(ts) AS ts, arg_max(seq, (ts, seq)) AS seq, count(*) AS snapshots FROM log GROUP BY task_id"

SQL = {
    "pdf_markdown": f"""
WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
t AS (SELECT doc_id, i // 20 AS page, 0 AS kind, i, {_TRIM.format("line")} AS line FROM b),
p AS (
  SELECT doc_id, page, kind, i, CASE i % 20 WHEN 0 THEN '## ' || line WHEN 1 THEN '- ' || line WHEN 19 THEN '*' || line || '*' ELSE line END AS line FROM t WHERE line <> ''
  UNION ALL SELECT doc_id, 0, 1, 0, '![img](k/' || doc_id || '.png)' FROM documents WHERE doc_id % 3 = 0
)
SELECT d.doc_id, coalesce(string_agg(p.line, chr(10) || chr(10) ORDER BY page, kind, i), '') AS markdown FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id GROUP BY d.doc_id""",
    "keynote_markdown": f"""
WITH c AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS slide FROM conversations),
t AS (SELECT conv_id, slide, 0 AS kind, unnest(range(len(string_split(text, chr(10))))) AS i, {_TRIM.format("unnest(string_split(text, chr(10)))")} AS line FROM c),
p AS (
  SELECT * FROM t WHERE line <> ''
  UNION ALL SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 1000000 ELSE slide END, 1, slide, '![img](k/' || conv_id || '-' || turn || ')' FROM c WHERE turn % 3 = 0
), g AS (SELECT conv_id, slide, string_agg(line, chr(10) ORDER BY kind, i) AS page FROM p GROUP BY ALL)
SELECT x.conv_id, coalesce(string_agg(g.page, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY g.slide), '') AS markdown
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN g ON g.conv_id = x.conv_id GROUP BY x.conv_id""",
    "docx_markdown": f"""
WITH {_LINES}
SELECT o_orderkey, '# Order ' || o_orderkey || chr(10) || chr(10) || '| line | part | qty |' || chr(10) || '| --- | --- | --- |'
       || coalesce(chr(10) || string_agg('| ' || rn || ' | ' || l_partkey || ' | ' || CAST(trunc(l_quantity) AS BIGINT) || ' |', chr(10) ORDER BY rn), '') AS markdown
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "pptx_participants": f"""
WITH {_SHAPES}, p AS (SELECT *, x // 1000 AS part FROM s),
o AS (SELECT slide, ord, CASE WHEN part % 13 = 0 THEN 0 ELSE x END AS x, CASE WHEN part % 13 = 0 THEN 0 ELSE y END AS y, CASE WHEN part % 11 = 0 THEN 0 WHEN part % 13 = 0 THEN 9000000 ELSE w END AS w,
             CASE WHEN part % 11 = 0 OR part % 17 = 0 THEN 0 WHEN part % 13 = 0 THEN 6000000 ELSE h END AS h, CASE WHEN part % 13 = 0 OR part % 5 = 0 THEN ' ' ELSE txt END AS txt FROM p)
SELECT * FROM o WHERE NOT (w <= 0 AND h <= 0) AND (trim(txt) <> '' OR NOT (x <= 0 AND y <= 0 AND w >= 8000000 AND h >= 5000000))""",
    "pptx_virtual_container": f"""
WITH {_SHAPES}
SELECT c.slide, c.ord, arg_min(m.ord, (m.w * m.h, (c.x - m.x) * (c.x - m.x) + (c.y - m.y) * (c.y - m.y), m.ord)) AS mother
FROM s c JOIN s m ON c.slide = m.slide AND m.w * m.h > c.w * c.h AND m.x < c.x + c.w AND c.x < m.x + m.w AND m.y < c.y + c.h AND c.y < m.y + m.h
GROUP BY c.slide, c.ord""",
    "pptx_rows": f"""
WITH {_SHAPES},
g AS (SELECT *, y - max(y + h) OVER (PARTITION BY slide ORDER BY y, x, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM s),
r AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap = 0 OR gap > 9000 THEN 1 ELSE 0 END) OVER (PARTITION BY slide ORDER BY y, x, ord) AS BIGINT) AS row FROM g)
SELECT slide, row, count(*) AS shapes, min(y) AS top, max(y + h) AS bottom FROM r GROUP BY ALL""",
    "html_title": r"SELECT page_id, trim(regexp_replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&amp;', '&'), '[ \t\r\f]+', ' ', 'g')) AS title FROM pages",
    "route_parse": f"SELECT page_id, {_EXT.format('url')} AS ext, 'html.getByURL' AS task_type FROM pages",
    "route_files": f"""
WITH {_MANIFEST}, e AS (SELECT doc_id, {_EXT.format("name")} AS ext FROM f)
SELECT doc_id, ext, {_case(PARSE)} AS parse, {_case(CONVERT["image"])} AS image, {_case(CONVERT["pdf"])} AS pdf, {_case(COMPRESS)} AS compress, {_case(EXTRACT)} AS extract FROM e""",
    "convert_validation": f"""
WITH {_MANIFEST}, e AS (SELECT doc_id // 3 AS job, {_EXT.format("name")} AS ext FROM f), k AS (SELECT job, {_case(CONVERT["image"])} AS kind FROM e),
g AS (SELECT job, count(*) AS files, count(kind) AS known, count(DISTINCT kind) AS kinds, min(kind) AS kind FROM k GROUP BY job),
r AS (SELECT *, CASE WHEN known < files THEN 'UNSUPPORTED_FORMAT' WHEN kinds > 1 THEN 'MIXED_CONVERSION_TYPES' WHEN files > 1 AND kind NOT IN {MULTI_SOURCE} THEN 'MULTIPLE_SOURCES' END AS error_code FROM g)
SELECT job, files, CASE WHEN error_code IS NULL THEN kind END AS task_type, error_code FROM r""",
    "task_catalog": "SELECT * FROM (VALUES "
    + ", ".join(f"('{t}', {t in MULTI_SOURCE}, '{PARAMETERS.get(t, '')}', '{RESULTS.get(t, 'file')}', '{EXECUTORS.get(t, 'none')}')" for t in TASK_TYPES)
    + ") AS t(task_type, multi_source, parameters, result, executor)",
    "file_manifest": f"WITH {_MANIFEST} SELECT doc_id, source, name, bytes, hash FROM f",
    "upload_needed": f"WITH {_MANIFEST} SELECT doc_id, name, hash FROM f WHERE hash NOT IN (SELECT hash FROM f WHERE doc_id % 2 = 0)",
    "inline_decision": f"WITH {_MANIFEST} SELECT source, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, sum(bytes) < 10485760 AS inline FROM f GROUP BY source",
    "chunk_plan": f"""
WITH {_MANIFEST}, p AS (SELECT doc_id, bytes, unnest(range(1, greatest(1, CAST(ceil(bytes / 1024) AS BIGINT)) + 1)) AS part_number FROM f)
SELECT doc_id, part_number, (part_number - 1) * 1024 AS start, least(part_number * 1024, bytes) AS stop FROM p""",
    "tasks_page": f"WITH {_LOG}, t AS ({_LATEST}) SELECT * FROM t ORDER BY task_id LIMIT 50 OFFSET 10",
    "tasks_total": f"WITH {_LOG} SELECT count(*) AS total FROM log WHERE type = 'pdf.parse'",
    "task_latest": f"WITH {_LOG} {_LATEST}",
    "task_first_final": f"WITH {_LOG} SELECT task_id, arg_min(status, (ts, seq)) AS status, min(ts) AS ts, arg_min(seq, (ts, seq)) AS seq FROM log WHERE status IN ('completed', 'failed') GROUP BY task_id",
    "task_until_final": f"""
WITH {_LOG}, e AS (SELECT task_id, min((ts, seq)) AS stop FROM log WHERE status IN ('completed', 'failed') GROUP BY task_id)
SELECT log.task_id, count(*) AS snapshots, max(seq) AS last_seq FROM log LEFT JOIN e ON e.task_id = log.task_id WHERE stop IS NULL OR (ts, seq) <= stop GROUP BY log.task_id""",
    "task_outcome": f"""
WITH {_LOG}, g AS (
  SELECT task_id, min(ts) AS began, arg_min(status, (ts, seq)) FILTER (WHERE status IN ('completed', 'failed')) AS status, min(ts) FILTER (WHERE status IN ('completed', 'failed')) AS ended FROM log GROUP BY task_id
) SELECT task_id, CASE WHEN ended IS NULL OR floor(epoch(ended)) - floor(epoch(began)) > 86400 THEN 'timeout' ELSE status END AS outcome FROM g""",
    "task_progress": f"""
WITH {_LOG}, g AS (SELECT task_id, count(*) FILTER (WHERE status = 'completed') AS done, count(*) AS parts FROM log GROUP BY task_id)
SELECT task_id, CAST(round(CASE WHEN done >= parts THEN 1.0::DOUBLE ELSE 0.95::DOUBLE * done / parts END * 10000) AS BIGINT) AS progress FROM g""",
    "output_plan": f"""
WITH {_MANIFEST}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY source) AS total FROM f)
SELECT source, doc_id, CASE WHEN total = 1 THEN 'file' ELSE 'directory' END AS sink, lpad(CAST(i AS VARCHAR), CAST(greatest(2, length(CAST(total AS VARCHAR))) AS INTEGER), '0') || {_EXT.format("name")} AS file FROM r""",
    "output_files": f"""
WITH {_MANIFEST} SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS at, 'https://h/' || name AS url FROM f""",
    "event_stream": f"""
WITH {_LOG} SELECT task_id, count(*) AS events, arg_min(status, (ts, seq)) FILTER (WHERE status IN ('completed', 'failed')) AS outcome, arg_min(seq, (ts, seq)) FILTER (WHERE status IN ('completed', 'failed')) AS seq
FROM log GROUP BY task_id""",
    "task_started": f"WITH {_LOG}, t AS ({_LATEST}) SELECT task_id, 'running' AS status, ts, seq + 1 AS seq FROM t WHERE status = 'pending'",
    "task_deleted": f"""
WITH {_LOG}, t AS ({_LATEST}), e AS (SELECT task_id, arg_min(status, (ts, seq)) AS status FROM log WHERE status IN ('completed', 'failed') GROUP BY task_id)
SELECT t.* FROM t WHERE task_id NOT IN (SELECT task_id FROM e WHERE status = 'failed')""",
    "job_validation": f"""
WITH {_MANIFEST}, x AS (SELECT doc_id // 3 AS job, name, {_EXT.format("name")} AS ext FROM f),
j AS (SELECT job, count(*) AS n, bool_and(ext = '.pptx') AS pptx, bool_and(ext IN {GENERATION_FILES}) AS known, arg_min(ext, name) AS ext FROM x GROUP BY job)
SELECT job, CASE WHEN n < 2 THEN 'INVALID_ARGS' WHEN NOT pptx THEN 'UNSUPPORTED_TYPE' END AS join_error,
       CASE WHEN n > 2 THEN 'GENERATION_TOO_MANY_FILES' WHEN NOT known THEN 'UNSUPPORTED_TYPE' END AS generation_error,
       CASE WHEN job % 2 <> 0 THEN 'INVALID_TARGET_LANGUAGE' WHEN ext NOT IN {TRANSLATION_FILES} THEN 'UNSUPPORTED_TYPE' END AS translation_error,
       CASE WHEN ext NOT IN {OCR_FILES} THEN 'UNSUPPORTED_TYPE' END AS ocr_error
FROM j""",
    "is_retriable": """
WITH m AS (SELECT event_id, CASE WHEN event_type = 'error' THEN [200, 404, 502, 604][event_id % 4 + 1] END AS status, ['Network down', 'API Error (502): x', 'API Error (403): timeout', 'broken'][event_id % 3 + 1] AS message FROM events)
SELECT event_id, CASE WHEN status IS NOT NULL THEN status IN (502, 604) WHEN regexp_matches(message, '(?i)API Error \\(\\d{3}') THEN regexp_matches(message, '(502|604)')
       ELSE regexp_matches(lower(message), 'network|timeout|fetch failed|econnaborted|etimedout|enotfound|econnrefused|err_network') END AS retriable FROM m""".replace("\\\\", "\\"),
    "parse_documents": f"""
WITH {_MANIFEST}, d AS (SELECT 'doc-' || doc_id || ['.pdf', '.pptx', '.docx', '.key', '.txt'][doc_id % 5 + 1] AS name, doc_id % 5 AS k, {_TRIM.format("string_split(text, chr(10))[1]")} AS line FROM documents)
SELECT name, CASE k WHEN 0 THEN 'pdf.parse' WHEN 1 THEN 'pptx.parse' WHEN 2 THEN 'docx.parseTextAndImage' WHEN 3 THEN 'keynote.parseTextAndImage' END AS task_type,
       CASE WHEN k < 4 THEN CASE WHEN line = '' THEN '' WHEN k = 0 THEN '## ' || line WHEN k = 2 THEN '## ' || line ELSE line END END AS markdown,
       CASE WHEN k = 4 THEN 'Cannot determine parser for "' || name || '". Supported extensions: .pdf, .pptx, .docx, .key. Pass {{ name }} to specify the file name.' END AS error
FROM d
UNION ALL SELECT 'page-' || page_id, 'html.getByURL', '# ' || page_id || chr(10) || chr(10) || 'x' || CASE WHEN page_id % 2 = 0 THEN chr(10) || chr(10) || '![img](https://h/a.png)' ELSE '' END, NULL FROM pages""",
    "pages_by_url": """
SELECT url, 'runtime' AS mode, page_id, CAST(strlen(html) AS BIGINT) AS bytes FROM pages UNION ALL SELECT 'gone:' || url, 'runtime', NULL, NULL FROM pages""",
    "files_by_id": f"""
WITH {_MANIFEST}, s AS (SELECT hash, min(name) AS name FROM f GROUP BY hash), a AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'gone' || doc_id ELSE hash END AS file_id FROM f),
j AS (SELECT doc_id, name, {_EXT.format("name")} AS ext FROM a LEFT JOIN s ON s.hash = a.file_id)
SELECT doc_id, name, {_case(PARSE)} AS task_type FROM j""",
    "results_fetched": f"""
WITH t AS (SELECT DISTINCT user_id AS task_id, ({_KINDS})[user_id % {len(TASK_TYPES)} + 1] AS type FROM events)
SELECT task_id, type, CASE WHEN type IN ('generation', 'revamp') THEN 'pptx' END AS kind,
       CASE WHEN task_id % 4 <> 0 THEN CASE WHEN type IN ('generation', 'revamp') THEN task_id || '/pptx' ELSE CAST(task_id AS VARCHAR) END END AS result FROM t""",
    "results_decoded": "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(props->>'$.k' AS BIGINT) END AS k FROM events",
    "tasks_created": f"""
WITH {_MANIFEST}, g AS (SELECT doc_id // 3 AS job, string_agg(hash, ',' ORDER BY doc_id) AS ids, sum(bytes) AS bytes, count(*) AS n FROM f GROUP BY doc_id // 3),
h AS (SELECT job, CASE WHEN job % 5 = 0 THEN '' ELSE ids END AS ids, CASE WHEN job % 5 = 0 THEN 0 ELSE bytes END AS bytes, CASE WHEN job % 5 = 0 THEN 0 ELSE n END AS n, CASE WHEN job % 4 = 0 THEN 'a,b' || job || ',a' ELSE '' END AS own FROM g),
i AS (SELECT *, n > 0 AND own = '' AND bytes < 10485760 AS inline FROM h),
k AS (SELECT *, CASE WHEN inline THEN '' ELSE concat_ws(',', nullif(own, ''), nullif(ids, '')) END AS file_ids FROM i)
SELECT job, 'pptx.join' AS task_type, inline, CAST(bytes AS BIGINT) AS bytes, file_ids,
       '{{"fileIds":[' || CASE WHEN file_ids = '' THEN '' ELSE '"' || replace(file_ids, ',', '","') || '"' END || '],"type":"pptx.join","params":' || CASE WHEN job % 2 = 0 THEN '{{"autoResize":"true"}}' ELSE '{{}}' END
       || CASE WHEN job % 3 = 0 THEN ',"spaceId":"s1"' ELSE '' END || '}}' AS body FROM k""",
    "tasks_polled": f"""
WITH {_LOG}, b AS (SELECT task_id, min(ts) AS began FROM log GROUP BY task_id),
p AS (SELECT task_id, began, k, began + to_seconds(3600 * k) AS moment FROM b, range(0, 201) AS r(k)),
s AS (SELECT p.task_id, k, arg_max(status, (ts, seq)) AS status FROM p JOIN log ON log.task_id = p.task_id AND ts <= moment GROUP BY p.task_id, k),
e AS (SELECT task_id, min(k) FILTER (WHERE status IN ('completed', 'failed')) AS k, arg_min(status, k) FILTER (WHERE status IN ('completed', 'failed')) AS status FROM s GROUP BY task_id)
SELECT task_id, CAST(coalesce(k, 200) + 1 AS BIGINT) AS polls, coalesce(status, 'timeout') AS outcome FROM e""",
    "paired_files": f"""
WITH {_MANIFEST} SELECT doc_id // 3 AS job, CAST(row_number() OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) - 1 AS INTEGER) AS at, name, hash, doc_id FROM f""",
    "upload_completion": f"""
WITH {_MANIFEST}, p AS (SELECT doc_id, unnest(range(1, greatest(1, CAST(ceil(bytes / 1024) AS BIGINT)) + 1)) AS part FROM f)
SELECT doc_id, count(*) AS parts, string_agg(part || '=t' || ((part - 1) * 1024), ',' ORDER BY part) AS completion FROM p GROUP BY doc_id""",
    "upload_transfer": f"""
WITH {_MANIFEST} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'none' WHEN doc_id % 2 = 0 AND bytes > 1024 THEN 'parts' WHEN doc_id % 4 = 0 THEN 'put' ELSE 'form' END AS transfer FROM f""",
    "zip_outputs": f"""
WITH {_MANIFEST}, r AS (SELECT *, doc_id // 3 AS job, row_number() OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY doc_id // 3) AS n FROM f)
SELECT job, CASE WHEN n = 1 THEN 'file' ELSE 'zip' END AS sink, '0' || i || '.txt' AS name, bytes, true AS same_crc FROM r""",
    "stream_updates": f"""
WITH {_LOG}, e AS (SELECT task_id, min((ts, seq)) AS stop FROM log WHERE status IN ('completed', 'failed') GROUP BY task_id)
SELECT log.task_id, count(*) AS snapshots, arg_max(status, (ts, seq)) AS status, CASE WHEN bool_or(stop IS NULL) THEN 'SSE connection ended before task completion' END AS error
FROM log LEFT JOIN e ON e.task_id = log.task_id WHERE stop IS NULL OR (ts, seq) <= stop GROUP BY log.task_id""",
    "task_follow": f"WITH {_LOG} SELECT task_id, arg_min(status, (ts, seq)) AS outcome, arg_min(seq, (ts, seq)) AS seq FROM log WHERE status IN ('completed', 'failed') GROUP BY task_id",
    "file_scan": "SELECT * FROM (VALUES ('nation.parquet', true), ('region.parquet', true)) AS t(name, whole)",
    "blob_scan": """SELECT name, CAST(bytes AS BIGINT) AS bytes, hash, crc FROM (VALUES ('a.txt', 3, md5('abc'), '352441c2'), ('empty.bin', 0, md5(''), '00000000'), ('digits', 9, md5('123456789'), 'cbf43926')) AS t(name, bytes, hash, crc)""",
    # the pages of the test tables: in the article one heading, paragraphs, and bold beginnings that are never closed
    "html_markdown": r"""
WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
t AS (SELECT page_id, title, regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1) AS head, list_filter(regexp_extract_all(body, '(?s)<p>(?:<b>)?[^<]*'), lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'), chr(10) || chr(9) || ' ') <> '') AS parts FROM p),
m AS (
  SELECT page_id, '# ' || trim(title) || chr(10) || chr(10) || '# ' || trim(head) || chr(10) || chr(10)
         || array_to_string(list_transform(parts, lambda x: CASE WHEN starts_with(x, '<p><b>') THEN '**' ELSE '' END || trim(regexp_replace(x, '<[^>]*>', '', 'g'), chr(10) || chr(9) || ' ')), chr(10) || chr(10))
         || repeat('**', len(list_filter(parts, lambda x: starts_with(x, '<p><b>')))) AS markdown
  FROM t
)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(markdown, '[ \t\r\f\v]+', ' ', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS markdown, CAST(NULL AS VARCHAR) AS error FROM m""",
}
