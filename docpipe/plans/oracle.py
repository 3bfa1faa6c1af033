"""DuckDB SQL for the registered queries, on the same tables."""

from __future__ import annotations

from docpipe.functions.html import ENTITIES
from docpipe.functions.text import ASCII_PUNCTUATION


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Python's white space and line ends, for an engine with ASCII \s
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
LINE_END = r"\r\n|[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}]"
PUNCT = _quoted(ASCII_PUNCTUATION)
NL = "chr(10)"

SUFFIX = """CASE WHEN n_chars < 200 THEN ''
    WHEN lang = 'en' THEN CASE WHEN n_chars < 1000 THEN '.DOCX' ELSE '.docx' END
    WHEN lang = 'de' THEN '.rtf'
    WHEN lang = 'fr' THEN '.eml'
    ELSE CASE WHEN n_chars < 1000 THEN '.doc' ELSE '.pdf' END END"""

FILES = f"files AS (SELECT *, 'doc_' || doc_id || {SUFFIX} AS files, {SUFFIX} AS dotted FROM documents)"


def normalise(text: str) -> str:
    return f"lower(translate({text}, {PUNCT}, ''))"


def plain(text: str) -> str:
    """Cleaning of plain text, header of six characters included."""
    s = f"regexp_replace({text}, '\\r\\n?', {NL}, 'g')"
    s = f"regexp_replace({s}, ' +', ' ', 'g')"
    s = f"substr({s}, 7)"
    s = f"replace({s}, '|', '')"
    s = f"regexp_replace({s}, '[\\r\\n]+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\t+', ' ', 'g')"
    return normalise(s)


def page(text: str) -> str:
    s = f"regexp_replace({text}, {_quoted(LINE_END)}, '', 'g')"
    s = f"regexp_replace({s}, {_quoted(WHITESPACE)}, ' ', 'g')"
    return f"lower(trim({s}))"


def paragraphs(text: str) -> str:
    lines = f"list_filter(string_split({text}, {NL}), lambda p: p <> '')"
    return f"array_to_string(list_transform({lines}, lambda p: {normalise('p')}), '')"


def rtf(text: str) -> str:
    return f"lower(regexp_replace(translate({text}, {PUNCT}, ''), ' +', ' ', 'g'))"


def decoded(text: str) -> str:
    for reference, char in ENTITIES:
        text = f"replace({text}, '{reference}', {_quoted(char)})"
    return text


def visible(html: str) -> str:
    s = f"regexp_replace({html}, '(?si)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>|<[^>]*>', ' ', 'g')"
    s = decoded(s)
    return f"trim(regexp_replace({s}, {_quoted(WHITESPACE)}, ' ', 'g'))"


def nodes(html: str) -> str:
    """Every string node joined by a blank, for pages whose only markup inside a script is one end tag.

    Comments and the doctype become text between empty tags; chr(1) and chr(2) stand
    for the angle brackets inside a script.
    """
    s = f"regexp_replace({html}, '(<script>[^<]*)<(/p)>([^<]*</script>)', '\\1' || chr(1) || '\\2' || chr(2) || '\\3', 'g')"
    s = f"regexp_replace({s}, '<!DOCTYPE ([^>]*)>', '<>\\1<>', 'g')"
    s = f"regexp_replace({s}, '(?s)<!--(.*?)-->', '<>\\1<>', 'g')"
    s = f"regexp_replace({s}, '>[ \\t\\r\\f]*\\n[ \\t\\r\\n\\f]*<', '>' || {NL} || '<', 'g')"
    s = f"regexp_replace({s}, '>[ \\t\\r\\f]+<', '> <', 'g')"
    s = f"regexp_replace({s}, '^(<[^>]*>)+|(<[^>]*>)+$', '', 'g')"
    s = f"regexp_replace({s}, '(<[^>]*>)+', ' ', 'g')"
    s = f"regexp_replace({s}, '&amp;?', '&amp;', 'g')"  # some titles end in a cut reference
    s = decoded(s)
    return f"replace(replace({s}, chr(1), '<'), chr(2), '>')"


MANIFEST = """manifest AS (SELECT
    'doc_' || o_custkey AS "Object_name",
    CASE WHEN o_orderstatus <> 'O' THEN 'doc_' || o_orderkey END AS "Prior_Version_Object_Name",
    strftime(o_orderdate, '%Y-%m-%d') AS "Document_date",
    o_orderpriority AS "Business_segment",
    CASE WHEN o_orderstatus = 'F' THEN 'Changed' ELSE 'New' END AS "new/changed",
    CAST(o_custkey AS VARCHAR) AS claim_id,
    'cedent_' || o_custkey AS cedent_id,
    CAST(o_orderkey AS VARCHAR) AS object_id,
    CAST(o_orderdate AS DATE) AS manifest_date
    FROM orders)"""

MANIFEST_LIST = (
    '"Object_name", "Prior_Version_Object_Name", "Document_date", "Business_segment", '
    '"new/changed", claim_id, cedent_id'
)

TEXTS = f"texts AS (SELECT 'doc_' || doc_id || '.doc' AS files, doc_id, {plain(chr(39) + 'HEADER' + chr(39) + ' || text')} AS raw_text FROM documents)"
MERGED = f"{TEXTS}, merged AS (SELECT files, quality, toxic, raw_text FROM labels JOIN texts USING (doc_id))"

# a page of a pdf is one line of the document; very short lines are failed pages
OUTCOMES = f"""{FILES},
pdf AS (
    SELECT files, string_agg(page_text, '' ORDER BY page_no) FILTER (NOT failed) AS raw_text,
        count(*) AS n_pages, count(*) FILTER (failed) AS n_failed
    FROM (
        SELECT files, page_no, length(line) < 20 AS failed, {page('line')} AS page_text
        FROM (SELECT files, unnest(string_split(text, {NL})) AS line,
                     generate_subscripts(string_split(text, {NL}), 1) AS page_no
              FROM files WHERE dotted = '.pdf'))
    GROUP BY files),
outcomes AS (
    SELECT f.files, substr(dotted, 2) AS ext,
        CASE dotted
            WHEN '.docx' THEN CASE WHEN n_chars >= 1500 THEN {paragraphs('text')} END
            WHEN '.rtf' THEN CASE WHEN n_chars >= 1000 THEN {rtf('text')} END
            WHEN '.eml' THEN CASE WHEN n_chars >= 1000 THEN {normalise('text')} END
            WHEN '.doc' THEN {plain("'HEADER' || text")}
            WHEN '.pdf' THEN coalesce(pdf.raw_text, '') END AS raw_text,
        CASE dotted
            WHEN '.docx' THEN CASE WHEN n_chars >= 1500 THEN 'ok' ELSE 'error' END
            WHEN '.rtf' THEN CASE WHEN n_chars >= 1000 THEN 'ok' ELSE 'error' END
            WHEN '.eml' THEN CASE WHEN n_chars >= 1000 THEN 'ok' ELSE 'skipped' END
            WHEN '.doc' THEN 'ok' WHEN '.pdf' THEN 'ok' ELSE 'unsupported' END AS status,
        CASE WHEN dotted = '.docx' AND n_chars < 1500 THEN 'is empty'
             WHEN dotted = '.rtf' AND n_chars < 1000 THEN 'unbalanced group end'
             WHEN n_failed > 0 THEN n_failed || ' of ' || n_pages || ' pages failed' END AS error
    FROM files f LEFT JOIN pdf ON pdf.files = f.files)"""

CONV_PAGES = f"""cleaned AS (SELECT 'conv_' || conv_id || '.pdf' AS files, CAST(turn AS INTEGER) AS page_no,
    {page('text')} AS page_text FROM conversations)"""

STEM = "regexp_replace(files, '\\.[^.]*$', '')"

# one row per object and day, and until when it holds
HISTORY = f"""{MANIFEST}, said AS (
    SELECT *, row_number() OVER (PARTITION BY "Object_name", manifest_date ORDER BY object_id DESC) AS nth FROM manifest),
  history AS (
    SELECT *, manifest_date AS valid_from, lead(manifest_date) OVER (PARTITION BY "Object_name" ORDER BY manifest_date) AS valid_to
    FROM said WHERE nth = 1)"""


def links(lengths: list[int]) -> str:
    """Orders and their prior versions, and all that a walk back from each of them meets in 2,100 steps."""
    return f"""RECURSIVE links AS MATERIALIZED (
        SELECT 'ord_' || o_orderkey AS name, 'ord_' || CASE WHEN spot > 0 THEN o_orderkey - 1
            WHEN (o_orderkey // 1000) % 4 = 3 AND length > 1 THEN o_orderkey + length // 2 END AS prior
        FROM (SELECT o_orderkey, length, (o_orderkey % 1000) % length AS spot
            FROM (SELECT o_orderkey, ({lengths})[(o_orderkey // 1000) % {len(lengths)} + 1] AS length FROM orders))),
    names AS MATERIALIZED (SELECT name FROM links UNION SELECT prior FROM links WHERE prior IS NOT NULL),
    up AS (SELECT name, prior AS prev, 1 AS depth FROM links WHERE prior IS NOT NULL
        UNION ALL SELECT up.name, prior, depth + 1 FROM up JOIN links ON up.prev = links.name WHERE prior IS NOT NULL AND depth < 2100)"""


ORACLE: dict[str, str] = {
    "select_by_extension": f"WITH {FILES} SELECT files FROM files WHERE dotted = '.docx'",
    "distinct_file_types": f"WITH {FILES} SELECT DISTINCT dotted AS ext FROM files WHERE length(dotted) BETWEEN 3 AND 5",
    "sample_files": f"WITH {FILES} SELECT files FROM files ORDER BY md5(files), files LIMIT 100",
    "name_parts": f"""WITH {FILES} SELECT files, dotted AS ext, 'doc_' || doc_id AS stem,
        upper(substr(dotted, 2, 1)) || lower(substr(dotted, 3)) AS title,
        CASE WHEN dotted = '.doc' THEN 'doc_' || doc_id || '.csv' ELSE files END AS converted FROM files""",
    "clean_plain_text": f"SELECT 'doc_' || doc_id || '.doc' AS files, {plain('text')} AS raw_text FROM documents",
    "paragraphs_to_text": f"SELECT doc_id, {paragraphs('text')} AS raw_text FROM documents",
    "html_visible_text": f"SELECT page_id, {visible('html')} AS raw_text FROM pages",
    "html_all_nodes": f"SELECT page_id, {nodes('html')} AS raw_text FROM pages",
    "clean_page_text": f"WITH {CONV_PAGES} SELECT files, page_no, page_text FROM cleaned",
    "pages_long": f"WITH {CONV_PAGES} SELECT files, 'page ' || page_no AS page, page_text FROM cleaned",
    "page_snapshot_roundtrip": f"WITH {CONV_PAGES} SELECT files, 'page ' || page_no AS page, page_text FROM cleaned",
    "assemble_pages": f"""WITH {CONV_PAGES} SELECT files, string_agg(page_text, '' ORDER BY page_no) AS raw_text,
        count(*) AS n_pages, CAST(0 AS BIGINT) AS n_page_errors, 'ok' AS status FROM cleaned GROUP BY files""",
    "route_empty_text": f"""WITH {OUTCOMES} SELECT files, status, CASE WHEN status <> 'ok' THEN status
        WHEN raw_text IS NULL OR trim(regexp_replace(raw_text, {_quoted(WHITESPACE)}, ' ', 'g')) = '' THEN 'needs_ocr'
        ELSE 'text' END AS route FROM outcomes""",
    "read_page_files": f"""SELECT files, page_no, page_text,
        CASE WHEN trim(regexp_replace(page_text, {_quoted(WHITESPACE)}, ' ', 'g')) = '' THEN 'no word' END AS page_error
        FROM (SELECT 'doc_' || doc_id || '.pdf' AS files, unnest(string_split(text, {NL})) AS page_text,
                     CAST(generate_subscripts(string_split(text, {NL}), 1) - 1 AS INTEGER) AS page_no FROM documents)""",
    "extract_docx": f"SELECT 'doc_' || doc_id || '.docx' AS files, {paragraphs('text')} AS raw_text, 'ok' AS status FROM documents",
    "extract_rtf": f"SELECT 'doc_' || doc_id || '.rtf' AS files, {rtf('text')} AS raw_text, 'ok' AS status FROM documents",
    "extract_eml": f"SELECT 'page_' || page_id || '.eml' AS files, {normalise(nodes('html'))} AS raw_text, 'ok' AS status FROM pages",
    "extract_outcomes": f"""WITH {OUTCOMES} SELECT ext, count(*) AS n_files,
        count(*) FILTER (status = 'ok') AS n_ok,
        count(*) FILTER (status = 'ok' AND error IS NOT NULL) AS n_partial, count(*) FILTER (status = 'error') AS n_error,
        count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'unsupported') AS n_unsupported
        FROM outcomes GROUP BY ext""",
    "outcome_rows": f"WITH {OUTCOMES} SELECT files, ext, raw_text, status, error FROM outcomes",
    "error_listing": f"WITH {OUTCOMES} SELECT files, error FROM outcomes WHERE error IS NOT NULL",
    "error_file_roundtrip": f"WITH {OUTCOMES} SELECT files, error FROM outcomes WHERE error IS NOT NULL",
    "latest_per_file": """SELECT 'conv_' || conv_id || '.doc' AS files, turn AS delivery, role, text AS raw_text
        FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) = 1""",
    "parse_mapping_lines": f"""SELECT doc_id, CAST(line_no - 1 AS INTEGER) AS line_no,
        CASE WHEN strpos(value, ',') = 0 THEN value ELSE substr(value, 1, strpos(value, ',') - 1) END AS files,
        CASE WHEN strpos(value, ',') > 0 THEN substr(value, strpos(value, ',') + 1) END AS meta
        FROM (SELECT doc_id, unnest(string_split(text, {NL})) AS value,
                     generate_subscripts(string_split(text, {NL}), 1) AS line_no FROM documents)""",
    "mapping_file": """SELECT 'doc_' || doc_id || '.doc' AS files, quality || ',' || toxic AS quality FROM labels
        UNION ALL SELECT 'files', 'quality,toxic' FROM labels WHERE toxic = 1""",
    "mapping_join": f"WITH {MERGED} SELECT files, quality, toxic, raw_text FROM merged",
    "mapping_join_totals": f"""SELECT lang, count(*) AS n_files, CAST(sum(length({plain('text')})) AS BIGINT) AS n_chars
        FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
    "csv_roundtrip": f"WITH {MERGED} SELECT files, quality, toxic, nullif(raw_text, '') AS raw_text FROM merged",
    "snapshot_roundtrip": f"WITH {TEXTS} SELECT files, raw_text FROM texts",
    "manifest_for_day": f"WITH {MANIFEST} SELECT {MANIFEST_LIST} FROM manifest WHERE manifest_date = DATE '1995-06-19'",
    "manifest_backlog": f"""WITH {MANIFEST} SELECT object_id, "Object_name", strftime(manifest_date, '%Y%m%d') AS day_stamp
        FROM manifest WHERE manifest_date BETWEEN DATE '1995-06-15' AND DATE '1995-06-19'""",
    "manifest_project": f"WITH {MANIFEST} SELECT {MANIFEST_LIST} FROM manifest",
    "manifest_preview": f"""WITH {MANIFEST} SELECT "Object_name", object_id, "Document_date" FROM manifest
        ORDER BY "Object_name", object_id LIMIT 5""",
    "manifest_changed": f"""WITH {MANIFEST} SELECT object_id, "Object_name", "new/changed" FROM manifest
        WHERE "new/changed" = 'Changed'""",
    "manifest_has_prior": f"""WITH {MANIFEST} SELECT object_id, "Prior_Version_Object_Name" FROM manifest
        WHERE "Prior_Version_Object_Name" IS NOT NULL""",
    "manifest_union": f"""WITH {MANIFEST} SELECT object_id,
        CASE WHEN "new/changed" = 'Changed' THEN "Prior_Version_Object_Name" END AS "Prior_Version_Object_Name",
        "new/changed" FROM manifest""",
    "manifest_unprocessed": f"""WITH {MANIFEST} SELECT object_id, "Object_name" FROM manifest WHERE manifest_date NOT IN
        (SELECT manifest_date FROM manifest WHERE "new/changed" = 'Changed' AND "Business_segment" = '1-URGENT')""",
    "backlog_dates": f"""WITH {MANIFEST}, per_day AS (SELECT manifest_date, count(*) AS n FROM manifest GROUP BY 1)
        SELECT strftime(r.manifest_date, '%Y%m%d') AS run_stamp,
            strftime(r.manifest_date - CAST(k AS INTEGER), '%Y%m%d') AS day_stamp, coalesce(p.n, 0) AS n_rows
        FROM per_day r CROSS JOIN range(1, 6) AS days(k)
        LEFT JOIN per_day p ON p.manifest_date = r.manifest_date - CAST(k AS INTEGER)""",
    "prior_version_join": f"""WITH {MANIFEST}, {TEXTS} SELECT "Prior_Version_Object_Name", "Object_name", object_id, raw_text
        FROM manifest JOIN texts ON "Prior_Version_Object_Name" = 'doc_' || doc_id""",
    "delta_vs_manifest": f"""WITH {MANIFEST}, a AS (SELECT 'doc_' || doc_id AS name, count(*) AS n FROM documents GROUP BY 1),
        b AS (SELECT "Object_name" AS name, count(*) AS n FROM manifest GROUP BY 1)
        SELECT name AS "Object_name",
            CASE WHEN b.n IS NULL THEN 'file_only' WHEN a.n IS NULL THEN 'meta_only' ELSE 'both' END AS status,
            coalesce(a.n, 0) AS n_files, coalesce(b.n, 0) AS n_manifest
        FROM a FULL JOIN b USING (name)""",
    "attach_manifest_keys": f"""WITH {MANIFEST}, {TEXTS}
        SELECT files, object_id, claim_id, "Prior_Version_Object_Name", raw_text
        FROM texts LEFT JOIN manifest ON "Object_name" = 'doc_' || doc_id""",
    "reconcile_stages": f"""WITH {OUTCOMES}, merged AS (
            SELECT raw_text FROM outcomes JOIN labels ON {STEM} = 'doc_' || doc_id WHERE status = 'ok'),
        totals AS (
            SELECT 0 AS position, 'source_total' AS stage, count(*) AS n FROM outcomes
            UNION ALL SELECT 1, 'daily_files', count(*) FROM outcomes WHERE ext = 'docx'
            UNION ALL SELECT 2, 'extracted', count(*) FROM outcomes WHERE status = 'ok'
            UNION ALL SELECT 3, 'csv_rows', count(*) FROM merged
            UNION ALL SELECT 4, 'table_rows', count(*) FROM merged
            UNION ALL SELECT 5, 'cluster_rows', count(*) FROM merged
            UNION ALL SELECT 6, 'source_less_daily', count(*) FROM outcomes WHERE ext <> 'docx'
            UNION ALL SELECT 7, 'extracted_and_errors', count(*) FROM outcomes WHERE status IN ('ok', 'error'))
        SELECT position, stage, n, n - lag(n) OVER (ORDER BY position) AS change FROM totals""",
    "table_overwrite_load": f"""WITH {MERGED} SELECT CAST(quality AS VARCHAR) AS object_id, CAST(toxic AS VARCHAR) AS claim_id,
        files AS filename, 'doc' AS file_extension, raw_text AS extracted_text FROM merged""",
    "table_drop": "SELECT 'doc_' || doc_id || '.doc' AS files, quality, toxic, false AS dropped_exists FROM labels",
    "sql_passthrough": """SELECT lang, source, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS n_chars
        FROM documents GROUP BY lang, source""",
    "manifest_files_roundtrip": f"""WITH {MANIFEST} SELECT "Object_name", "Prior_Version_Object_Name", "Document_date",
        "Business_segment" || ' "€", x' AS "Business_segment", "new/changed", claim_id, cedent_id, object_id, manifest_date FROM manifest""",
    "manifest_ranges": f"""WITH {MANIFEST} SELECT "Object_name", "Prior_Version_Object_Name", "Document_date",
        "Business_segment" || ' "€", x' AS "Business_segment", "new/changed", claim_id, cedent_id, object_id, manifest_date FROM manifest""",
    "folder_outcomes": f"WITH {OUTCOMES} SELECT files, ext, raw_text, status, error FROM outcomes WHERE ext IN ('doc', 'docx', 'eml', 'rtf')",
    "folder_ingest": f"""WITH {OUTCOMES} SELECT files, ext, CASE WHEN ext <> 'pdf' THEN raw_text END AS raw_text,
        CASE WHEN ext = 'pdf' THEN 'unsupported' ELSE status END AS status, CASE WHEN ext <> 'pdf' THEN error END AS error FROM outcomes""",
    "incremental_ingest": f"WITH {TEXTS} SELECT files, raw_text, 'ok' AS status FROM texts",
    "sample_per_type": f"""WITH {FILES} SELECT files, ext FROM (
        SELECT files, dotted AS ext, row_number() OVER (PARTITION BY dotted ORDER BY md5(files), files) AS nth FROM files) WHERE nth <= 100""",
    "key_history": f"""WITH {HISTORY} SELECT "Object_name", valid_from, valid_to, object_id, claim_id,
        "Prior_Version_Object_Name", "new/changed" FROM history""",
    "manifest_stream": f"""WITH {HISTORY} SELECT "Object_name", valid_from, valid_to, object_id, claim_id,
        "Prior_Version_Object_Name", "new/changed" FROM history""",
    "attach_keys_as_of": f"""WITH {HISTORY}, {TEXTS}, dated AS (
            SELECT *, DATE '1995-01-01' + CAST(doc_id * 37 % 2500 AS INTEGER) AS day FROM texts)
        SELECT files, day, valid_from, object_id, claim_id, raw_text FROM dated LEFT JOIN history
        ON "Object_name" = 'doc_' || doc_id AND valid_from <= day AND (valid_to IS NULL OR valid_to > day)""",
    "daily_key_history": f"""WITH {HISTORY}, {TEXTS}
        SELECT files, object_id, claim_id, "Prior_Version_Object_Name", raw_text
        FROM texts LEFT JOIN (FROM history WHERE valid_to IS NULL) ON "Object_name" = 'doc_' || doc_id""",
    "content_claims": f"""WITH {HISTORY}, delta AS (
            SELECT 'doc_' || doc_id AS stem, CASE WHEN doc_id % 7 = 0 THEN 'gone' WHEN text IS NULL THEN 'unread'
                WHEN doc_id % 3 = 0 THEN 'changed' ELSE 'same' END AS status, strlen(text) + 6 AS old_length,
                CASE WHEN doc_id % 7 <> 0 THEN strlen(text) + 6 + CASE WHEN doc_id % 3 = 0 THEN 6 ELSE 0 END END AS new_length FROM documents
            UNION ALL SELECT 'page_' || page_id, 'new', NULL, strlen(html) FROM pages)
        SELECT stem || '.doc' AS files, status, old_length, new_length, "new/changed" AS claim,
            CASE WHEN status = 'unread' THEN NULL WHEN "new/changed" IS NULL THEN status IN ('same', 'gone')
                WHEN "new/changed" = 'Changed' THEN status = 'changed' ELSE status = 'new' END AS agrees
        FROM delta LEFT JOIN (FROM history WHERE valid_to IS NULL) ON "Object_name" = stem""",
    "version_lineage": f"""WITH {links([1, 2, 1000, 7, 30, 100, 300])}, far AS (SELECT name, max(depth) AS depth FROM up GROUP BY name),
        round AS (SELECT name, min(prev) AS first, bool_or(prev = name) AS inside FROM up WHERE depth > 1000 GROUP BY name)
        SELECT n.name, coalesce(r.first, u.prev, n.name) AS first, CASE WHEN r.name IS NULL THEN coalesce(f.depth, 0) END::BIGINT AS depth,
            CASE WHEN r.inside THEN 'in' WHEN r.name IS NOT NULL THEN 'to' END AS cycle
        FROM names n LEFT JOIN far f USING (name) LEFT JOIN up u ON u.name = n.name AND u.depth = f.depth LEFT JOIN round r ON r.name = n.name""",
    "earlier_versions": f"""WITH {links([1, 2, 5, 7, 20, 50])}, endless AS (SELECT DISTINCT name FROM up WHERE depth > 1000)
        SELECT name, depth::BIGINT AS back, prev AS earlier FROM up WHERE name NOT IN (FROM endless)""",
    "readers_in_sql": f"""WITH parts AS (SELECT doc_id, n_chars, list_filter(string_split(text, {NL}), lambda p: p <> '') AS lines FROM documents)
        SELECT 'doc_' || doc_id || '.docx' AS files, (i - 1)::INTEGER AS part_no, lines[i] AS part, 'ok' AS status, false AS failed
        FROM parts, unnest(range(1, len(lines) + 1)) AS t(i) WHERE n_chars >= 300 AND doc_id % 10 <> 0
        UNION ALL SELECT 'doc_' || doc_id || '.docx', NULL, NULL, 'error', true FROM parts WHERE n_chars < 300 OR doc_id % 10 = 0""",
    "batch_reports": f"""WITH {TEXTS} SELECT doc_id % 4 AS batch_id, count(*) AS n_files, count(*) AS n_ok, 0::BIGINT AS n_error,
        sum(length(raw_text))::BIGINT AS n_chars FROM texts GROUP BY doc_id % 4""",
}
