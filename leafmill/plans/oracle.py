"""DuckDB SQL for each query, written from the meaning of the operator, not from its Spark code."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

NL = "chr(10)"


# Columns that are 32-bit (or 64-bit) on the Spark side and need saying so in SQL.
INTS: dict[str, str] = {
    "page_tables": "n_rows",
    "page_images": "width",
    "normalize_blocks": "page",
    "normalize_tables": "n_rows",
    "normalize_figures": "page width height",
    "first_and_min_page": "first_page min_page",
    "filter_pages": "page",
    "filter_pages_by_spec": "page",
    "noise_figures": "width height",
    "resolve_caption": "line",
    "chunk_tokens": "page",
    "chunk_greedy": "page",
    "report_entries": "page",
    "fold_statuses": "page",
    "page_context": "page",
    "all_items": "page",
    "assemble_documents": "n_blocks n_figures",
    "table_cells_long": "row col",
    "report_markdown": "line_no",
    "global_report_markdown": "line_no",
    "rollup_markdown": "line_no",
    "table_rows_to_markdown": "line_no",
    "text_counts": "printable letters stripped",
    "analysis_flat": "n_components",
    "plot_points": "point",
    "plot_csv_long": "row col",
    "diagram_edges": "edge",
    "pin_table": "n",
    "register_bits": "n",
    "schematic_components": "n",
    "signal_table": "n",
}
LONGS: dict[str, str] = {
    "page_tables": "ord",
    "page_images": "ord",
    "valid_descriptions": "pos",
    "assemble_documents": "part",
    "index_records": "part",
}


def add(name: str, sql: str) -> None:
    casts = [f"{c}::INTEGER AS {c}" for c in INTS.get(name, "").split()]
    casts += [f"{c}::BIGINT AS {c}" for c in LONGS.get(name, "").split()]
    sql = sql.strip()
    ORACLE[name] = f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{sql}\n)" if casts else sql


# --- shared inputs -----------------------------------------------------------

BLOCKS = f"""
blocks AS (
  SELECT doc_id, ord, 1 + (ord - 1) // 5 AS page, text FROM (
    SELECT doc_id, unnest(string_split(text, {NL})) AS text,
           generate_subscripts(string_split(text, {NL}), 1) AS ord
    FROM documents))
"""

FIGURES = (
    BLOCKS
    + """,
figures AS (
  SELECT b.doc_id, b.ord, b.page, printf('fig_%04d', b.ord) AS figure_id, b.text AS caption,
         n.text AS reply,
         CASE WHEN right(b.text, 1) IN ('.', '!', '?')
              THEN printf('img/%d/%d.png', b.doc_id, b.ord) END AS image_path,
         length(b.text) AS width, len(string_split(b.text, ' ')) AS height
  FROM blocks b LEFT JOIN blocks n ON n.doc_id = b.doc_id AND n.ord = b.ord + 1)
"""
)


def infer(text: str) -> str:
    """Corpus description rules."""
    t = f"lower({text})"
    return f"""CASE
    WHEN contains({t}, 'ndst') OR contains({t}, 'auxle') THEN 'logo'
    WHEN contains({t}, 'erder') OR contains({t}, 'quevi') THEN 'photo'
    WHEN contains({t}, 'thing') OR contains({t}, 'lich') OR contains({t}, 'eau. l') THEN 'plot'
    WHEN contains({t}, 'ción') OR contains({t}, 'on the') THEN 'schematic'
    WHEN contains({t}, 'sch') THEN 'mechanical'
    ELSE 'other' END"""


SIMPLE = "('logo','icon','decorative','photo','screenshot')"
COMPLEX = (
    "('plot','pinout','schematic','block_diagram','timing_diagram','register_map',"
    "'wiring_diagram','state_machine','table_image')"
)


def resolved(label: str, text: str) -> str:
    return (
        f"({label} IN {SIMPLE} OR ({label} NOT IN {COMPLEX} AND length({text}) > 50))"
    )


PRINTABLE = r"[^\p{L}\p{M}\p{N}\p{P}\p{S} ]"
WHITE = r"[\s\p{Z}\x1c-\x1f\x{85}\x0b]"


def valid(text: str) -> str:
    c = f"replace(replace(replace({text}, '<unk>', ''), '<s>', ''), '</s>', '')"
    return f"""coalesce(
      regexp_replace({text}, '{WHITE}', '', 'g') <> '' AND length({c}) > 0
      AND length(regexp_replace({c}, '{PRINTABLE}', '', 'g')) / length({c}) >= 0.6
      AND length(regexp_replace({c}, '[^\\p{{L}}]', '', 'g')) >= 10, false)"""


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{WHITE}+', ''), '{WHITE}+$', '')"


def triaged(source: str, reply: str = "reply", label_fn=infer) -> str:
    """Statuses of the rows of ``source`` (doc_id, figure_id, image_path, width, height, reply)."""
    return f"""
t0 AS (SELECT *, coalesce({strip(reply)}, '') AS r FROM {source}),
t1 AS (SELECT *, {valid('r')} AS ok, {label_fn('r')} AS cls FROM t0),
t2 AS (SELECT *, CASE WHEN coalesce(image_path, '') = '' THEN 'missing'
                      WHEN width * height < 500 THEN 'noise'
                      WHEN ok THEN 'valid' WHEN r <> '' THEN 'failed' ELSE 'none' END AS branch,
         {resolved('cls', 'r')} AS res FROM t1),
fresh AS (
  SELECT doc_id, figure_id, coalesce(image_path, '') AS image_path,
    CASE WHEN branch IN ('missing', 'noise') OR (branch = 'valid' AND res)
         THEN 'resolved_local' ELSE 'needs_external' END AS status,
    CASE branch WHEN 'missing' THEN 'skip' WHEN 'noise' THEN 'skip' WHEN 'valid' THEN 'local_llm'
                WHEN 'failed' THEN 'local_llm_failed' ELSE '' END AS stage,
    CASE branch WHEN 'missing' THEN 'File not found'
      WHEN 'noise' THEN printf('Image too small to be meaningful (%dx%d)', width, height)
      WHEN 'valid' THEN r ELSE '' END AS local_llm_description,
    CASE branch WHEN 'noise' THEN 'noise' WHEN 'valid' THEN cls ELSE '' END
      AS local_llm_classification,
    CASE branch WHEN 'missing' THEN 0.0 WHEN 'noise' THEN 1.0
      WHEN 'valid' THEN CASE WHEN res THEN 0.7 ELSE 0.3 END ELSE 0.3 END::DOUBLE AS confidence
  FROM t2)
"""


STATUSES = (
    FIGURES
    + ","
    + triaged("(SELECT f.* FROM figures f WHERE NOT (f.ord = 1 AND f.doc_id IN (SELECT doc_id FROM labels)))")
    + """,
statuses AS (
  SELECT * FROM fresh
  UNION ALL
  SELECT l.doc_id, 'fig_0001', printf('img/%d/1.png', l.doc_id), 'resolved_external', 'local_llm',
    'Settled before', CASE WHEN toxic = 1 THEN 'plot' ELSE 'photo' END, 0.3::DOUBLE
  FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM documents))
"""
)

CONTEXT = f"""
ctx AS (
  SELECT doc_id, page, string_agg(left(text, 200), ' ' ORDER BY ord) AS context
  FROM blocks GROUP BY doc_id, page)
"""


def figure_rules(caption: str, both: str, what: str) -> str:
    """Corpus figure rules; ``what`` picks the class, the confidence or the rationale."""
    c, t = f"lower({caption})", f"lower({both})"
    table = [
        (f"contains({c}, 'schen') OR contains({c}, 'ción')", "table_image", 0.75, "caption fragment"),
        (f"contains({t}, 'ndst') OR contains({t}, 'auxle')", "timing_diagram", 0.92, "fragment one"),
        (f"contains({t}, 'erder') OR contains({t}, 'quevi')", "state_machine", 0.88, "fragment two"),
        (f"contains({t}, 'thing') OR contains({t}, 'lich unge')", "block_diagram", 0.9, "fragment three"),
        (f"contains({t}, 'eau. l') OR contains({t}, 'on the')", "plot", 0.85, "fragment four"),
    ]
    pick = {"type": 1, "confidence": 2, "rationale": 3}[what]
    default = {"type": "'other'", "confidence": "0.4::DOUBLE", "rationale": "'no rule matched'"}[what]

    def show(v) -> str:
        return f"{v}::DOUBLE" if isinstance(v, float) else f"'{v}'"

    return "CASE " + " ".join(f"WHEN {r[0]} THEN {show(r[pick])}" for r in table) + f" ELSE {default} END"


RULED = (
    CONTEXT
    + f""",
r0 AS (
  SELECT f.*, coalesce(f.caption, '') || ' ' || coalesce(c.context, '') AS hay
  FROM figures f LEFT JOIN ctx c USING (doc_id, page)),
ruled AS (
  SELECT *, {figure_rules('caption', 'hay', 'type')} AS type,
    {figure_rules('caption', 'hay', 'confidence')} AS class_confidence,
    {figure_rules('caption', 'hay', 'rationale')} AS rationale FROM r0),
based AS (
  SELECT *, 'Pending local LLM processing.' AS description, 0.0::DOUBLE AS description_confidence,
    CASE WHEN type IN ('plot', 'timing_diagram', 'block_diagram', 'state_machine')
         THEN 'LLM recommended' ELSE 'none' END AS notes FROM ruled)
"""
)

FOLDED = (
    STATUSES
    + ","
    + RULED
    + """,
folded AS (
  SELECT b.doc_id, b.figure_id, b.ord, b.page, b.caption, coalesce(b.image_path, '') AS image_path,
    CASE WHEN s.local_llm_classification <> '' THEN s.local_llm_classification ELSE b.type END AS type,
    CASE WHEN s.local_llm_classification <> '' THEN s.confidence ELSE b.class_confidence END
      AS class_confidence,
    CASE WHEN s.local_llm_classification <> '' THEN 'local_llm classification' ELSE b.rationale END
      AS rationale,
    CASE WHEN s.status IS NULL THEN b.description
         WHEN s.local_llm_description <> '' THEN s.local_llm_description
         WHEN s.stage = 'skip' THEN s.local_llm_description
         ELSE 'Pending external LLM processing.' END AS description,
    CASE WHEN s.local_llm_description <> '' THEN s.confidence ELSE b.description_confidence END
      AS description_confidence,
    CASE WHEN s.status IS NULL THEN b.notes
         WHEN s.local_llm_description <> '' AND s.local_llm_classification <> ''
           THEN 'local_llm (' || s.local_llm_classification || ')'
         WHEN s.local_llm_description <> '' THEN 'local_llm'
         WHEN s.stage = 'skip' THEN 'skipped' ELSE 'needs_external' END AS notes
  FROM based b LEFT JOIN statuses s USING (doc_id, figure_id))
"""
)


def advice(what: str) -> str:
    pick = {"action": 1, "reason": 2, "confidence": 3}[what]
    rows = [
        ("type = 'plot'", "'LLM: convert plot to CSV'", "'plot digitization requires semantic understanding'", "0.8::DOUBLE"),
        (
            "type IN ('block_diagram', 'state_machine', 'timing_diagram')",
            "'LLM: convert diagram to ASCII/Mermaid'",
            "'diagram interpretation is not reliable locally'",
            "0.8::DOUBLE",
        ),
        (
            "type IN ('register_map', 'pinout', 'schematic', 'table_image', 'wiring_diagram')",
            "'LLM: describe complex figure'",
            "type || ' requires detailed external analysis'",
            "0.8::DOUBLE",
        ),
        ("notes = 'needs_external'", "'LLM: describe image'", "'local LLM could not resolve this figure'", "0.7::DOUBLE"),
        ("notes = 'LLM recommended'", "'LLM: describe image'", "'insufficient local text extraction'", "0.7::DOUBLE"),
    ]
    default = ("", "'none'", "'local extraction sufficient'", "0.6::DOUBLE")[pick]
    return "CASE " + " ".join(f"WHEN {r[0]} THEN {r[pick]}" for r in rows) + f" ELSE {default} END"


def tag_list(text: str, terms: tuple[str, ...]) -> str:
    each = " || ".join(
        f"CASE WHEN contains(lower({text}), '{t}') THEN '{t}|' ELSE '' END" for t in sorted(terms)
    )
    return f"rtrim({each}, '|')"


CORPUS_TAGS = ("tion", "the", "eau", "sch", "ing", "ción")
DEFAULT_TAGS = ("i2c", "dac", "adc", "voltage", "timing", "state", "register", "pin", "power")

ENTRIES = (
    FOLDED
    + f""",
entries AS (
  SELECT *, {advice('action')} AS action, {advice('reason')} AS reason,
    {advice('confidence')} AS confidence, {tag_list('caption', CORPUS_TAGS)} AS tags FROM folded)
"""
)

LOG = """
log AS (
  SELECT user_id AS doc_id, printf('fig_%04d', (props->>'$.k')::BIGINT + 1) AS figure_id,
    event_id, ts, event_type AS local_llm_classification, 'note ' || event_type AS local_llm_description,
    printf('img/%d/%d.png', user_id, (props->>'$.k')::BIGINT + 1) AS image_path,
    CASE event_type WHEN 'error' THEN 'needs_external' WHEN 'view' THEN 'resolved_local'
      WHEN 'click' THEN 'resolved_local' WHEN 'purchase' THEN 'resolved_external'
      ELSE 'unknown' END AS status
  FROM events),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, figure_id
                                             ORDER BY ts DESC, event_id DESC) AS rn FROM log)
  WHERE rn = 1)
"""


def counts() -> str:
    return """count(*) AS total_figures,
    count(*) FILTER (status = 'resolved_local') AS resolved_local,
    count(*) FILTER (status = 'resolved_external') AS resolved_external,
    count(*) FILTER (status = 'needs_external') AS needs_external,
    count(*) FILTER (status IN ('resolved_local', 'resolved_external')) AS fully_processed,
    count(*) FILTER (status = 'needs_external') AS pending_external,
    round_even(100.0::DOUBLE * count(*) FILTER (status IN ('resolved_local', 'resolved_external'))
      / greatest(count(*), 1), 1) AS percent_complete"""


APPLIED = (
    STATUSES
    + """,
done AS (
  SELECT doc_id, unnest(['fig_0002', 'fig_0003']) AS figure_id, unnest([2, 1]) AS version,
    CASE WHEN quality = 1 THEN 'provider-a' ELSE '' END AS provider FROM labels),
applied AS (
  SELECT s.doc_id, s.figure_id, s.image_path, s.confidence, s.local_llm_description,
    s.local_llm_classification,
    CASE WHEN d.doc_id IS NOT NULL THEN 'resolved_external' ELSE s.status END AS status,
    CASE WHEN d.doc_id IS NOT NULL THEN false ELSE s.status = 'needs_external' END AS needs_external,
    coalesce(d.provider, '') AS external_llm_provider,
    coalesce('model-' || d.version::VARCHAR, '') AS external_llm_model, d.version
  FROM statuses s LEFT JOIN done d USING (doc_id, figure_id))
"""
)

TABLES = f"""
tabs AS (
  SELECT doc_id, 'table_0001' AS id, lang || ' ' || source AS caption, text,
    list_transform(string_split(text, {NL}), lambda l: string_split(l, ' ')) AS grid FROM documents)
"""

# --- sources -----------------------------------------------------------------

add(
    "source_manifest",
    """SELECT doc_id, source || '/' || doc_id || '.txt' AS path, sha256(text) AS sha256,
  strlen(text)::BIGINT AS size FROM documents""",
)

NAMES = r"""
names AS (
  SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS name FROM pages),
stems AS (SELECT page_id, name, CASE WHEN regexp_matches(name, '^.+\.[^.]*$')
  THEN regexp_extract(name, '^(.+)\.[^.]*$', 1) ELSE name END AS stem FROM names)
"""
add(
    "stem_collisions",
    f"WITH {NAMES} SELECT stem, count(*) AS sources FROM stems GROUP BY stem HAVING count(*) > 1",
)
add("file_names", f"WITH {NAMES} SELECT page_id, name, stem FROM stems")

TAG_NAMES = (
    "h1|h2|h3|h4|h5|h6|title|p|li|ul|ol|dl|dt|dd|div|nav|article|section|header|footer|main|aside|"
    "table|thead|tbody|tr|td|th|caption|figure|figcaption|blockquote|pre|br|hr|head|body|html"
)
VISIBLE = r"""regexp_replace(translate(html, chr(1) || chr(2), ''),
  '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>', '', 'gis')"""


def unescape(x: str) -> str:
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&apos;", "''"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def plain(x: str) -> str:
    no_tags = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    return f"trim(regexp_replace({unescape(no_tags)}, '[\\s\\x0b]+', ' ', 'g'))"


add(
    "page_blocks",
    f"""WITH cut AS (
  SELECT page_id, regexp_replace({VISIBLE}, '<(/?(?:{TAG_NAMES}))\\b[^>]*>',
    chr(1) || '\\1' || chr(2), 'gi') AS m FROM pages),
parts AS (
  SELECT page_id, unnest(string_split(m, chr(1))) AS p,
    generate_subscripts(string_split(m, chr(1)), 1) AS n FROM cut),
parsed AS (
  SELECT page_id, n, CASE WHEN contains(p, chr(2)) THEN lower(split_part(p, chr(2), 1)) ELSE '' END AS tag,
    {plain("CASE WHEN contains(p, chr(2)) THEN split_part(p, chr(2), 2) ELSE p END")} AS text FROM parts)
SELECT page_id AS doc_id, row_number() OVER (PARTITION BY page_id ORDER BY n) AS ord, tag, text,
  CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN substr(tag, 2, 1)::INTEGER END AS level
FROM parsed WHERE text <> ''""",
)

CUT_LINKS = f"""regexp_replace(regexp_replace({VISIBLE}, '(?i)</a\\s*>', chr(3), 'g'),
  '(?i)<a\\b([^>]*)>', chr(1) || '\\1' || chr(2), 'g')"""
add(
    "page_links_as_figures",
    f"""WITH cut AS (SELECT page_id, string_split({CUT_LINKS}, chr(1))[2:] AS a FROM pages),
piece AS (SELECT page_id, unnest(a) AS p, generate_subscripts(a, 1) AS n FROM cut),
each_link AS (SELECT page_id, n, regexp_extract(split_part(p, chr(2), 1), '(?i)\\shref="([^"]*)"', 1) AS href,
  split_part(split_part(p, chr(2), 2), chr(3), 1) AS t FROM piece)
SELECT page_id AS doc_id, row_number() OVER (PARTITION BY page_id ORDER BY n) AS ord,
  {unescape("href")} AS image_path, {plain("t")} AS caption FROM each_link WHERE href <> ''""",
)

WORDS_OF = "list_filter(regexp_split_to_array({0}, '[\\s\\x0b]+'), lambda w: w <> '')"
LINE_WORDS = "array_to_string(" + WORDS_OF.format("l") + ", ' ')"
add(
    "page_tables",
    f"""WITH g AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, {NL}), lambda l: {LINE_WORDS}),
    lambda x: x <> '') AS rows FROM documents)
SELECT doc_id, 1 AS ord, rows[1] AS header, len(rows) - 1 AS n_rows,
  array_to_string(rows[2:], {NL}) AS body FROM g""",
)
add(
    "page_images",
    """SELECT conv_id || '-' || turn AS doc_id, 1 AS ord, 'img/' || conv_id || '.png' AS image_path,
  trim(regexp_replace(text, '\\s+', ' ', 'g')) AS caption, length(text) AS width,
  NULL::INTEGER AS height FROM conversations""",
)

# --- normalization -----------------------------------------------------------

add(
    "normalize_blocks",
    f"""WITH {BLOCKS}
SELECT doc_id, printf('blk_%04d', ord) AS id, 'text' AS type, page,
  CASE WHEN length(text) > 40 THEN printf('%d.0,0.0,1.0,2.0', page) ELSE '0.0,0.0,0.0,0.0' END AS bbox,
  CASE WHEN length(text) > 40 THEN text ELSE '' END AS text, '' AS enriched_text,
  CASE WHEN length(text) > 40 THEN 'head' ELSE '' END AS headings, NULL::INTEGER AS heading_level
FROM blocks""",
)
add(
    "normalize_tables",
    f"""SELECT doc_id, 'table_0001' AS id, 1 AS page, lang || ' ' || source AS caption,
  {tag_list("(lang || ' ' || source)", CORPUS_TAGS)} AS tags, len(string_split(text, {NL})) AS n_rows,
  md5(text) AS grid_md5, 'out/' || doc_id || '/tables/table_0001.md' AS markdown_path,
  'out/' || doc_id || '/tables/table_0001.csv' AS csv_path,
  'out/' || doc_id || '/tables/table_0001.json' AS json_path FROM documents""",
)

TALK = """
talk AS (
  SELECT conv_id AS doc_id, 2 * turn AS ord, 1 + turn // 2 AS page, text AS caption,
    CASE WHEN right(text, 1) IN ('.', '!', '?') THEN printf('img/%d/%d.png', conv_id, turn) END AS image_path,
    length(text) AS width, turn + 4 AS height,
    printf('fig_%04d', row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS figure_id
  FROM conversations)
"""
add(
    "normalize_figures",
    f"""WITH {TALK}
SELECT doc_id, figure_id, page, caption, {tag_list('caption', CORPUS_TAGS)} AS tags,
  coalesce(image_path, '') AS image_path, width, height, '0.0,0.0,0.0,0.0' AS bbox FROM talk""",
)
add(
    "assign_ids",
    """SELECT user_id, event_id,
  printf('evt_%04d', row_number() OVER (PARTITION BY user_id ORDER BY event_id)) AS id FROM events""",
)
add(
    "first_and_min_page",
    f"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, {NL}), lambda l: length(l)),
  lambda n: n > 80) AS known FROM documents)
SELECT doc_id, coalesce(known[1], 1) AS first_page, coalesce(list_min(known), 1) AS min_page FROM p""",
)
add(
    "resolve_caption",
    f"""WITH p AS (SELECT doc_id, source, unnest(string_split(text, {NL})) AS f,
  generate_subscripts(string_split(text, {NL}), 1) - 1 AS line FROM documents)
SELECT doc_id, line, CASE WHEN length(f) > 60 THEN f WHEN length(f) > 30 THEN source ELSE '' END AS caption
FROM p""",
)
add(
    "new_status",
    f"""WITH {FIGURES}
SELECT doc_id, figure_id, image_path, 'needs_external' AS status, '' AS stage,
  'ollama' AS local_llm_provider, 'local-model' AS local_llm_model, '' AS local_llm_description,
  '' AS local_llm_classification, '' AS external_llm_provider, '' AS external_llm_model,
  NULL::VARCHAR AS external_llm_result, true AS needs_external, 0.0::DOUBLE AS confidence,
  '' AS processed_at FROM figures""",
)

# --- filters -----------------------------------------------------------------

add(
    "filter_pages",
    f"WITH {BLOCKS} SELECT doc_id, ord, page, text FROM blocks WHERE page IN (1, 3, 4, 5)",
)
add(
    "filter_pages_by_spec",
    f"""WITH {BLOCKS}
SELECT b.doc_id, b.ord, b.page, b.text FROM blocks b LEFT JOIN labels l USING (doc_id)
WHERE l.doc_id IS NULL OR l.toxic = 1
  OR (l.quality = 1 AND b.page IN (1, 2, 4)) OR (l.quality <> 1 AND b.page = 2)""",
)
add(
    "limit_per_document",
    f"WITH {FIGURES} SELECT doc_id, figure_id, caption FROM figures WHERE ord <= 3",
)
add(
    "drop_imageless",
    f"WITH {TALK} SELECT doc_id, figure_id, image_path FROM talk WHERE image_path IS NOT NULL",
)
add(
    "noise_figures",
    f"WITH {FIGURES} SELECT doc_id, figure_id, width, height FROM figures WHERE width * height < 500",
)
add(
    "valid_descriptions",
    f"""WITH {BLOCKS}, every AS (
  SELECT 'document' AS kind, doc_id AS id, 0 AS pos, text FROM documents
  UNION ALL SELECT 'line', doc_id, ord, text FROM blocks
  UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations)
SELECT kind, id, pos, {valid('text')} AS valid FROM every""",
)

# --- chunking ----------------------------------------------------------------

# Newest heading of each level, then drop those older than a newer heading of a lower level.
HEADED = (
    BLOCKS
    + """,
leveled AS (
  SELECT *, CASE WHEN length(text) <= 40 THEN 1 WHEN length(text) <= 60 THEN 2
                 WHEN length(text) <= 80 THEN 3 END AS level FROM blocks),
newest AS (
  SELECT *,
    coalesce(max(CASE WHEN level = 1 THEN ord END) OVER w, -1) AS p1,
    coalesce(max(CASE WHEN level = 2 THEN ord END) OVER w, -1) AS p2,
    coalesce(max(CASE WHEN level = 3 THEN ord END) OVER w, -1) AS p3
  FROM leveled WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
headed AS (
  SELECT n.doc_id, n.ord, n.page, n.text, greatest(n.p1, n.p2, n.p3, 0) AS section,
    concat_ws(chr(10), h1.text, h2.text, h3.text) AS headings
  FROM newest n
  LEFT JOIN blocks h1 ON h1.doc_id = n.doc_id AND h1.ord = n.p1
  LEFT JOIN blocks h2 ON h2.doc_id = n.doc_id AND h2.ord = n.p2 AND n.p2 > n.p1
  LEFT JOIN blocks h3 ON h3.doc_id = n.doc_id AND h3.ord = n.p3 AND n.p3 > n.p2 AND n.p3 > n.p1
  WHERE n.level IS NULL)
"""
)
add("heading_path", f"WITH {HEADED} SELECT doc_id, ord, section, headings FROM headed")
add(
    "enriched_text",
    f"""WITH {HEADED} SELECT doc_id, ord, CASE WHEN section > 0
  THEN headings || chr(10) || chr(10) || text ELSE text END AS enriched_text FROM headed""",
)

add(
    "chunk_tokens",
    f"""WITH {HEADED},
toks AS (
  SELECT doc_id, section, headings, page, ord, unnest(w) AS t, generate_subscripts(w, 1) AS i
  FROM (SELECT *, {WORDS_OF.format('text')} AS w FROM headed)),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY doc_id, section ORDER BY ord, i) - 1) // 64 AS chunk FROM toks)
SELECT doc_id, section, chunk, min(page) AS page, min(ord) AS first_ord, count(*) AS n_tokens,
  any_value(headings) AS headings, string_agg(t, ' ' ORDER BY ord, i) AS text
FROM placed GROUP BY doc_id, section, chunk""",
)

add(
    "chunk_greedy",
    f"""WITH RECURSIVE {HEADED},
toks AS (
  SELECT doc_id, section, headings, page, ord, unnest(w) AS t, generate_subscripts(w, 1) AS i
  FROM (SELECT *, {WORDS_OF.format('text')} AS w FROM headed)),
pieces AS (
  SELECT doc_id, section, ord, (i - 1) // 64 AS part, any_value(headings) AS headings,
    min(page) AS page, count(*) AS n, string_agg(t, ' ' ORDER BY i) AS piece
  FROM toks GROUP BY doc_id, section, ord, part),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY ord, part) AS k FROM pieces),
packed AS (
  SELECT doc_id, section, k, n AS used, 0::BIGINT AS chunk FROM numbered WHERE k = 1
  UNION ALL
  SELECT x.doc_id, x.section, x.k, CASE WHEN p.used + x.n > 64 THEN x.n ELSE p.used + x.n END,
    CASE WHEN p.used + x.n > 64 THEN p.chunk + 1 ELSE p.chunk END
  FROM packed p JOIN numbered x ON x.doc_id = p.doc_id AND x.section = p.section AND x.k = p.k + 1)
SELECT doc_id, section, chunk, min(page) AS page, min(ord) AS first_ord, sum(n)::BIGINT AS n_tokens,
  any_value(headings) AS headings, string_agg(piece, ' ' ORDER BY k) AS text
FROM packed JOIN numbered USING (doc_id, section, k) GROUP BY doc_id, section, chunk""",
)

# --- classification ----------------------------------------------------------

BY_RULES = f"""WITH {FIGURES}, h AS (SELECT *, caption || ' ' || coalesce(reply, '') AS hay FROM figures)
SELECT doc_id, ord, {figure_rules('caption', 'hay', 'type')} AS type,
  {figure_rules('caption', 'hay', 'confidence')} AS confidence,
  {figure_rules('caption', 'hay', 'rationale')} AS rationale FROM h"""
add("classify_by_rules", BY_RULES)
add("classify_by_rule_table", BY_RULES)

MANY_RULES = """
words AS (
  SELECT item_id, unnest(string_split(text, ' ')) AS word,
    generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM benchmark),
rules AS (
  SELECT item_id * 100000 + pos AS priority, lower(word) AS needle, pos % 5 = 0 AS caption_only, item_id
  FROM words WHERE length(word) >= 5),
m AS (
  SELECT doc_id, ord, min((NOT caption_only)::BIGINT * 1000000000000 + priority) AS rank
  FROM h JOIN rules ON contains(CASE WHEN caption_only THEN c ELSE t END, needle) GROUP BY ALL),
best AS (
  SELECT h.*, coalesce('item_' || item_id, 'other') AS type,
    CASE WHEN item_id IS NULL THEN 0.4 ELSE 0.5 END::DOUBLE AS confidence,
    coalesce(needle, 'no rule matched') AS rationale
  FROM h LEFT JOIN m USING (doc_id, ord) LEFT JOIN rules ON priority = rank % 1000000000000)"""
add(
    "classify_by_many_rules",
    f"""WITH {FIGURES}, h AS (
  SELECT doc_id, ord, lower(caption) AS c, lower(caption || ' ' || coalesce(reply, '')) AS t FROM figures),
{MANY_RULES} SELECT doc_id, ord, type, confidence, rationale FROM best""",
)
add(
    "classify_figures_by_table",
    f"""WITH {FIGURES}, {RULED}, h AS (
  SELECT doc_id, ord, figure_id, lower(coalesce(caption, '')) AS c, lower(hay) AS t FROM r0),
{MANY_RULES} SELECT doc_id, figure_id, type, rationale FROM best""",
)

add(
    "classify_default_rules",
    """WITH h AS (SELECT doc_id, lower(source) AS c, lower(source || ' ' || text) AS t FROM documents),
k AS (SELECT doc_id, CASE WHEN contains(c, 'table') THEN 0 WHEN contains(t, 'timing') THEN 1
  WHEN contains(t, 'state') THEN 2 WHEN contains(t, 'block diagram') THEN 3
  WHEN contains(t, 'schematic') THEN 4 WHEN contains(t, 'plot') THEN 5
  WHEN contains(t, 'graph') THEN 6 WHEN contains(t, 'waveform') THEN 7 ELSE 8 END AS n FROM h)
SELECT doc_id, 1 AS ord,
  ['table_image', 'timing_diagram', 'state_machine', 'block_diagram', 'block_diagram', 'plot',
   'plot', 'timing_diagram', 'other'][n + 1] AS type,
  [0.75, 0.92, 0.88, 0.9, 0.72, 0.85, 0.8, 0.82, 0.4][n + 1]::DOUBLE AS confidence,
  ['caption suggests table in image', 'caption mentions timing', 'caption mentions state',
   'caption mentions block diagram', 'schematic-like wording', 'caption mentions plot',
   'caption mentions graph', 'caption mentions waveform', 'no rule matched'][n + 1] AS rationale
FROM k""",
)
add(
    "extract_tags",
    f"""SELECT doc_id, {tag_list("(text || ' ' || source)", CORPUS_TAGS)} AS tags,
  {tag_list('text', DEFAULT_TAGS)} AS default_tags FROM documents""",
)

DEFAULT_INFER = [
    ("logo", ["logo"]),
    ("icon", ["icon", "symbol", "arrow"]),
    ("pinout", ["pin"]),
    ("schematic", ["schematic", "circuit diagram"]),
    ("timing_diagram", ["timing", "waveform", "clock"]),
    ("state_machine", ["state machine", "state diagram", "flowchart"]),
    ("register_map", ["register", "bit field"]),
    ("block_diagram", ["block diagram", "functional block"]),
    ("wiring_diagram", ["wiring", "hookup", "connection diagram"]),
    ("plot", ["plot", "graph", "chart", "x-axis", "y-axis", "linearity", "error", "vs"]),
    ("table_image", ["table", "row", "column", "header"]),
    ("block_diagram", ["circuit board", "inputs and outputs", "chip diagram"]),
    ("photo", ["photo", "pcb", "board", "chip"]),
    ("screenshot", ["screenshot", "ide", "terminal", "oscilloscope"]),
    ("mechanical", ["package", "dimension", "footprint", "mechanical"]),
]


def default_infer(text: str) -> str:
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({text}), '{n}')" for n in needles) + f" THEN '{label}'"
        for label, needles in DEFAULT_INFER
    )
    return f"CASE {branches} ELSE 'other' END"


add(
    "infer_class",
    f"""WITH {BLOCKS} SELECT doc_id, ord, {infer('text')} AS label,
  {default_infer('text')} AS default_label FROM blocks""",
)
add(
    "route_local",
    f"""WITH {BLOCKS}, l AS (SELECT *, {infer('text')} AS cls FROM blocks)
SELECT doc_id, ord, {resolved('cls', 'text')} AS resolved FROM l""",
)
add("page_context", f"WITH {BLOCKS}, {CONTEXT} SELECT doc_id, page, context FROM ctx")
add(
    "classify_figures",
    f"WITH {FIGURES}, {RULED} SELECT doc_id, figure_id, type, class_confidence, rationale FROM ruled",
)
add(
    "baseline_description",
    f"""WITH {FIGURES}, {RULED}
SELECT doc_id, figure_id, description, description_confidence, notes FROM based""",
)
STATUS_COLUMNS = """doc_id, figure_id, image_path, status, stage, 'ollama' AS local_llm_provider,
  'local-model' AS local_llm_model, local_llm_description, local_llm_classification,
  status = 'needs_external' AS needs_external, confidence"""
add("triage_figures", f"WITH {STATUSES} SELECT {STATUS_COLUMNS} FROM statuses")
TALK_REPLIES = """(SELECT t.*, a.text AS reply FROM talk t LEFT JOIN conversations a
    ON a.conv_id = t.doc_id AND a.turn = t.ord // 2 + 1)"""
add(
    "triage_conversations",
    f"WITH {TALK}, {triaged(TALK_REPLIES)} SELECT {STATUS_COLUMNS} FROM fresh",
)
STAND_IN = """(SELECT *, 'A board seen at ' || image_path || ' in this picture' AS reply FROM talk)"""
add(
    "describe_then_triage",
    f"""WITH {TALK}, {triaged(STAND_IN, label_fn=default_infer)}
SELECT doc_id, figure_id, status, stage, local_llm_description, local_llm_classification, confidence
FROM fresh""",
)
add(
    "recommend_action",
    f"""WITH {FOLDED} SELECT doc_id, figure_id, {advice('action')} AS action,
  {advice('reason')} AS reason, {advice('confidence')} AS confidence FROM folded""",
)
add(
    "report_entries",
    f"""WITH {ENTRIES} SELECT doc_id, figure_id, page, caption, tags, image_path, type,
  class_confidence, rationale, action AS recommended_manual_action, reason, confidence FROM entries""",
)

# --- joins -------------------------------------------------------------------

add(
    "fold_statuses",
    f"""WITH {FOLDED} SELECT doc_id, figure_id, page, type, class_confidence, rationale, description,
  description_confidence, notes FROM folded""",
)
add(
    "orphan_artifacts",
    f"""WITH {FIGURES} SELECT doc_id, printf('out/%d/figures/%d.png', doc_id, ord) AS path
FROM figures WHERE image_path IS NULL""",
)
add(
    "external_queue",
    f"""WITH {FIGURES}, {LOG}
SELECT f.doc_id, f.figure_id, f.image_path FROM figures f
LEFT JOIN latest s ON s.doc_id = f.doc_id AND s.figure_id = f.figure_id
WHERE coalesce(s.status, 'needs_external') = 'needs_external'
  AND NOT (f.ord = 2 AND f.doc_id IN (SELECT doc_id FROM labels))""",
)
add(
    "restrict_to_ids",
    f"""WITH {FIGURES} SELECT doc_id, figure_id, caption FROM figures
WHERE ord = 2 AND doc_id IN (SELECT doc_id FROM labels)""",
)
add(
    "apply_external",
    f"""WITH {APPLIED} SELECT doc_id, figure_id, status, needs_external, external_llm_provider,
  external_llm_model, version FROM applied""",
)


def audit(report: str) -> str:
    return f"""
audit AS (
  SELECT coalesce(r.doc_id, s.doc_id) AS doc_id, coalesce(r.figure_id, s.figure_id) AS figure_id,
    r.type AS report_class, s.local_llm_classification AS status_class, r.action, s.status,
    CASE WHEN r.type IS NULL OR s.status IS NULL THEN 'missing'
         WHEN coalesce(s.local_llm_classification, '') <> ''
           AND r.type IS DISTINCT FROM s.local_llm_classification THEN 'class'
         WHEN s.status = 'needs_external' AND r.action = 'none' THEN 'routing' END AS issue
  FROM {report} r FULL JOIN statuses s ON r.doc_id = s.doc_id AND r.figure_id = s.figure_id)
SELECT * FROM audit WHERE issue IS NOT NULL"""


add("audit_consistency", f"WITH {ENTRIES}, {audit('entries')}")
add(
    "audit_unfolded",
    f"""WITH {STATUSES}, {RULED}, unfolded AS (SELECT *, {advice('action')} AS action FROM based),
{audit('unfolded')}""",
)

# --- aggregates --------------------------------------------------------------

add(
    "doc_stats",
    f"""WITH {FIGURES}
SELECT d.doc_id, ceil(len(string_split(d.text, {NL})) / 5)::BIGINT AS page_count,
  count(*) FILTER (f.page BETWEEN 2 AND 4) AS block_count, 0::BIGINT AS table_count,
  count(*) FILTER (f.page BETWEEN 2 AND 4 AND f.image_path IS NOT NULL) AS figure_count
FROM documents d JOIN figures f USING (doc_id) GROUP BY d.doc_id, d.text""",
)
add("status_rollup", f"WITH {STATUSES} SELECT doc_id, {counts()} FROM statuses GROUP BY doc_id")
add(
    "status_rollup_global",
    f"""WITH {LOG} SELECT doc_id, grouping(doc_id) AS is_global, {counts()} FROM latest
GROUP BY ROLLUP (doc_id)""",
)
add(
    "rollup_after_external",
    f"""WITH {APPLIED} SELECT doc_id, grouping(doc_id) AS is_global, {counts()} FROM applied
GROUP BY ROLLUP (doc_id)""",
)
DETAIL = """CASE WHEN status = 'needs_external' THEN image_path END AS image_path,
  CASE WHEN status <> 'resolved_external' THEN left(local_llm_description, 120) END AS description"""
add(
    "rollup_detail",
    f"""WITH {STATUSES} SELECT doc_id, status, figure_id, local_llm_classification AS classification,
  {DETAIL} FROM statuses""",
)

CLASSES = (
    "['plot','table_image','timing_diagram','block_diagram','state_machine','schematic','pinout',"
    "'register_map','wiring_diagram','photo','mechanical','screenshot','other','noise','sketch']"
)
ANALYSES = f"""
analysed AS (
  SELECT conv_id AS doc_id, turn, printf('fig_%04d', turn) AS figure_id, role, text,
    {CLASSES}[length(text) % 15 + 1] AS classification, {WORDS_OF.format('text')} AS w
  FROM conversations),
ws AS (
  SELECT doc_id, figure_id, classification, role, len(w) AS n, unnest(w) AS word,
    generate_subscripts(w, 1) - 1 AS i, w FROM analysed)
"""
add(
    "class_breakdown",
    f"""WITH {STATUSES}, {ANALYSES}
SELECT 'local' AS source, status, local_llm_classification AS classification, count(*) AS figures
FROM statuses GROUP BY 2, 3
UNION ALL
SELECT 'external', 'resolved_external', classification, count(*) FROM analysed GROUP BY 3""",
)
add(
    "class_breakdown_wide",
    f"""WITH {STATUSES} SELECT local_llm_classification AS classification,
  count(*) FILTER (status = 'resolved_local') AS resolved_local,
  count(*) FILTER (status = 'needs_external') AS needs_external,
  count(*) FILTER (status = 'resolved_external') AS resolved_external
FROM statuses GROUP BY 1""",
)
add(
    "smoke_checks",
    f"""WITH {FIGURES},
per AS (
  SELECT d.doc_id, coalesce(l.quality, 1) AS quality, coalesce(l.toxic, 0) AS toxic,
    (SELECT count(*) FROM figures f WHERE f.doc_id = d.doc_id) AS figs,
    (SELECT count(f.image_path) FROM figures f WHERE f.doc_id = d.doc_id) AS images
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, 'missing document' AS failure FROM per WHERE quality <> 1
UNION ALL SELECT doc_id, 'missing index' FROM per WHERE quality = 1 AND toxic <> 0
UNION ALL SELECT doc_id, 'empty extraction' FROM per WHERE quality = 1 AND toxic = 0 AND figs = 0
UNION ALL SELECT doc_id, 'figures missing image' FROM per
  WHERE quality = 1 AND toxic = 0 AND figs > 0 AND images = 0""",
)
LATEST = "SELECT doc_id, figure_id, event_id, status, local_llm_classification FROM latest"
add("latest_status", f"WITH {LOG} {LATEST}")
add(
    "all_items",
    f"""WITH {BLOCKS}
SELECT doc_id, 'block' AS kind, printf('blk_%04d', ord) AS id, page FROM blocks
UNION ALL SELECT doc_id, 'table', 'table_0001', 1 FROM documents
UNION ALL SELECT doc_id, 'figure', printf('fig_%04d', ord), page FROM blocks""",
)

# --- exports -----------------------------------------------------------------

add(
    "assemble_documents",
    f"""WITH s AS (SELECT *, string_split(text, {NL}) AS l FROM documents)
SELECT doc_id, 0 AS part, sha256(text) AS sha256, len(l) AS block_count, len(l) AS n_blocks,
  1 AS n_tables, len(l) AS n_figures, 'blk_0001' AS first_block,
  printf('fig_%04d', len(l)) AS last_figure, md5(text) AS blocks_md5, md5(text) AS figures_md5 FROM s""",
)
add(
    "artifact_index",
    f"""WITH {FIGURES}
SELECT doc_id, 'source' AS kind, 0 AS ord, source || '/' || doc_id || '.txt' AS path FROM documents
UNION ALL SELECT doc_id, 'document', 0, 'out/' || doc_id || '/document.json' FROM documents
UNION ALL SELECT doc_id, 'directory', 0, 'out/' || doc_id FROM documents
UNION ALL SELECT doc_id, 'table', 1, 'out/' || doc_id || '/tables/table_0001.json' FROM documents
UNION ALL SELECT doc_id, 'figure', ord, image_path FROM figures WHERE image_path IS NOT NULL""",
)
add(
    "index_records",
    f"""WITH {FIGURES}, p AS (
  SELECT doc_id, string_agg(image_path, '|' ORDER BY ord) AS paths FROM figures GROUP BY doc_id)
SELECT doc_id, 0 AS part, 'out/' || doc_id || '/document.json' AS document_json,
  coalesce(paths, '') AS figures, 'out/' || doc_id || '/tables/table_0001.json' AS tables FROM p""",
)
add(
    "table_to_json",
    f"WITH {TABLES} SELECT doc_id, id, caption, md5(text) AS grid_md5 FROM tabs",
)
CELL = "CASE WHEN regexp_matches(c, '[,\"\\n]') THEN '\"' || replace(c, '\"', '\"\"') || '\"' ELSE c END"
add(
    "table_to_csv",
    f"""WITH {TABLES} SELECT doc_id, id, array_to_string(list_transform(grid,
  lambda r: array_to_string(list_transform(r, lambda c: {CELL}), ',')), {NL}) || {NL} AS csv FROM tabs""",
)
add(
    "table_to_markdown",
    f"""WITH {TABLES}, w AS (SELECT *, len(grid[1]) AS n FROM tabs)
SELECT doc_id, id, '| ' || array_to_string(grid[1], ' | ') || ' |' || {NL}
  || '| ' || array_to_string(list_transform(range(n), lambda i: '---'), ' | ') || ' |' || {NL}
  || coalesce(array_to_string(list_transform(grid[2:], lambda r:
       '| ' || array_to_string(list_transform(range(1, n + 1), lambda i: coalesce(r[i], '')), ' | ')
       || ' |' || {NL}), ''), '') AS markdown FROM w""",
)
add(
    "table_cells_long",
    f"""WITH {TABLES},
rs AS (SELECT doc_id, id, grid[1] AS head, unnest(grid) AS cells, generate_subscripts(grid, 1) - 1 AS row FROM tabs),
cs AS (SELECT doc_id, id, head, row, unnest(cells) AS value, generate_subscripts(cells, 1) AS c FROM rs)
SELECT doc_id, id, row, c - 1 AS col, head[c] AS header, value FROM cs""",
)
ROWS = """
rows_ AS (
  SELECT user_id AS doc_id, event_id, event_type, props,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS row FROM events)
"""
add(
    "table_rows_to_csv",
    f"""WITH {ROWS} SELECT doc_id, row, event_id || ',' || event_type || ',"'
  || replace(props, '"', '""') || '"' AS line FROM rows_""",
)
add(
    "table_rows_to_markdown",
    f"""WITH {ROWS} SELECT doc_id, row, 0 AS line_no,
  '| ' || event_id || ' | ' || event_type || ' | ' || props || ' |' AS line FROM rows_
UNION ALL SELECT doc_id, row, 1, '| --- | --- | --- |' FROM rows_ WHERE row = 0""",
)
add(
    "figure_markdown",
    f"""WITH {FOLDED} SELECT doc_id, figure_id,
  '# ' || figure_id || {NL} || {NL} || description || {NL} AS description_md, figure_id AS meta_id,
  caption AS meta_caption, type AS meta_type FROM folded""",
)
add(
    "report_markdown",
    f"""WITH {ENTRIES}, body AS (
  SELECT doc_id, ord, ['## ' || figure_id, '- page: ' || page, '- caption: ' || caption,
    '- image_path: ' || image_path,
    '- classification: ' || type || ' (' || class_confidence || ')',
    '- recommended_manual_action: ' || action, '- reason: ' || reason, ''] AS l FROM entries)
SELECT doc_id, 0 AS section, 0 AS ord, unnest([0, 1]) AS line_no,
  unnest(['# Manual Processing Report', '']) AS line FROM documents
UNION ALL
SELECT doc_id, 1, ord, generate_subscripts(l, 1) - 1, unnest(l) FROM body""",
)
add(
    "global_report_markdown",
    f"""WITH {ENTRIES}
SELECT NULL::BIGINT AS doc_id, 0 AS section, 0 AS ord, unnest([0, 1]) AS line_no,
  unnest(['# Global Manual Processing Report', '']) AS line
UNION ALL
SELECT doc_id, 1, ord, 0, '- ' || figure_id || ': ' || action FROM entries""",
)


def rollup_lines(source: str) -> str:
    shown = "left(replace(left(local_llm_description, 120), chr(10), ' '), 80)"
    return f"""
st AS (SELECT *, right(figure_id, 4)::BIGINT AS n, {shown} AS d,
         '- `' || figure_id || '` [' || local_llm_classification || ']' AS name FROM {source}),
tot AS (SELECT doc_id, {counts()} FROM st GROUP BY doc_id),
head AS (SELECT doc_id, ['# Figure Processing Rollup', '', '**Total figures:** ' || total_figures,
   '**Resolved locally:** ' || resolved_local, '**Resolved by external LLM:** ' || resolved_external,
   '**Pending external LLM:** ' || pending_external, '**Completion:** ' || percent_complete || '%',
   '', '---', ''] AS l FROM tot),
parts AS (
  SELECT doc_id, 0 AS section, 0::BIGINT AS ord, l FROM head
  UNION ALL SELECT doc_id, 1, -1, ['## Resolved locally (' || resolved_local || ')', '']
    FROM tot WHERE resolved_local > 0
  UNION ALL SELECT doc_id, 2, -1, ['## Needs external LLM (' || needs_external || ')', '',
    'Use the prompt template for external analysis.', ''] FROM tot WHERE needs_external > 0
  UNION ALL SELECT doc_id, 3, -1, ['## Resolved by external LLM (' || resolved_external || ')', '']
    FROM tot WHERE resolved_external > 0
  UNION ALL SELECT doc_id, 1, n, [name || ' ' || d] FROM st WHERE status = 'resolved_local'
  UNION ALL SELECT doc_id, 2, n, CASE WHEN d = '' THEN [name || ' → `' || image_path || '`']
    ELSE [name || ' → `' || image_path || '`', '  ' || d] END FROM st WHERE status = 'needs_external'
  UNION ALL SELECT doc_id, 3, n, [name] FROM st WHERE status = 'resolved_external'),
listed AS (
  SELECT doc_id, n, CASE status WHEN 'resolved_local' THEN 1 WHEN 'needs_external' THEN 2
    WHEN 'resolved_external' THEN 3 END AS section FROM st),
lines AS (
  SELECT doc_id, section, ord, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM parts
  UNION ALL SELECT doc_id, section, max(n), 2, '' FROM listed WHERE section IS NOT NULL GROUP BY doc_id, section)
"""


add("rollup_markdown", f"WITH {APPLIED}, {rollup_lines('applied')} SELECT * FROM lines")
add(
    "rollup_markdown_text",
    f"""WITH {LOG}, {rollup_lines('latest')}
SELECT doc_id, section, ord // 10000 AS part, string_agg(line, {NL} ORDER BY ord, line_no) AS text
FROM lines GROUP BY doc_id, section, part""",
)

# --- scalar functions --------------------------------------------------------

add(
    "csv_escape",
    """SELECT event_id, '"' || replace(props, '"', '""') || '"' AS cell FROM events""",
)
add(
    "text_counts",
    f"""SELECT doc_id, length(regexp_replace(text, '{PRINTABLE}', '', 'g')) AS printable,
  length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters,
  regexp_replace(text, '{WHITE}', '', 'g') = '' AS blank, length({strip('text')}) AS stripped FROM documents""",
)
add(
    "percent_complete",
    """SELECT user_id, round_even(100.0::DOUBLE * count(*) FILTER (event_type = 'error') / count(*), 1)
  AS percent FROM events GROUP BY user_id""",
)

# --- analyses ----------------------------------------------------------------

add(
    "analysis_flat",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, classification, w[1] AS title, text AS summary,
  CASE WHEN turn <> 1 THEN 'some-provider' END AS provider,
  CASE WHEN turn <> 1 THEN 'model-' || role END AS model,
  CASE WHEN turn <> 1 THEN '2024-01-01T00:00:00Z' END AS generated_at,
  CASE WHEN turn <> 1 THEN 'v1' END AS prompt_version, len(w) AS n_components,
  CASE WHEN len(w) % 11 = 0 THEN 1.5 ELSE 0.5 END::DOUBLE AS confidence FROM analysed""",
)
add(
    "plot_points",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, role AS series, i AS point,
  i::DOUBLE AS x, length(word)::DOUBLE AS y FROM ws WHERE classification = 'plot'""",
)
add(
    "plot_csv_long",
    f"""WITH {ANALYSES}, c AS (
  SELECT doc_id, figure_id, i AS row, unnest([0, 1]) AS col, unnest(['x', 'y']) AS name,
    unnest([i::BIGINT, length(word)]) AS v FROM ws WHERE classification = 'plot')
SELECT doc_id, figure_id, row, col, name, v::VARCHAR AS value, v::DOUBLE AS number FROM c""",
)
add(
    "component_index",
    f"WITH {ANALYSES} SELECT DISTINCT word AS component, doc_id, figure_id FROM ws",
)
add(
    "component_counts",
    f"""WITH {ANALYSES} SELECT word AS component, count(DISTINCT (doc_id, figure_id)) AS figures
FROM ws GROUP BY word""",
)
add("key_values_long", "SELECT event_id, 'k' AS key, props->>'$.k' AS value FROM events")
add(
    "analysis_key_values",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, unnest(['words', 'first']) AS key,
  unnest([len(w)::VARCHAR, w[1]]) AS value FROM analysed WHERE len(w) % 7 <> 0""",
)
add(
    "diagram_edges",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, i AS edge, word AS src, coalesce(w[i + 2], '') AS dst,
  CASE WHEN classification = 'wiring_diagram' THEN 'red' ELSE 'e' || i END AS label
FROM ws WHERE classification IN ('block_diagram', 'state_machine', 'wiring_diagram')""",
)
add(
    "pin_table",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, i AS n, (i + 1)::VARCHAR AS pin, word AS name,
  'pin ' || word AS function FROM ws WHERE classification = 'pinout'""",
)
add(
    "register_bits",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, w[1] AS register, i AS n, (i * 4 + 3)::INTEGER AS hi,
  (i * 4)::INTEGER AS lo, word AS name, 'R/W' AS access FROM ws WHERE classification = 'register_map'""",
)
add(
    "schematic_components",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, i AS n, 'R' || (i + 1) AS ref, word AS type,
  length(word)::VARCHAR AS value FROM ws WHERE classification = 'schematic'""",
)
add(
    "signal_table",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id, i AS n, word AS name, coalesce(w[i + 2], '') AS transitions
FROM ws WHERE classification = 'timing_diagram'""",
)
add(
    "image_table_grid",
    f"""WITH {ANALYSES} SELECT doc_id, figure_id AS id, w[1] AS caption,
  array_to_string(list_transform(string_split(text, {NL}), lambda l: array_to_string(
    list_transform(string_split(l, ' '), lambda c: {CELL}), ',')), {NL}) || {NL} AS csv
FROM analysed WHERE classification = 'table_image'""",
)
add(
    "analysis_quality",
    f"""WITH {ANALYSES}
SELECT doc_id, figure_id, 'confidence out of range' AS failure FROM analysed WHERE len(w) % 11 = 0
UNION ALL SELECT doc_id, figure_id, 'unknown class' FROM analysed WHERE classification IN ('noise', 'sketch')
UNION ALL SELECT doc_id, figure_id, 'missing keys' FROM analysed WHERE classification = 'screenshot'
UNION ALL SELECT doc_id, figure_id, 'no key values' FROM analysed WHERE len(w) % 7 = 0""",
)
add(
    "schema_drift",
    f"""WITH {ANALYSES}, c AS (
  SELECT classification, count(*) AS n, count(*) FILTER (len(w) > 0) AS worded FROM analysed GROUP BY 1)
SELECT classification, 'csv' AS path, 'unknown' AS issue, n AS records, n AS of, 'STRING' AS kind
FROM c WHERE classification = 'plot'
UNION ALL SELECT classification, 'caption', 'unknown', n, n, 'STRING' FROM c WHERE classification = 'screenshot'
UNION ALL SELECT classification, 'description', 'missing', 0, n, NULL FROM c WHERE classification = 'screenshot'
UNION ALL SELECT classification, 'register_name', 'missing', worded, n, CASE WHEN worded > 0 THEN 'STRING' END
FROM c WHERE classification = 'register_map' AND worded < n""",
)

# --- streaming and sinks -----------------------------------------------------

add(
    "stream_classify",
    f"""WITH h AS (SELECT *, source || ' ' || text AS hay FROM documents)
SELECT doc_id, 1 AS ord, {figure_rules('source', 'hay', 'type')} AS type,
  {figure_rules('source', 'hay', 'confidence')} AS confidence,
  {figure_rules('source', 'hay', 'rationale')} AS rationale FROM h""",
)
add("stream_latest_status", f"WITH {LOG} {LATEST}")
add(
    "stream_daily_rollup",
    f"""WITH {LOG}, days AS (SELECT date_trunc('day', ts) AS d, status FROM log)
SELECT strftime(d, '%Y-%m-%d') AS day, {counts()} FROM days GROUP BY d
HAVING d + INTERVAL 1 DAY <= (SELECT max(ts) FROM log) - INTERVAL 1 HOUR""",
)
add(
    "stream_live_rollup",
    f"""WITH {LOG} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, {counts()}
FROM latest GROUP BY 1""",
)
add("stream_dedupe", f"WITH {LOG} SELECT doc_id, figure_id, event_id, status FROM log")
add(
    "rerun_documents",
    f"""WITH {BLOCKS}
SELECT doc_id, count(*) AS blocks, sum(length(text))::BIGINT AS chars FROM blocks
WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR length(text) > 200 GROUP BY doc_id""",
)
add(
    "status_files_round_trip",
    f"""WITH {APPLIED} SELECT doc_id, figure_id, status, confidence, local_llm_description, version
FROM applied""",
)
add(
    "status_store",
    f"""WITH {LOG}, l AS ({LATEST.strip()})
SELECT doc_id, figure_id, status, local_llm_classification FROM l
WHERE (doc_id, figure_id) NOT IN (
  SELECT (doc_id, figure_id) FROM log WHERE local_llm_classification = 'error')""",
)
add(
    "source_changes",
    """WITH now AS (
  SELECT doc_id, source || '/' || doc_id || '.txt' AS path, sha256(text) AS sha FROM documents),
before AS (
  SELECT path, CASE WHEN toxic = 1 THEN reverse(sha) ELSE sha END AS old, toxic = 0 AS stamped
  FROM now LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality = 1
  UNION ALL SELECT 'gone/' || item_id || '.txt', sha256(text), NULL FROM benchmark)
SELECT path, CASE WHEN old IS NULL THEN 'new' WHEN sha IS NULL THEN 'deleted' WHEN sha != old THEN 'changed'
  WHEN stamped THEN 'touched' ELSE 'same' END AS change, sha AS sha256, old AS sha256_before
FROM now FULL JOIN before USING (path)""",
)
add(
    "page_table_spans",
    f"""WITH RECURSIVE l AS (
  SELECT conv_id || '/' || turn AS doc_id, unnest(string_split(text, {NL})) AS line,
    generate_subscripts(string_split(text, {NL}), 1) - 1 AS y FROM conversations),
r AS (
  SELECT doc_id, y, flatten(list_transform(string_split(line, ' '), lambda w: list_transform(
    range(CASE WHEN length(w) > 0 AND length(w) % 5 = 0 THEN 2 ELSE 1 END),
    lambda k: {{'down': CASE WHEN length(w) > 0 AND length(w) % 7 = 0 THEN 3 ELSE 1 END, 'text': w}}))) AS own
  FROM l),
g AS (
  SELECT doc_id, -1::BIGINT AS y, []::STRUCT(n INTEGER, t VARCHAR)[] AS carry FROM r WHERE y = 0
  UNION ALL
  SELECT doc_id, y, list_transform(range(greatest(coalesce(last, -1), coalesce(free[len(own)], -1)) + 1),
    lambda i: CASE WHEN coalesce(carry[i + 1].n, 0) > 0
      THEN {{'n': (carry[i + 1].n - 1)::INTEGER, 't': carry[i + 1].t}}
      ELSE {{'n': coalesce(own[list_position(free, i)].down - 1, 0)::INTEGER,
            't': coalesce(own[list_position(free, i)].text, '')}} END)
  FROM (
    SELECT g.doc_id, r.y, carry, own,
      list_max(list_filter(range(len(carry)), lambda i: carry[i + 1].n > 0)) AS last,
      list_filter(range(len(carry) + len(own)), lambda i: coalesce(carry[i + 1].n, 0) = 0) AS free
    FROM g JOIN r ON r.doc_id = g.doc_id AND r.y = g.y + 1))
SELECT doc_id, y::INTEGER AS row, array_to_string(list_transform(carry, lambda x: x.t), '|') AS cells
FROM g WHERE y >= 0""",
)

# --- a whole run ---------------------------------------------------------------

# Pictures without an image are left out, and page context comes from packed blocks.
PICTURES = (
    FIGURES.replace("\nfigures AS (", "\nevery AS (")
    + ", figures AS (SELECT * FROM every WHERE image_path IS NOT NULL)"
)
PACKED = f"""
packed_blocks AS ({ORACLE['chunk_greedy']}),
ctx AS (
  SELECT doc_id, page, string_agg(left(text, 200), ' ' ORDER BY section, chunk) AS context
  FROM packed_blocks GROUP BY doc_id, page)
"""


def whole_run(sql: str) -> str:
    """Shared inputs as a whole run sees them."""
    kept = "FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM figures WHERE ord = 1)"
    return (
        sql.replace(FIGURES, PICTURES)
        .replace(CONTEXT, PACKED)
        .replace("FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM documents)", kept)
    )


add(
    "corpus_documents",
    f"""WITH {PICTURES}, {PACKED},
b AS (SELECT doc_id, count(*) AS n, md5(string_agg(text, {NL} ORDER BY section, chunk)) AS m
  FROM packed_blocks GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS n, md5(string_agg(figure_id, {NL} ORDER BY ord)) AS m
  FROM figures GROUP BY doc_id)
SELECT doc_id, 0::BIGINT AS part, coalesce(b.n, 0)::INTEGER AS n_blocks, 1 AS n_tables,
  coalesce(f.n, 0)::INTEGER AS n_figures, coalesce(b.m, md5('')) AS blocks_md5,
  coalesce(f.m, md5('')) AS figures_md5
FROM documents LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)""",
)
add(
    "corpus_stats",
    f"""WITH {PICTURES}, {PACKED},
b AS (SELECT doc_id, count(*) AS n FROM packed_blocks GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS n FROM figures GROUP BY doc_id)
SELECT doc_id, ceil(len(string_split(text, {NL})) / 5)::BIGINT AS page_count,
  coalesce(b.n, 0) AS block_count, 1::BIGINT AS table_count, coalesce(f.n, 0) AS figure_count
FROM documents LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)""",
)
add(
    "corpus_report",
    f"""WITH {whole_run(ENTRIES)} SELECT doc_id, figure_id, page::INTEGER AS page, type, class_confidence,
  action AS recommended_manual_action, reason FROM entries""",
)
add("stream_corpus", ORACLE["corpus_report"])
add(
    "corpus_rollup",
    f"WITH {whole_run(STATUSES)} SELECT doc_id, {counts()} FROM statuses GROUP BY doc_id",
)
