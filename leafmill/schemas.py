"""Spark types of the document data model, as DDL."""

CLASSIFICATION = "STRUCT<type: STRING, confidence: DOUBLE, rationale: STRING>"
DERIVED = "STRUCT<description: STRUCT<text: STRING, confidence: DOUBLE, notes: STRING>>"

RAW_BLOCK = (
    "doc_id STRING, ord BIGINT, page INT, type STRING, text STRING, enriched_text STRING, "
    "headings ARRAY<STRING>, bbox ARRAY<DOUBLE>"
)
RAW_TABLE = (
    "doc_id STRING, ord BIGINT, page INT, caption STRING, bbox ARRAY<DOUBLE>, "
    "header ARRAY<STRING>, rows ARRAY<ARRAY<STRING>>"
)
RAW_FIGURE = (
    "doc_id STRING, ord BIGINT, figure_id STRING, page INT, caption STRING, image_path STRING, "
    "width INT, height INT, bbox ARRAY<DOUBLE>"
)
RESPONSE = "doc_id STRING, figure_id STRING, response STRING"

# Columns of a status record after the key; older files lack the provider and model fields.
STATUS_FIELDS = (
    "image_path STRING, status STRING, stage STRING, local_llm_provider STRING, "
    "local_llm_model STRING, local_llm_description STRING, local_llm_classification STRING, "
    "external_llm_provider STRING, external_llm_model STRING, external_llm_result VARIANT, "
    "needs_external BOOLEAN, confidence DOUBLE, processed_at TIMESTAMP"
)
STATUS_FILE = (
    "figure_id STRING, "
    + STATUS_FIELDS
    + ", external_llm_meta STRUCT<model: STRING, processed_at_utc: STRING>"
)
STATUS = "doc_id STRING, figure_id STRING, " + STATUS_FIELDS
STATUS_COLUMNS = tuple(f.split()[0] for f in STATUS.split(", "))

# A nested record, see ``export.assemble_documents``; ``source`` is what the documents had beside their counts.
DOCUMENT = (
    "source STRUCT<path: STRING>, "
    "doc_stats STRUCT<page_count: BIGINT, block_count: BIGINT, table_count: BIGINT, figure_count: BIGINT>, "
    "blocks ARRAY<STRUCT<id: STRING, type: STRING, page: INT, bbox: ARRAY<DOUBLE>, text: STRING, "
    "enriched_text: STRING, headings: ARRAY<STRING>, heading_level: INT>>, "
    "tables ARRAY<STRUCT<id: STRING, page: INT, bbox: ARRAY<DOUBLE>, caption: STRING, tags: ARRAY<STRING>, "
    "grid: ARRAY<ARRAY<STRING>>, markdown_path: STRING, csv_path: STRING, json_path: STRING>>, "
    "figures ARRAY<STRUCT<id: STRING, page: INT, bbox: ARRAY<DOUBLE>, caption: STRING, tags: ARRAY<STRING>, "
    f"image_path: STRING, width: INT, height: INT, classification: {CLASSIFICATION}, derived: {DERIVED}>>"
)

ANALYSIS_META = (
    "STRUCT<provider: STRING, model: STRING, generated_at: STRING, prompt_version: STRING>"
)
ANALYSIS_FILE = (
    "classification STRING, title STRING, summary STRING, structured_data VARIANT, "
    f"component_references ARRAY<STRING>, analysis_meta {ANALYSIS_META}, "
    "key_values MAP<STRING, STRING>, confidence DOUBLE"
)

ANALYSIS_COLUMNS = (
    "classification",
    "title",
    "summary",
    "structured_data",
    "component_references",
    "analysis_meta",
    "key_values",
    "confidence",
)

# Status life cycle.
RESOLVED_LOCAL = "resolved_local"
NEEDS_EXTERNAL = "needs_external"
RESOLVED_EXTERNAL = "resolved_external"

# Classes that need an exact external reading, and classes simple enough to settle.
COMPLEX_CLASSES = (
    "plot",
    "pinout",
    "schematic",
    "block_diagram",
    "timing_diagram",
    "register_map",
    "wiring_diagram",
    "state_machine",
    "table_image",
)
SIMPLE_CLASSES = ("logo", "icon", "decorative", "photo", "screenshot")

# Classes an external analysis may use.
ANALYSIS_CLASSES = (
    "photo",
    "pinout",
    "schematic",
    "block_diagram",
    "timing_diagram",
    "state_machine",
    "plot",
    "wiring_diagram",
    "table_image",
    "register_map",
    "mechanical",
    "screenshot",
    "other",
)
