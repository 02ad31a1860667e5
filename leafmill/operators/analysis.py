"""External analyses shredded into long tables.

An analysis row is (doc_id, figure_id, classification, title, summary,
structured_data, component_references, analysis_meta, key_values, confidence)
with ``structured_data`` a variant whose shape depends on the class.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill import schemas as S

KEY = ["doc_id", "figure_id"]

# Keys that structured data must have, per class.
REQUIRED_KEYS = {
    "plot": ("x_axis", "y_axis", "series"),
    "table_image": ("headers", "rows"),
    "timing_diagram": ("signals",),
    "block_diagram": ("nodes", "connections"),
    "state_machine": ("nodes", "connections"),
    "schematic": ("components",),
    "pinout": ("pins",),
    "register_map": ("register_name", "bits"),
    "wiring_diagram": ("connections",),
    "photo": ("description",),
    "mechanical": ("description",),
    "screenshot": ("description",),
    "other": ("description",),
}


def _part(path: str, ddl: str) -> Column:
    """One typed part of the structured data; null when absent or of another shape."""
    return F.try_variant_get("structured_data", f"$.{path}", ddl)


def flatten_analysis(analyses: DataFrame) -> DataFrame:
    """Typed head of each analysis; missing meta data gives nulls."""
    return analyses.select(
        *KEY,
        "classification",
        "title",
        "summary",
        F.col("analysis_meta.provider").alias("provider"),
        F.col("analysis_meta.model").alias("model"),
        F.col("analysis_meta.generated_at").alias("generated_at"),
        F.col("analysis_meta.prompt_version").alias("prompt_version"),
        F.coalesce(F.size("component_references"), F.lit(0)).alias("n_components"),
        "confidence",
    )


def results(analyses: DataFrame) -> DataFrame:
    """Analyses in the form that is applied to statuses: (key, result, provider, model)."""
    whole = F.to_variant_object(F.struct(*[c for c in analyses.columns if c not in KEY]))
    return analyses.select(
        *KEY,
        whole.alias("result"),
        F.col("analysis_meta.provider").alias("provider"),
        F.col("analysis_meta.model").alias("model"),
    )


def plot_points(analyses: DataFrame) -> DataFrame:
    """(key, series, point, x, y); a plot without points gives one row with nulls."""
    series = _part(
        "series", "array<struct<name: string, data_points: array<struct<x: double, y: double>>>>"
    )
    return (
        analyses.where(F.col("classification") == "plot")
        .select(*KEY, F.explode_outer(series).alias("s"))
        .select(
            *KEY, F.col("s.name").alias("series"), F.posexplode_outer("s.data_points").alias("point", "p")
        )
        .select(*KEY, "series", "point", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    )


def csv_cells(line: Column) -> Column:
    """Cells of a CSV line; quotes around a cell are taken off."""
    found = F.regexp_extract_all(line, F.lit(r'''(?:^|,)(\s*"(?:[^"]|"")*+"[^,]*|[^,]*)'''), F.lit(1))

    def bare(cell: Column) -> Column:
        inner = F.regexp_extract(cell, r'''^\s*"(.*)"\s*$''', 1)
        quoted = F.startswith(F.ltrim(cell), F.lit('"')) & F.endswith(F.rtrim(cell), F.lit('"'))
        return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)

    return F.transform(found, bare)


def plot_csv_long(analyses: DataFrame) -> DataFrame:
    """(key, row, col, name, value, number) from the CSV text of a plot.

    Lines end with a line feed or with a literal backslash-n.  A quoted cell may
    hold commas and doubled quotes; a line break ends it.
    """
    lines = F.filter(F.split(_part("csv", "string"), r"\n|\\n"), lambda x: F.trim(x) != "")
    cut = analyses.where(F.col("classification") == "plot").select(
        *KEY, F.transform(lines, csv_cells).alias("grid")
    )
    rows = cut.select(
        *KEY,
        F.get("grid", F.lit(0)).alias("head"),
        F.posexplode(F.slice("grid", F.lit(2), F.greatest(F.size("grid") - 1, F.lit(0)))).alias(
            "row", "cells"
        ),
    )
    return rows.select(
        *KEY, "row", "head", F.posexplode("cells").alias("col", "value")
    ).select(
        *KEY,
        "row",
        "col",
        F.trim(F.get("head", F.col("col"))).alias("name"),
        F.trim("value").alias("value"),
        F.trim("value").try_cast("double").alias("number"),
    )


def component_index(analyses: DataFrame) -> DataFrame:
    """(component, doc_id, figure_id), each once: which figures mention a component.

    Kept long, so a component that occurs everywhere is spread by its figures.
    """
    return analyses.select(
        F.explode(F.array_distinct("component_references")).alias("component"), *KEY
    ).distinct()


def component_counts(analyses: DataFrame) -> DataFrame:
    """(component, figures): size of each entry of the index."""
    return component_index(analyses).groupBy("component").agg(F.count(F.lit(1)).alias("figures"))


def key_values_long(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(key columns, key, value) from the ``key_values`` map."""
    keys = KEY if keys is None else keys
    return df.select(*keys, F.explode("key_values").alias("key", "value"))


def edges(analyses: DataFrame) -> DataFrame:
    """(key, edge, src, dst, label) of block, state and wiring diagrams; wires are labelled by colour."""
    connections = _part(
        "connections",
        "array<struct<from: string, to: string, label: string, wire_color: string>>",
    )
    return (
        analyses.where(
            F.col("classification").isin("block_diagram", "state_machine", "wiring_diagram")
        )
        .select(*KEY, F.posexplode(connections).alias("edge", "c"))
        .select(
            *KEY,
            "edge",
            F.col("c.from").alias("src"),
            F.col("c.to").alias("dst"),
            F.coalesce("c.label", "c.wire_color").alias("label"),
        )
    )


def _elements(analyses: DataFrame, label: str, path: str, ddl: str, n: str) -> DataFrame:
    return analyses.where(F.col("classification") == label).select(
        *KEY, F.posexplode(_part(path, ddl)).alias(n, "x")
    )


def pin_table(analyses: DataFrame) -> DataFrame:
    ddl = "array<struct<number: string, name: string, function: string>>"
    return _elements(analyses, "pinout", "pins", ddl, "n").select(
        *KEY,
        "n",
        F.col("x.number").alias("pin"),
        F.col("x.name").alias("name"),
        F.col("x.function").alias("function"),
    )


def register_bits(analyses: DataFrame) -> DataFrame:
    """Bit fields with their range ``7:0`` split into hi and lo; a single bit is both."""
    ddl = "array<struct<range: string, name: string, access: string, description: string>>"
    register = analyses.withColumn("register", _part("register_name", "string"))
    bounds = F.split(F.col("x.range"), ":")
    return (
        register.where(F.col("classification") == "register_map")
        .select(
            *KEY, "register", F.posexplode(_part("bits", ddl)).alias("n", "x")
        )
        .select(
            *KEY,
            "register",
            "n",
            F.trim(F.get(bounds, F.lit(0))).try_cast("int").alias("hi"),
            F.trim(F.element_at(bounds, -1)).try_cast("int").alias("lo"),
            F.col("x.name").alias("name"),
            F.col("x.access").alias("access"),
        )
    )


def schematic_components(analyses: DataFrame) -> DataFrame:
    ddl = "array<struct<ref: string, type: string, value: string>>"
    return _elements(analyses, "schematic", "components", ddl, "n").select(
        *KEY,
        "n",
        F.col("x.ref").alias("ref"),
        F.col("x.type").alias("type"),
        F.col("x.value").alias("value"),
    )


def signal_table(analyses: DataFrame) -> DataFrame:
    ddl = "array<struct<name: string, transitions: string>>"
    return _elements(analyses, "timing_diagram", "signals", ddl, "n").select(
        *KEY, "n", F.col("x.name").alias("name"), F.col("x.transitions").alias("transitions")
    )


def image_table_grid(analyses: DataFrame) -> DataFrame:
    """Tables read from images as (doc_id, id, grid, caption), ready for the table exports."""
    from leafmill.operators.normalize import build_grid

    return analyses.where(F.col("classification") == "table_image").select(
        "doc_id",
        F.col("figure_id").alias("id"),
        build_grid(
            _part("headers", "array<string>"), _part("rows", "array<array<string>>")
        ).alias("grid"),
        F.coalesce("title", F.lit("")).alias("caption"),
    )


def analysis_quality(analyses: DataFrame) -> DataFrame:
    """(key, failure) for confidence out of 0..1, an unknown class, missing keys, no key values."""
    def lacks(key: str) -> Column:
        return F.try_variant_get("structured_data", f"$.{key}", "variant").isNull()

    missing = F.lit(False)
    for label, keys in REQUIRED_KEYS.items():
        gap = F.lit(False)
        for key in keys:
            gap = gap | lacks(key)
        missing = missing | ((F.col("classification") == label) & gap)
    checks = {
        "confidence out of range": ~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)),
        "unknown class": ~F.coalesce(
            F.col("classification").isin(*S.ANALYSIS_CLASSES), F.lit(False)
        ),
        "missing keys": missing,
        "no key values": F.coalesce(F.size("key_values") <= 0, F.lit(True)),
    }
    failures = F.filter(
        F.array(*[F.when(t, n) for n, t in checks.items()]), lambda f: f.isNotNull()
    )
    return analyses.select(*KEY, F.explode(failures).alias("failure"))


def schema_drift(
    analyses: DataFrame,
    required: Mapping[str, Sequence[str]] = REQUIRED_KEYS,
    *,
    column: str = "structured_data",
) -> DataFrame:
    """(classification, path, issue, records, of, kind): keys that some analyses have or lack unexpectedly.

    ``unknown`` - a key that isn't required of the class; ``missing`` - a required one that some lack.
    ``records`` of the ``of`` analyses of the class have the key, and ``kind`` is the merged type of its
    values.  ``column`` is any variant: ``record`` with the known fields shows fields of whole files.
    Classes without required keys, null among them, have unknown keys only.
    """
    spark = analyses.sparkSession
    rows = analyses.select("classification", F.col(column).alias("data"))
    keys = rows.lateralJoin(spark.tvf.variant_explode(F.col("data").outer())).where("key is not null")
    found = keys.groupBy("classification", F.col("key").alias("path")).agg(
        F.count(F.lit(1)).alias("records"), F.schema_of_variant_agg("value").alias("kind")
    )
    of = rows.groupBy(F.col("classification").alias("__class")).agg(F.count(F.lit(1)).alias("of"))
    told = [(c, k, True) for c, each in required.items() for k in each]
    expected = spark.createDataFrame(told, "classification string, path string, expected boolean")
    both = found.join(expected, ["classification", "path"], "full_outer")
    issue = F.when(F.col("expected").isNull(), "unknown").when(F.coalesce("records", F.lit(0)) < F.col("of"), "missing")
    return (
        both.join(of, F.col("classification").eqNullSafe(F.col("__class")))
        .select(
            "classification", "path", issue.alias("issue"),
            F.coalesce("records", F.lit(0)).cast("bigint").alias("records"), "of", "kind",
        )
        .where("issue is not null")
    )
