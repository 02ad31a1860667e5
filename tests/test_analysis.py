import json

from pyspark.sql import functions as F

from leafmill.functions import grids as G
from leafmill.operators import analysis as A
from leafmill import schemas as S
from leafmill.sources.files import read_analyses

META = {"provider": "p", "model": "m", "generated_at": "2024-01-01T00:00:00Z", "prompt_version": "v1"}
RECORDS = {
    "fig_0001": {
        "classification": "plot",
        "title": "T",
        "structured_data": {"x_axis": "V", "y_axis": "A", "series": [], "csv": "x,y\\n0, 1\\n1,n/a\\n"},
        "component_references": ["U1", "R1", "U1"],
        "key_values": {"range": "0-5"},
        "confidence": 0.9,
    },
    "fig_0002": {
        "classification": "plot",
        "structured_data": {
            "x_axis": "V",
            "y_axis": "A",
            "series": [{"name": "s", "data_points": [{"x": 0, "y": 1.5}, {"x": 1, "y": 2}]}, {"name": "t", "data_points": []}],
            "csv": "a,b,c\n1,2\n",
        },
        "analysis_meta": META,
        "component_references": ["U1"],
        "key_values": {},
        "confidence": 1.5,
    },
    "fig_0003": {
        "classification": "schematic",
        "structured_data": {"components": [{"ref": "R1", "type": "resistor", "value": "10k"}], "nets": [], "description": "d"},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0004": {
        "classification": "wiring_diagram",
        "structured_data": {"connections": [{"from": "U1.1", "to": "J1.2", "wire_color": "red"}]},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0005": {
        "classification": "state_machine",
        "structured_data": {"mermaid": "x", "nodes": ["a", "b"], "connections": [{"from": "a", "to": "b", "label": "go"}, {"from": "b", "to": "a"}]},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0006": {
        "classification": "timing_diagram",
        "structured_data": {"signals": [{"name": "clk", "transitions": "up"}], "wavedrom": ""},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0007": {
        "classification": "table_image",
        "structured_data": {"headers": ["a", "b"], "rows": [["1", "x,y"], ["2"]]},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0008": {
        "classification": "pinout",
        "structured_data": {"pins": [{"number": 1, "name": "VDD", "function": "power"}, {"number": "A2", "name": "X", "function": ""}]},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0009": {
        "classification": "register_map",
        "structured_data": {"register_name": "CTRL", "address": "0x1", "bits": [{"range": "7:0", "name": "all", "access": "R/W", "description": ""}, {"range": "3", "name": "one", "access": "R", "description": ""}, {"range": "n", "name": "bad", "access": "R", "description": ""}]},
        "key_values": {"a": "b"},
        "confidence": 0.5,
    },
    "fig_0010": {"classification": "sketch", "structured_data": {}, "confidence": 0.1},
    "fig_0011": {"classification": "plot", "structured_data": {"csv": ""}, "key_values": {"a": "b"}, "confidence": 0.1},
    "fig_0012": {"classification": "photo", "title": "Board", "summary": "S", "structured_data": {"description": "d"}, "key_values": {"a": "b"}, "confidence": 1},
}


def load(spark, tmp_path):
    for fid, record in RECORDS.items():
        home = tmp_path / "doc a" / "derived" / "figures" / fid
        home.mkdir(parents=True, exist_ok=True)
        (home / "analysis.json").write_text(json.dumps(record, indent=2), encoding="utf-8")
    return read_analyses(spark, str(tmp_path))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_shapes(spark, tmp_path):
    a = load(spark, tmp_path).cache()
    assert {r.doc_id for r in a.collect()} == {"doc a"} and a.count() == len(RECORDS)

    flat = {r.figure_id: r for r in A.flatten_analysis(a).collect()}
    assert (flat["fig_0002"].provider, flat["fig_0002"].model) == ("p", "m")
    assert flat["fig_0001"].provider is None and flat["fig_0001"].n_components == 3
    assert flat["fig_0010"].n_components == 0

    points = A.plot_points(a).where("x is not null")
    assert rows(points, "figure_id", "series", "point", "x", "y") == [
        ("fig_0002", "s", 0, 0.0, 1.5),
        ("fig_0002", "s", 1, 1.0, 2.0),
    ]
    empty = A.plot_points(a).where("x is null")
    assert {r.figure_id for r in empty.collect()} == {"fig_0001", "fig_0002", "fig_0011"}

    csv = A.plot_csv_long(a)
    assert rows(csv, "figure_id", "row", "col", "name", "value") == [
        ("fig_0001", 0, 0, "x", "0"),
        ("fig_0001", 0, 1, "y", "1"),
        ("fig_0001", 1, 0, "x", "1"),
        ("fig_0001", 1, 1, "y", "n/a"),
        ("fig_0002", 0, 0, "a", "1"),
        ("fig_0002", 0, 1, "b", "2"),
    ]
    assert csv.where("value = 'n/a'").first().number is None

    assert rows(A.component_index(a), "component", "figure_id") == [("R1", "fig_0001"), ("U1", "fig_0001"), ("U1", "fig_0002")]
    assert rows(A.component_counts(a), "component", "figures") == [("R1", 1), ("U1", 2)]
    assert ("fig_0001", "range", "0-5") in rows(A.key_values_long(a), "figure_id", "key", "value")

    edge = [tuple(r[c] for c in ("figure_id", "edge", "src", "dst", "label")) for r in A.edges(a).orderBy("figure_id", "edge").collect()]
    assert edge == [
        ("fig_0004", 0, "U1.1", "J1.2", "red"),
        ("fig_0005", 0, "a", "b", "go"),
        ("fig_0005", 1, "b", "a", None),
    ]
    assert rows(A.pin_table(a), "n", "pin", "name") == [(0, "1", "VDD"), (1, "A2", "X")]
    bits = A.register_bits(a).orderBy("n").collect()
    assert [(r.register, r.hi, r.lo, r.name) for r in bits] == [("CTRL", 7, 0, "all"), ("CTRL", 3, 3, "one"), ("CTRL", None, None, "bad")]
    assert rows(A.schematic_components(a), "ref", "type", "value") == [("R1", "resistor", "10k")]
    assert rows(A.signal_table(a), "name", "transitions") == [("clk", "up")]
    grid = A.image_table_grid(a).select("grid", G.grid_to_csv(F.col("grid")).alias("csv")).first()
    assert grid.csv == 'a,b\n1,"x,y"\n2\n'

    assert rows(A.analysis_quality(a), "figure_id", "failure") == [
        ("fig_0002", "confidence out of range"),
        ("fig_0002", "no key values"),
        ("fig_0010", "no key values"),
        ("fig_0010", "unknown class"),
        ("fig_0011", "missing keys"),
    ]
    result = A.results(a).where("figure_id = 'fig_0002'").select(
        F.variant_get("result", "$.classification", "string").alias("c"), "provider"
    ).first()
    assert tuple(result) == ("plot", "p")
    a.unpersist()


def test_csv_cells_keep_quoted_commas(spark):
    from leafmill.operators.analysis import csv_cells

    lines = {
        'a,b,,c': ["a", "b", "", "c"],
        '"x, y",2,"say ""hi"""': ["x, y", "2", 'say "hi"'],
        '': [""],
        ' "q" , 1': ["q", " 1"],
        'open "quote, 2': ['open "quote', " 2"],
    }
    df = spark.createDataFrame([(k,) for k in lines], "line string")
    got = {r.line: r.cells for r in df.withColumn("cells", csv_cells(F.col("line"))).collect()}
    assert got == lines


def test_schema_drift(spark):
    rows = [
        ("plot", '{"x_axis": 1, "y_axis": "a", "series": [], "more": 1}'),
        ("plot", '{"x_axis": null, "y_axis": "b", "more": "s"}'),
        ("photo", '{"description": "d"}'),
        ("sketch", '{"odd": {"a": 1}}'),
        ("pinout", None),
        ("pinout", "[1, 2]"),
        (None, '{"k": true}'),
    ]
    df = spark.createDataFrame(rows, "classification string, j string").withColumn("structured_data", F.parse_json("j"))
    got = {(r.classification, r.path): (r.issue, r.records, r.of, r.kind) for r in A.schema_drift(df).collect()}
    assert got == {
        ("plot", "series"): ("missing", 1, 2, "ARRAY<VOID>"),
        ("plot", "more"): ("unknown", 2, 2, "VARIANT"),
        ("sketch", "odd"): ("unknown", 1, 1, "OBJECT<a: BIGINT>"),
        ("pinout", "pins"): ("missing", 0, 2, None),
        (None, "k"): ("unknown", 1, 1, "BOOLEAN"),
    }
    assert A.schema_drift(df.limit(0)).count() == 0


def test_no_field_is_lost(spark, tmp_path):
    home = tmp_path / "doc" / "derived" / "figures" / "fig_0001"
    home.mkdir(parents=True)
    (home / "a.json").write_text('{"classification": "plot",\n "confidence": 0.5, "extra": {"deep": [1, 2]}}', encoding="utf-8")
    (home / "b.json").write_text("not json", encoding="utf-8")
    a = read_analyses(spark, str(tmp_path))
    deep = F.variant_get("record", "$.extra.deep[1]", "int").alias("deep")
    got = {r.classification: (r.doc_id, r.figure_id, r.confidence, r.deep) for r in a.select("doc_id", "figure_id", "classification", "confidence", deep).collect()}
    assert got == {"plot": ("doc", "fig_0001", 0.5, 2), None: ("doc", "fig_0001", None, None)}
    known = {"plot": S.ANALYSIS_COLUMNS}
    drift = {(r.path, r.issue) for r in A.schema_drift(a.where("classification is not null"), known, column="record").collect()}
    assert ("extra", "unknown") in drift and ("title", "missing") in drift and ("confidence", "missing") not in drift
