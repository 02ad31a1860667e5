import datetime
import hashlib
import json
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill import schemas as S
from leafmill.operators import export
from leafmill.operators import normalize as N
from leafmill.operators import triage
from leafmill.sinks import files as sink
from leafmill.sinks import runs
from leafmill.sources import files, markup


def test_discover(spark, tmp_path):
    top, deep = tmp_path / "top", tmp_path / "deep" / "x"
    top.mkdir()
    (top / "sub").mkdir()
    deep.mkdir(parents=True)
    (top / "a.pdf").write_bytes(b"one")
    (top / "sub" / "b.pdf").write_bytes(b"two")
    (top / "c.txt").write_bytes(b"no")
    (deep / "d.pdf").write_bytes(b"three")
    (tmp_path / "none").mkdir()

    def found(directory, *glob):
        return sorted(r.path.rsplit("/", 1)[1] for r in files.discover(spark, str(directory), *glob).select("path").collect())

    assert found(top) == ["a.pdf"]
    assert found(tmp_path / "deep") == ["d.pdf"]
    assert found(tmp_path / "deep", "d*.pdf") == []
    assert found(tmp_path / "none") == []
    m = files.source_manifest(files.discover(spark, str(top))).first()
    assert (m.sha256, m.size) == (hashlib.sha256(b"one").hexdigest(), 3)
    seconds = spark.createDataFrame([(m.mtime,)], "t timestamp").select(files.epoch_seconds(F.col("t"))).first()[0]
    assert abs(seconds - (top / "a.pdf").stat().st_mtime) < 1e-2


def test_stem_collisions(spark):
    df = spark.createDataFrame([("a/x.pdf",), ("b/x.pdf",), ("c/y.pdf",)], "path string")
    assert [tuple(r) for r in files.stem_collisions(df).collect()] == [("x", 2)]


def test_status_shapes(spark, tmp_path):
    old = {"figure_id": "fig_0001", "image_path": "p", "status": "needs_external", "stage": "", "local_llm_description": "", "local_llm_classification": "", "external_llm_result": None, "needs_external": True, "confidence": 0.3, "processed_at": "2026-02-12T00:33:06.123456+00:00"}
    new = {**old, "figure_id": "fig_0002", "local_llm_provider": "x", "local_llm_model": "y", "external_llm_provider": "", "external_llm_model": ""}
    ext = {**old, "figure_id": "fig_0003", "status": "resolved_external", "external_llm_result": {"classification": "plot"}, "external_llm_meta": {"model": "big", "processed_at_utc": "z"}}
    home = tmp_path / "my doc" / "processing"
    home.mkdir(parents=True)
    for record in (old, new, ext):
        (home / f"{record['figure_id']}.json").write_text(json.dumps(record, indent=2), encoding="utf-8")
    (home / "other.json").write_text("{}", encoding="utf-8")
    df = files.read_statuses(spark, str(tmp_path))
    assert tuple(df.columns) == S.STATUS_COLUMNS
    rows = {r.figure_id: r for r in df.withColumn("c", F.variant_get("external_llm_result", "$.classification", "string")).collect()}
    assert set(rows) == {"fig_0001", "fig_0002", "fig_0003"}
    assert {r.doc_id for r in rows.values()} == {"my doc"}
    assert rows["fig_0001"].local_llm_model is None and rows["fig_0002"].local_llm_model == "y"
    assert (rows["fig_0003"].external_llm_model, rows["fig_0003"].c) == ("big", "plot")
    assert rows["fig_0001"].processed_at.year == 2026


def png(path, width, height):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    raw = b"".join(b"\x00" + b"\xff\xff\xff" * width for _ in range(height))
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
        + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )


def test_images(spark, tmp_path):
    png(tmp_path / "fig_0001.png", 10, 49)
    png(tmp_path / "fig_0002.png", 20, 25)
    (tmp_path / "fig_0003.png").write_bytes(b"broken")
    got = {r.image_path.rsplit("/", 1)[1]: (r.width, r.height, r.pixels) for r in files.read_figure_images(spark, str(tmp_path)).collect()}
    assert got == {"fig_0001.png": (10, 49, 490), "fig_0002.png": (20, 25, 500)}


PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
<body><!-- c <p>hidden</p> --><h1>Top <i>one</i></h1><p>first <b>bold<br>cut<p>a < b &lt;p&gt; &nbsp; x
<h2>Two</h2><ul><li>i1<li>i2</ul>
<table class="x"><tr><th>H&amp;1<th>H 2</tr><tr><td><b>1</b></td><td>a
b</td></tr><tr><td>only</table>
<img src="i/1.png" alt="A &quot;cap&quot;" width="10" height="49"><IMG SRC="2.png">
<a class="k" href="/l?x=1&amp;y=2">Link <b>x</b></a></body></html>"""


def test_markup(spark):
    pages = spark.createDataFrame([("d", PAGE), ("none", "")], "doc_id string, html string")
    items, tables, figures = markup.extract_structure(pages)
    got = [(r.ord, r.tag, r.text, r.level) for r in items.orderBy("ord").collect()]
    assert got[:8] == [
        (1, "title", "A & B", None),
        (2, "h1", "Top one", 1),
        (3, "p", "first bold", None),
        (4, "br", "cut", None),
        (5, "p", "a < b <p> x", None),
        (6, "h2", "Two", 2),
        (7, "li", "i1", None),
        (8, "li", "i2", None),
    ]
    table = tables.first()
    assert (table.header, table.rows) == (["H&1", "H 2"], [["1", "a b"], ["only"]])
    pics = [(r.ord, r.image_path, r.caption, r.width, r.height) for r in figures.orderBy("ord").collect()]
    assert pics == [(1, "i/1.png", 'A "cap"', 10, 49), (2, "2.png", "", None, None)]
    link = markup.page_links_as_figures(pages).first()
    assert (link.image_path, link.caption) == ("/l?x=1&y=2", "Link x")
    assert markup.extract_structure(pages, images=False, tables=False)[1:] == (None, None)


def test_markup_corners(spark):
    page = (
        "<table><caption>C &#233;</caption><tr><td>a<tr><td>x<table><tr><td>in</td></tr></table>y</td></tr>"
        "<tr><td>LOST</td></tr></table><table><tr><td>last</table>"
        "<img data-src='lazy.png' alt='src=no.png' src = real.png width='7'>"
        "<figure><img src=\"f.png\" alt=a><figcaption>F <b>c</b> &#x1F600;</figcaption></figure><img alt=b src=g.png>"
        "<a href='s'><b>bold</b> tail</a> out <a name=n>none</a><a class=k href=bare>pre <i>it</i> post"
    )
    pages = spark.createDataFrame([("d", page)], "doc_id string, html string")
    _, tables, figures = markup.extract_structure(pages)
    got = [(t.caption, t.header, t.rows) for t in tables.orderBy("ord").collect()]
    assert got == [("C é", ["a"], [["xy"], ["LOST"]]), ("", ["in"], []), ("", ["last"], [])]
    pics = [(f.image_path, f.caption, f.width) for f in figures.orderBy("ord").collect()]
    assert pics == [("real.png", "src=no.png", 7), ("f.png", "F c 😀", None), ("g.png", "b", None)]
    links = [(x.image_path, x.caption) for x in markup.page_links_as_figures(pages).orderBy("ord").collect()]
    assert links == [("s", "bold tail"), ("bare", "pre it post")]


def occupied(rows):
    """Cell by cell into a dictionary of places."""
    at, out = {}, []
    for y, row in enumerate(rows):
        x = 0
        for down, across, text in row:
            for _ in range(across):
                while (y, x) in at:
                    x += 1
                for k in range(down or len(rows)):
                    at[y + k, x] = text
        width = max([c for r, c in at if r == y], default=-1) + 1
        out.append([at.get((y, c), "") for c in range(width)])
    return [r for r in out if r]


def test_spans(spark):
    rng = random.Random(4)
    tables = [[[(1, 1, "h"), (1, 2, "w")], [(2, 1, "d"), (1, 1, "x"), (1, 1, "y")], [(1, 1, "z")], [(0, 1, "e"), (1, 1, "f")], [], [(1, 1, "g")]]]
    for _ in range(40):
        tables.append(
            [[(rng.choice([1, 1, 1, 2, 3, 0]), rng.choice([1, 1, 1, 2, 4]), f"t{rng.randint(0, 99)}") for _ in range(rng.randint(0, 5))] for _ in range(rng.randint(1, 7))]
        )
    tables += [[[(1, 1, "a")], [(1, 1, "b"), (1, 1, "c")]]]

    def cell(down, across, text):
        spans = [f'rowspan="{down}"'] * (down != 1) + [f"COLSPAN = '{across}'"] * (across != 1)
        rng.shuffle(spans)
        return f"<{rng.choice(['td', 'TH'])} title='no rowspan=9' {' '.join(spans)}>{text}"

    page = lambda rows: "<table>" + "".join("<tr>" + "".join(cell(*c) for c in r) for r in rows) + "</table>"
    df = spark.createDataFrame([(i, page(t)) for i, t in enumerate(tables)], "doc_id int, html string")
    got = {r.doc_id: r.g for r in df.select("doc_id", F.get(markup.M.grids(F.col("html")), F.lit(0)).alias("g")).collect()}
    assert got == {i: occupied(t) for i, t in enumerate(tables)}


def test_odd_spans(spark):
    odd = "<table><tr><td colspan=x>a<td rowspan=-3>b<td colspan=0>c<td rowspan=99999>d<tr><td colspan='1001'>e</table>"
    grid = spark.createDataFrame([(odd,)], "html string").select(markup.M.grids(F.col("html"))).first()[0][0]
    assert grid[0] == ["a", "b", "c", "d"] and grid[1] == ["e"] * 3 + ["d"] + ["e"] * 997


def test_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "doc_id string, v int"
    assert not runs.has_runs(spark, path)
    runs.write_run(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], ddl), spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string"), path, 1)
    state = lambda: sorted((r.doc_id, r.v) for r in runs.read_runs(spark, path).collect())
    assert state() == [("a", 1), ("a", 2), ("b", 3)]
    again = (spark.createDataFrame([("a", 9)], ddl), spark.createDataFrame([("a",)], "doc_id string"))
    runs.write_run(*again, path, 2)
    runs.write_run(*again, path, 2)
    assert state() == [("a", 9), ("b", 3)]
    runs.write_run(spark.createDataFrame([], ddl), spark.createDataFrame([("b",)], "doc_id string"), path, 3)
    assert state() == [("a", 9)]
    # A run that died before its commit record is not seen.
    spark.createDataFrame([("a", 0)], ddl).write.parquet(f"{path}/rows/level=0/run={4:019d}")
    spark.createDataFrame([("a",)], "doc_id string").write.parquet(f"{path}/docs/level=0/run={4:019d}")
    assert state() == [("a", 9)]
    runs.compact(spark, path)
    assert state() == [("a", 9)] and runs.live_runs(spark, path) == [(1, 3)]
    # What the merged run holds already is not written again.
    runs.write_run(spark.createDataFrame([("b", 7)], ddl), None, path, 3)
    assert state() == [("a", 9)]
    runs.write_run(spark.createDataFrame([("b", 8)], ddl), None, path, 5)
    assert state() == [("a", 9), ("b", 8)]
    with pytest.raises(ValueError):
        runs.read_runs(spark, path, ("v",))
    with pytest.raises(ValueError):
        runs.read_runs(spark, str(tmp_path / "nothing"))


def test_merged_runs(spark, tmp_path):
    """Readers read live files only, keys that lost their rows stay cleared, and a dead merge is done again."""
    path, ddl = str(tmp_path / "t"), "doc_id int, v int"
    want = {}
    for n in range(30):
        rows = [(n % 7, n), (n % 5, n)] if n % 7 != n % 5 else [(n % 7, n)]
        gone = [(20 + n % 3,), (n % 4,)] if n % 6 == 0 else []
        rows = [r for r in rows if (r[0],) not in gone]
        docs = spark.createDataFrame([(d,) for d, _ in rows] + gone, "doc_id int")
        runs.write_run(spark.createDataFrame(rows, ddl), docs, path, n)
        want.update(dict(rows))
        for (d,) in gone:
            want.pop(d, None)
        if n == 10:  # died after its rows
            spark.createDataFrame([(0, -1)], ddl).write.mode("overwrite").parquet(f"{path}/rows/level=1/run={n + 1:019d}")
        runs.merge_runs(spark, path, 3)
        assert {r.doc_id: r.v for r in runs.read_runs(spark, path).collect()} == want
    live = runs.live_runs(spark, path)
    assert live == [(3, 26), (1, 29)]
    places = {f"/level={level}/run={run:019d}/" for level, run in live}
    files_read = runs.read_runs(spark, path).inputFiles()
    assert files_read and all(any(p in f for p in places) for f in files_read)
    assert {r.doc_id for r in runs.covered(spark, path).collect()} >= {20}
    runs.vacuum(spark, path)
    assert runs.committed(spark, path) == sorted(live)
    assert {p.name for p in (tmp_path / "t" / "rows").glob("*/*")} == {f"run={run:019d}" for _, run in live}
    assert {r.doc_id: r.v for r in runs.read_runs(spark, path).collect()} == want


def status(spark, rows):
    base = spark.createDataFrame(rows, "doc_id string, figure_id string, status string, confidence double")
    blank = triage.new_status(base.select("doc_id", "figure_id", F.lit("p").alias("image_path")))
    return blank.drop("status", "confidence").join(base, ["doc_id", "figure_id"])


def test_status_store(spark, tmp_path):
    path = str(tmp_path / "store")
    state = lambda: {(r.doc_id, r.figure_id): r.status for r in files.read_statuses(spark, path).collect()}
    sink.write_statuses(status(spark, [("a", "f1", "needs_external", 0.3), ("a", "f2", "x", 0.3), ("b", "f1", "y", 0.3)]), path, 1)
    sink.write_statuses(status(spark, [("a", "f1", "z", 0.3)]), path, 2)
    assert state() == {("a", "f1"): "z", ("a", "f2"): "x", ("b", "f1"): "y"}  # neighbours keep theirs
    results = spark.createDataFrame([("a", "f2", '{"k": 1}', "p", "m"), ("q", "f9", "{}", "p", "m")], "doc_id string, figure_id string, r string, provider string, model string")
    sink.store_analyses(results.select("doc_id", "figure_id", F.parse_json("r").alias("result"), "provider", "model"), path, 3)
    assert state() == {("a", "f1"): "z", ("a", "f2"): "resolved_external", ("b", "f1"): "y"}
    row = files.read_statuses(spark, path).where("figure_id = 'f2'").select(F.variant_get("external_llm_result", "$.k", "int").alias("k"), "needs_external", "external_llm_model").first()
    assert tuple(row) == (1, False, "m")
    sink.remove_statuses(spark.createDataFrame([("b", "f1")], "doc_id string, figure_id string"), path, 4)
    runs.merge_runs(spark, path, 2)
    assert state() == {("a", "f1"): "z", ("a", "f2"): "resolved_external"}
    assert tuple(files.read_statuses(spark, path).columns) == S.STATUS_COLUMNS


def test_status_files_are_taken_over(spark, tmp_path):
    home = tmp_path / "in" / "doc" / "processing"
    home.mkdir(parents=True)
    record = {"figure_id": "fig_0001", "status": "needs_external", "external_llm_result": {"a": [1]}}
    (home / "fig_0001.json").write_text(json.dumps(record), encoding="utf-8")
    sink.write_statuses(files.read_statuses(spark, str(tmp_path / "in")), str(tmp_path / "store"), 0)
    r = files.read_statuses(spark, str(tmp_path / "store")).select("doc_id", "figure_id", F.variant_get("external_llm_result", "$.a[0]", "int")).first()
    assert tuple(r) == ("doc", "fig_0001", 1)


def test_source_changes(spark):
    ddl = "path string, sha256 string, size bigint, mtime timestamp"
    t = datetime.datetime(2024, 1, 1)
    before = spark.createDataFrame([("a", "1", 1, t), ("b", "2", 1, t), ("c", "3", 1, t), ("d", "4", 1, t), ("e", None, 1, None)], ddl)
    now = spark.createDataFrame([("a", "1", 1, t), ("b", "9", 1, t), ("c", "3", 1, t.replace(year=2025)), ("n", "5", 1, t), ("e", None, 1, None)], ddl)
    got = {r.path: r.change for r in files.source_changes(now, before).collect()}
    assert got == {"a": "same", "b": "changed", "c": "touched", "d": "deleted", "n": "new", "e": "same"}


def test_lines_keep_their_order(spark, tmp_path):
    lines = spark.range(50).select(
        F.lit("d").alias("doc_id"), F.lit(0).alias("section"), (49 - F.col("id")).alias("ord"), F.lit(0).alias("line_no"), F.format_string("l%02d", 49 - F.col("id")).alias("line")
    )
    sink.write_lines(lines, str(tmp_path / "l"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "l").glob("part-*")))
    assert text.split() == [f"l{i:02d}" for i in range(50)]


@pytest.mark.parametrize("part_size", [2, 10_000])
def test_assemble(spark, part_size):
    docs = spark.createDataFrame([("a",), ("b",)], "doc_id string").select(
        "doc_id", F.struct(F.lit("p").alias("path")).alias("source"), F.struct(F.lit(1).alias("page_count")).alias("doc_stats")
    )
    blocks = N.normalize_blocks(spark.createDataFrame([("a", i, f"t{i}") for i in range(1, 6)], "doc_id string, ord bigint, text string"), dense=True)
    none = blocks.where("false")
    got = export.assemble_documents(docs, blocks, none, none, part_size=part_size).orderBy("doc_id", "part").collect()
    assert [x.text for r in got if r.doc_id == "a" for x in r.blocks] == [f"t{i}" for i in range(1, 6)]
    assert all(len(r.blocks) <= part_size and r.tables == [] and r.figures == [] for r in got)
    assert [(r.doc_id, r.part) for r in got] == ([("a", 0), ("a", 1), ("a", 2), ("b", 0)] if part_size == 2 else [("a", 0), ("b", 0)])


def test_children_move_once(spark):
    docs = spark.createDataFrame([("a",)], "doc_id string").select("doc_id", F.struct(F.lit("p").alias("path")).alias("source"), F.struct(F.lit(1).alias("n")).alias("doc_stats"))
    blocks = N.normalize_blocks(spark.createDataFrame([("a", 1, "t"), ("gone", 1, "t")], "doc_id string, ord bigint, text string"), dense=True)
    whole = export.assemble_documents(docs, blocks, figures=blocks)
    assert [(r.doc_id, len(r.blocks), len(r.figures)) for r in whole.collect()] == [("a", 1, 1)]
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan
    physical = whole._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("collect_list") == 4  # partial and final, for two kinds, in one aggregate


def test_long_cells_and_rows(spark):
    grid = [["h", "h"], ["1"], ["2", "3", "4"]]
    t = spark.createDataFrame([("d", "table_0001", grid)], "doc_id string, id string, grid array<array<string>>")
    cells = sorted((r.row, r.col, r.header, r.value) for r in export.table_cells_long(t).collect())
    assert cells == [(0, 0, "h", "h"), (0, 1, "h", "h"), (1, 0, "h", "1"), (2, 0, "h", "2"), (2, 1, "h", "3"), (2, 2, None, "4")]
    rows = spark.createDataFrame([("d", i, r) for i, r in enumerate(grid)], "doc_id string, row int, cells array<string>")
    by_row = export.rows_to_markdown(rows).orderBy("row", "line_no").collect()
    whole = export.table_to_markdown(t).first().markdown
    assert "\n".join(r.line for r in by_row) + "\n" == whole
    by_row = export.rows_to_csv(rows).orderBy("row").collect()
    assert "\n".join(r.line for r in by_row) + "\n" == export.table_to_csv(t).first().csv
    assert json.loads(export.table_to_json(t.withColumn("caption", F.lit("c"))).first().json) == {"id": "table_0001", "grid": grid, "caption": "c"}
