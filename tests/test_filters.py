import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from leafmill.operators import filters as L
from leafmill.operators import normalize as N


def pages_of(df):
    return sorted(r.page for r in df.collect())


SPECS = [
    (None, [1, 2, 3, 4, 5, 6, 7, 8]),
    ("", [1, 2, 3, 4, 5, 6, 7, 8]),
    (",", [1, 2, 3, 4, 5, 6, 7, 8]),
    ("1-3,7", [1, 2, 3, 7]),
    ("1, 3-5", [1, 3, 4, 5]),
    ("5-3", [1, 2, 3, 4, 5, 6, 7, 8]),
    ("5-3,2", [2]),
]


@pytest.mark.parametrize("spec,want", SPECS)
def test_literal_and_table_spec(spark, spec, want):
    df = spark.range(1, 9).select(F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("page"))
    assert pages_of(L.filter_pages(df, spec)) == want
    table = spark.createDataFrame([("d", spec)], "doc_id string, spec string")
    assert pages_of(L.filter_pages_by_spec(df, table)) == want


def test_bad_spec_is_an_error(spark):
    df = spark.range(1, 3).select(F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("page"))
    with pytest.raises(ValueError):
        L.filter_pages(df, "x")
    bad = spark.createDataFrame([("d", "x")], "doc_id string, spec string")
    with pytest.raises(PySparkException):
        L.filter_pages_by_spec(df, bad).collect()


def test_unlisted_documents_pass(spark):
    df = spark.createDataFrame([("a", 1), ("b", 9)], "doc_id string, page int")
    specs = spark.createDataFrame([("a", "2")], "doc_id string, spec string")
    assert [r.doc_id for r in L.filter_pages_by_spec(df, specs).collect()] == ["b"]


@pytest.mark.parametrize("n,want", [(None, 12), (0, 0), (2, 4), (5000, 12)])
def test_limit(spark, n, want):
    df = spark.range(12).select(
        F.when(F.col("id") < 10, "hot").otherwise("b").alias("doc_id"), F.col("id").alias("ord")
    )
    got = L.limit_per_document(df, n)
    assert got.count() == want
    if n == 2:
        assert sorted((r.doc_id, r.ord) for r in got.collect()) == [("b", 10), ("b", 11), ("hot", 0), ("hot", 1)]


@pytest.mark.parametrize("n,width", [(1, 1), (3, 2), (7, 4), (1001, 8)])
def test_limit_over_many_segments(spark, n, width):
    df = spark.range(60).select(F.expr("id % 3").alias("doc_id"), (F.col("id") * F.col("id")).alias("ord"))
    got = sorted((r.doc_id, r.ord) for r in L.limit_per_document(df, n, width=width).collect())
    assert got == sorted((d, i * i) for d in range(3) for i in list(range(d, 60, 3))[:n])


def test_limit_prunes_before_the_shuffle(spark):
    df = spark.range(12).select(F.expr("id div 10").alias("doc_id"), F.col("id").alias("ord"))
    plan = L.limit_per_document(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_block_defaults(spark):
    ddl = "doc_id string, ord bigint, page int, type string, text string, enriched_text string, headings array<string>, bbox array<double>"
    raw = [("d", 6, None, None, None, None, None, None), ("d", 2, 3, "text", "t", "e", ["H"], [1.0, 2.0, 3.0, 4.0])]
    got = N.normalize_blocks(spark.createDataFrame(raw, ddl)).orderBy("ord").collect()
    assert [(r.id, r.page, r.type, r.text, r.headings) for r in got] == [
        ("blk_0001", 3, "text", "t", ["H"]),
        ("blk_0002", 1, "text", "", []),
    ]
    assert got[1].bbox == [0.0] * 4 and got[1].heading_level is None


def test_fifteen_blocks(spark):
    raw = [("d", i + 1, i // 3 + 1, f"t{i}") for i in range(15)]
    got = N.normalize_blocks(spark.createDataFrame(raw, "doc_id string, ord bigint, page int, text string"))
    rows = got.orderBy("ord").collect()
    assert [r.id for r in rows] == [f"blk_{i:04d}" for i in range(1, 16)]


def test_table_grids(spark):
    ddl = "doc_id string, ord bigint, page int, caption string, bbox array<double>, header array<string>, rows array<array<string>>"
    raw = [
        ("d", 1, 2, "DAC pins", None, ["a", "b"], [["1", None]]),
        ("d", 2, None, None, None, ["a"], []),
        ("d", 3, None, None, None, [], []),
        ("d", 4, None, None, None, None, None),
    ]
    got = N.normalize_tables(spark.createDataFrame(raw, ddl)).orderBy("ord").collect()
    assert [r.grid for r in got] == [[["a", "b"], ["1", ""]], [["a"]], [], []]
    assert got[0].tags == ["dac", "pin"] and got[1].page == 1
    assert got[2].json_path == "out/d/tables/table_0003.json"


def test_imageless_numbers_are_consumed(spark):
    raw = [("d", 10, "a.png"), ("d", 20, None), ("d", 30, "c.png")]
    df = spark.createDataFrame(raw, "doc_id string, ord bigint, image_path string")
    assert [r.figure_id for r in N.drop_imageless(df).orderBy("ord").collect()] == ["fig_0001", "fig_0003"]


def test_figure_ids_kept(spark):
    df = spark.createDataFrame(
        [("d", 1, "fig_0009", None), ("d", 2, None, "cap")], "doc_id string, ord bigint, figure_id string, caption string"
    )
    got = N.normalize_figures(df).orderBy("ord").collect()
    assert [(r.figure_id, r.caption, r.page, r.image_path) for r in got] == [
        ("fig_0009", "", 1, ""),
        ("fig_0002", "cap", 1, ""),
    ]


def test_pages_and_captions(spark):
    df = spark.createDataFrame([([None, 4, 2],), ([],), ([None],)], "p array<int>")
    rows = df.select(N.first_page(F.col("p")), N.min_page(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [(4, 2), (1, 1), (1, 1)]
    row = spark.range(1).select(
        N.resolve_caption(F.lit(""), F.lit(None).cast("string"), F.lit("x")),
        N.resolve_caption(F.lit(None).cast("string")),
        N.page_count(F.lit(None).cast("int"), F.lit(0)),
        N.page_count(F.lit(7), F.lit(2)),
    ).first()
    assert tuple(row) == ("x", "", 1, 7)
