import pytest
from pyspark.sql import functions as F

from leafmill.functions import grids as G
from leafmill.functions import rules as R
from leafmill.functions import text as T


def values(spark, rows, *exprs):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [tuple(r)[0] for r in df.orderBy("i").select(*exprs).collect()]


def test_valid_descriptions(spark):
    cases = {
        "A simple logo of some company": True,
        "<unk><unk><s>": False,
        "   ": False,
        "": False,
        None: False,
        "123456789012345": False,
        "abcdefghi": False,
        "abcdefghij": True,
        "abcdefghijkl" + "\x01" * 18: False,
        "abcdefghijkl" + "\x01" * 8: True,
        "Éauou ñandú 漢字漢字": True,
    }
    assert values(spark, list(cases), T.is_valid_description("x")) == list(cases.values())


def test_counts_match_python(spark):
    texts = ["a\tb\nc", "é漢字!", "x y", "١٢٣ abc", "\x07bell", "é"]
    printable = [sum(c.isprintable() for c in t) for t in texts]
    letters = [sum(c.isalpha() for c in t) for t in texts]
    assert values(spark, texts, T.printable_count("x")) == printable
    assert values(spark, texts, T.letter_count("x")) == letters


def test_strip_matches_python(spark):
    texts = ["  a b ", "\n\ta\x1c", " x ", "　", "plain"]
    assert values(spark, texts, T.strip("x")) == [t.strip() for t in texts]


@pytest.mark.parametrize("done,total,want", [(0, 0, 0.0), (1, 16, 6.2), (105, 215, 48.8), (7, 23, 30.4), (3, 3, 100.0)])
def test_percent(spark, done, total, want):
    row = spark.range(1).select(T.percent(F.lit(done), F.lit(total)).alias("p")).first()
    assert row.p == want


def test_names(spark):
    paths = ["a/b/c.tar.gz", "x.pdf", "dir/noext", ".hidden", "a/b/"]
    assert values(spark, paths, T.file_stem("x")) == ["c.tar", "x", "noext", ".hidden", "b"]
    assert values(spark, ["fig_0012", "fig_10000", "x"], T.ordinal_of("x")) == [12, 10000, None]


def test_csv_cells(spark):
    cells = ["a,b", 'say "x"', "l\nf", "c\rr", "p|q", ""]
    want = ['"a,b"', '"say ""x"""', '"l\nf"', "c\rr", "p|q", ""]
    assert values(spark, cells, G.csv_escape(F.col("x"))) == want


def test_grids(spark):
    grid = [["h1", "h2", "h1"], ["a"], ["1", "2", "3", "4"], ["θ JA", "°C/W", "x"]]
    df = spark.createDataFrame([(grid,), ([],), ([["only"]],)], "g array<array<string>>")
    rows = df.select(G.grid_to_csv(F.col("g")), G.grid_to_markdown(F.col("g"))).collect()
    assert rows[0][0] == "h1,h2,h1\na\n1,2,3,4\nθ JA,°C/W,x\n"
    assert rows[0][1] == (
        "| h1 | h2 | h1 |\n| --- | --- | --- |\n| a |  |  |\n| 1 | 2 | 3 |\n| θ JA | °C/W | x |\n"
    )
    assert tuple(rows[1]) == ("", "")
    assert tuple(rows[2]) == ("only\n", "| only |\n| --- |\n")


CAPTIONS = [
    ("Figure 3. Output voltage plot", "", "plot", 0.85),
    ("Functional block diagram", "", "block_diagram", 0.9),
    ("", "see table 1", "other", 0.4),
    ("Table of timing", "", "table_image", 0.75),
    ("", "state machine description", "state_machine", 0.88),
    ("schematic and plot", "", "block_diagram", 0.72),
    ("a WAVEFORM", "", "timing_diagram", 0.82),
    ("a Graph", "", "plot", 0.8),
    (None, None, "other", 0.4),
]


def test_figure_rules(spark):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b, *_) in enumerate(CAPTIONS)], "i int, caption string, ctx string"
    )
    got = R.classify(df, F.col("caption"), F.col("ctx")).orderBy("i").collect()
    assert [(r.classification.type, r.classification.confidence) for r in got] == [
        (c[2], c[3]) for c in CAPTIONS
    ]
    assert got[4].classification.rationale == "caption mentions state"


def test_description_rules(spark):
    cases = {
        "the company logo": "logo",
        "narrow": "icon",
        "mapping": "pinout",
        "a clock signal": "timing_diagram",
        "side view": "screenshot",
        "brown": "table_image",
        "circuit board": "block_diagram",
        "PCB": "photo",
        "mechanical": "mechanical",
        "nothing": "other",
        "temperature vs load": "plot",
    }
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    got = [r.label for r in R.infer_label(df, "x").orderBy("i").collect()]
    assert got == list(cases.values())


def test_tags(spark):
    got = values(spark, ["I2C DAC timing", "mapping", ""], R.tags(F.col("x")))
    assert got == [["dac", "i2c", "timing"], ["pin"], []]
