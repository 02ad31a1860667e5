"""How the driver's tables stand in for documents, figures, statuses and analyses.

Bindings read whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.functions.rules import Rule
from leafmill.plans.session import configure
from leafmill.sources.tables import read_texts

BLOCKS_PER_PAGE = 5
MODEL = "local-model"
RUN_STAMP = "2024-06-01 00:00:00"

# Word fragments that occur in the invented prose of the driver's documents.
CORPUS_FIGURE_RULES = (
    Rule(("schen", "ción"), "table_image", 0.75, "caption fragment", caption_only=True),
    Rule(("ndst", "auxle"), "timing_diagram", 0.92, "fragment one"),
    Rule(("erder", "quevi"), "state_machine", 0.88, "fragment two"),
    Rule(("thing", "lich unge"), "block_diagram", 0.9, "fragment three"),
    Rule(("eau. l", "on the"), "plot", 0.85, "fragment four"),
)
CORPUS_DESCRIPTION_RULES = (
    Rule(("ndst", "auxle"), "logo"),
    Rule(("erder", "quevi"), "photo"),
    Rule(("thing", "lich", "eau. l"), "plot"),
    Rule(("ción", "on the"), "schematic"),
    Rule(("sch",), "mechanical"),
)
CORPUS_TAGS = ("tion", "the", "eau", "sch", "ing", "ción")


LEAST_NEEDLE = 5


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each longer word of each benchmark item, every fifth for captions only."""
    word = F.lower("word")
    return (
        table(spark, sf_dir, "benchmark")
        .select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
        .where(F.char_length("word") >= LEAST_NEEDLE)
        .select(
            (F.col("item_id") * 100_000 + F.col("pos")).cast("bigint").alias("priority"),
            F.array(word).alias("needles"),
            F.format_string("item_%d", "item_id").alias("label"),
            F.lit(0.5).alias("confidence"),
            word.alias("rationale"),
            (F.col("pos") % 5 == 0).alias("caption_only"),
        )
    )


TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    configure(spark)
    return read_texts(spark, path) if name in TEXT_TABLES else spark.read.parquet(path)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def pages_of(text: Column) -> Column:
    return F.ceil(F.size(lines(text)) / BLOCKS_PER_PAGE).cast("int")


def blocks_of(docs: DataFrame) -> DataFrame:
    """One block per line of each document; five blocks to a page."""
    return docs.select("doc_id", F.posexplode(lines(F.col("text"))).alias("pos", "text")).select(
        "doc_id",
        (F.col("pos") + 1).cast("bigint").alias("ord"),
        (F.expr(f"pos div {BLOCKS_PER_PAGE}") + 1).cast("int").alias("page"),
        "text",
    )


def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_of(table(spark, sf_dir, "documents"))


def items_of(docs: DataFrame) -> DataFrame:
    """Blocks with heading levels: short lines head the longer ones that follow."""
    n = F.length("text")
    return blocks_of(docs).withColumn("level", F.when(n <= 40, 1).when(n <= 60, 2).when(n <= 80, 3))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "documents"))


def raw_figures_of(docs: DataFrame) -> DataFrame:
    """One figure per document line: the line is its caption, the next line its response.

    Sizes come from the lengths of the line; a line without closing punctuation
    has no image.
    """
    all_lines = lines(F.col("text"))
    replies = F.slice(all_lines, F.lit(2), F.size(all_lines))
    pairs = F.arrays_zip(all_lines.alias("caption"), replies.alias("reply"))
    rows = docs.select("doc_id", F.posexplode(pairs).alias("pos", "p"))
    caption = F.col("p.caption")
    ends = caption.rlike(r"[.!?]\z")
    return rows.select(
        "doc_id",
        (F.col("pos") + 1).cast("bigint").alias("ord"),
        (F.expr(f"pos div {BLOCKS_PER_PAGE}") + 1).cast("int").alias("page"),
        caption.alias("caption"),
        F.when(ends, F.format_string("img/%d/%d.png", "doc_id", F.col("pos") + 1)).alias("image_path"),
        F.length(caption).alias("width"),
        F.size(F.split(caption, " ")).alias("height"),
        F.col("p.reply").alias("reply"),
    )


def raw_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_figures_of(table(spark, sf_dir, "documents"))


def with_ids(raw: DataFrame) -> DataFrame:
    """Document-line figures with ids; positions are dense, so numbering needs no shuffle."""
    return raw.withColumn("figure_id", T.numbered_id("fig", "ord"))


def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(raw_figures(spark, sf_dir))


def responses_of(raw: DataFrame) -> DataFrame:
    return with_ids(raw).select("doc_id", "figure_id", F.col("reply").alias("response"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses_of(raw_figures(spark, sf_dir))


def existing_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents count as partly done: their first figure was settled externally."""
    labels = table(spark, sf_dir, "labels")
    none = F.lit("")
    return labels.select(
        "doc_id",
        F.lit("fig_0001").alias("figure_id"),
        F.format_string("img/%d/1.png", "doc_id").alias("image_path"),
        F.lit("resolved_external").alias("status"),
        F.lit("local_llm").alias("stage"),
        F.lit("ollama").alias("local_llm_provider"),
        F.lit(MODEL).alias("local_llm_model"),
        F.lit("Settled before").alias("local_llm_description"),
        F.when(F.col("toxic") == 1, "plot").otherwise("photo").alias("local_llm_classification"),
        none.alias("external_llm_provider"),
        none.alias("external_llm_model"),
        F.lit(None).cast("variant").alias("external_llm_result"),
        F.lit(False).alias("needs_external"),
        F.lit(0.3).alias("confidence"),
        F.lit(RUN_STAMP).cast("timestamp").alias("processed_at"),
    )


def talk_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw figure per turn of a conversation; positions have gaps."""
    talk = table(spark, sf_dir, "conversations")
    return talk.select(
        F.col("conv_id").alias("doc_id"),
        (F.col("turn") * 2).alias("ord"),
        (F.expr("turn div 2") + 1).cast("int").alias("page"),
        F.col("text").alias("caption"),
        F.when(
            F.col("text").rlike(r"[.!?]\z"), F.format_string("img/%d/%d.png", "conv_id", "turn")
        ).alias("image_path"),
        F.length("text").alias("width"),
        (F.col("turn") + 4).cast("int").alias("height"),
    )


def talk_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turn that follows each turn, keyed by the position of the earlier one."""
    talk = table(spark, sf_dir, "conversations")
    return talk.select(
        F.col("conv_id").alias("doc_id"),
        (F.col("turn") * 2 - 2).alias("ord"),
        F.col("text").alias("response"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_tables_of(table(spark, sf_dir, "documents"))


def raw_tables_of(docs: DataFrame) -> DataFrame:
    """One ragged table per document: first line as header, further lines as rows, words as cells."""
    grid = F.transform(lines(F.col("text")), lambda x: F.split(x, " "))
    return docs.select(
        "doc_id",
        F.lit(1).cast("bigint").alias("ord"),
        F.lit(1).alias("page"),
        F.concat_ws(" ", "lang", "source").alias("caption"),
        F.get(grid, F.lit(0)).alias("header"),
        F.slice(grid, F.lit(2), F.size(grid)).alias("rows"),
    )


def talk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a page with one table: lines are rows, words cells that span by their length."""
    def cell(word: Column) -> Column:
        n = F.length(word)
        told = F.replace(F.replace(word, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        down = F.when((n > 0) & (n % 7 == 0), " rowspan=3").otherwise("")
        return F.concat(F.lit("<td"), down, F.when((n > 0) & (n % 5 == 0), " colspan='2'").otherwise(""), F.lit(">"), told)

    row = F.transform(lines(F.col("text")), lambda x: F.array_join(F.transform(F.split(x, " "), cell), ""))
    html = F.concat(F.lit("<table><tr>"), F.array_join(row, "<tr>"), F.lit("</table>"))
    talk = table(spark, sf_dir, "conversations")
    return talk.select(F.concat_ws("/", "conv_id", "turn").alias("doc_id"), html.alias("html"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as the rows of one table, one record per row, before numbering."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("doc_id"),
        F.col("event_id").alias("ord"),
        F.array(
            F.col("event_id").cast("string"), F.col("event_type"), F.col("props")
        ).alias("cells"),
    )


def status_of_event(event_type: Column) -> Column:
    return (
        F.when(event_type == "error", "needs_external")
        .when(event_type.isin("view", "click"), "resolved_local")
        .when(event_type == "purchase", "resolved_external")
        .otherwise("unknown")
    )


def as_status_log(events: DataFrame) -> DataFrame:
    """Events as status rewrites: user = document, property ``k`` = figure."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("user_id").alias("doc_id"),
        T.numbered_id("fig", k + 1).alias("figure_id"),
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("processed_at"),
        status_of_event(F.col("event_type")).alias("status"),
        F.col("event_type").alias("local_llm_classification"),
        F.concat(F.lit("note "), F.col("event_type")).alias("local_llm_description"),
        F.format_string("img/%d/%d.png", F.col("user_id"), k + 1).alias("image_path"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_status_log(table(spark, sf_dir, "events"))


# Classes handed out to the analyses in turn; the last two are outside the vocabulary.
ANALYSIS_TURN = (
    "plot",
    "table_image",
    "timing_diagram",
    "block_diagram",
    "state_machine",
    "schematic",
    "pinout",
    "register_map",
    "wiring_diagram",
    "photo",
    "mechanical",
    "screenshot",
    "other",
    "noise",
    "sketch",
)


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One external analysis per turn, its structured data built from the words.

    The class follows from the length of the text.  The structured data passes
    through JSON text, as it would when read from files.
    """
    talk = table(spark, sf_dir, "conversations")
    ws = T.words("text")
    n = F.size("w")
    label = F.element_at(
        F.array(*[F.lit(c) for c in ANALYSIS_TURN]),
        (F.length("text") % len(ANALYSIS_TURN) + 1).cast("int"),
    )
    base = talk.withColumn("w", ws).withColumn("classification", label)

    def each(fn) -> Column:
        return F.transform("w", fn)

    def following(i: Column) -> Column:
        return F.coalesce(F.get("w", i + 1), F.lit(""))

    newline = F.when(F.col("conv_id") % 2 == 0, F.lit("\n")).otherwise(F.lit("\\n"))
    csv = F.concat(
        F.lit("x,y"),
        newline,
        F.array_join(
            each(lambda w, i: F.format_string("%d,%d", i, F.length(w))), "\n"
        ),
    )
    shapes = {
        "plot": F.struct(
            F.lit("word").alias("x_axis"),
            F.lit("length").alias("y_axis"),
            F.array(
                F.struct(
                    F.col("role").alias("name"),
                    each(
                        lambda w, i: F.struct(i.alias("x"), F.length(w).alias("y"))
                    ).alias("data_points"),
                )
            ).alias("series"),
            csv.alias("csv"),
        ),
        "table_image": F.struct(
            F.split(F.get(lines(F.col("text")), F.lit(0)), " ").alias("headers"),
            F.transform(
                F.slice(lines(F.col("text")), F.lit(2), F.size(lines(F.col("text")))),
                lambda x: F.split(x, " "),
            ).alias("rows"),
        ),
        "timing_diagram": F.struct(
            each(
                lambda w, i: F.struct(w.alias("name"), following(i).alias("transitions"))
            ).alias("signals")
        ),
        "schematic": F.struct(
            each(
                lambda w, i: F.struct(
                    F.format_string("R%d", i + 1).alias("ref"),
                    w.alias("type"),
                    F.length(w).cast("string").alias("value"),
                )
            ).alias("components")
        ),
        "pinout": F.struct(
            each(
                lambda w, i: F.struct(
                    (i + 1).alias("number"), w.alias("name"), F.concat(F.lit("pin "), w).alias("function")
                )
            ).alias("pins")
        ),
        "register_map": F.struct(
            F.get("w", F.lit(0)).alias("register_name"),
            each(
                lambda w, i: F.struct(
                    F.format_string("%d:%d", i * 4 + 3, i * 4).alias("range"),
                    w.alias("name"),
                    F.lit("R/W").alias("access"),
                )
            ).alias("bits"),
        ),
        "wiring_diagram": F.struct(
            each(
                lambda w, i: F.struct(
                    w.alias("from"), following(i).alias("to"), F.lit("red").alias("wire_color")
                )
            ).alias("connections")
        ),
    }
    graph = F.struct(
        F.array_distinct("w").alias("nodes"),
        each(
            lambda w, i: F.struct(
                w.alias("from"), following(i).alias("to"), F.format_string("e%d", i).alias("label")
            )
        ).alias("connections"),
    )
    shapes["block_diagram"] = shapes["state_machine"] = graph
    shapes["photo"] = shapes["mechanical"] = shapes["other"] = F.struct(
        F.col("text").alias("description")
    )
    # Screenshots come without their description: a gap that the quality check finds.
    shapes["screenshot"] = F.struct(F.col("text").alias("caption"))
    data = F.lit("{}")
    for name, shape in shapes.items():
        data = F.when(F.col("classification") == name, F.to_json(shape)).otherwise(data)
    meta = F.when(
        F.col("turn") != 1,
        F.struct(
            F.lit("some-provider").alias("provider"),
            F.concat(F.lit("model-"), F.col("role")).alias("model"),
            F.lit("2024-01-01T00:00:00Z").alias("generated_at"),
            F.lit("v1").alias("prompt_version"),
        ),
    )
    return base.select(
        F.col("conv_id").alias("doc_id"),
        T.numbered_id("fig", F.expr("turn")).alias("figure_id"),
        "classification",
        F.get("w", F.lit(0)).alias("title"),
        F.col("text").alias("summary"),
        F.parse_json(data).alias("structured_data"),
        F.col("w").alias("component_references"),
        meta.alias("analysis_meta"),
        F.when(n % 7 == 0, F.create_map().cast("map<string,string>"))
        .otherwise(
            F.create_map(
                F.lit("words"), n.cast("string"), F.lit("first"), F.get("w", F.lit(0))
            )
        )
        .alias("key_values"),
        F.when(n % 11 == 0, 1.5).otherwise(0.5).alias("confidence"),
    )
