from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.llm.common import numbered, unused
from leafmill.scratch import settle


def test_unused_names():
    assert unused("rid", ["a"]) == "rid"
    assert unused("rid", ["RID", "rid_"]) == "rid__"
    assert unused("rid", ["rid_File"], "_file") == "rid_"


def test_rows_of_a_parquet_table_with_such_columns(spark):
    names = ["rid", "RID_file", "rid__row", "rid___no", "_metadata_", "doc_id"]
    df = spark.range(30).select(*[F.lit(k).alias(n) for k, n in enumerate(names)])
    for table in (df, settle(df.repartition(3), "table")):
        held, row = numbered(table, "table")
        assert held.columns == [*names, row]
        assert len({r[row] for r in held.collect()}) == 30
