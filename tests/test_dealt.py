"""Short rows from which much work comes are dealt to tasks by number, not by bytes."""

from quarrystone.plans import catalogue, checks
from quarrystone.sources import writers
from quarrystone.sources.shared import dealt


def test_rows_are_dealt_by_number(spark):
    rows = spark.range(2500).coalesce(1)
    parts = dealt(rows).rdd.glom().map(len).collect()
    assert len(parts) == 3 and sum(parts) == 2500 and max(parts) < 1000
    assert dealt(rows.where("id < 0")).count() == 0


def test_documents_of_many_parts_are_many_tasks(spark, tmp_path):
    spark.range(2500).selectExpr("id as p_partkey", "'BRAND' as p_brand", "'some name' as p_name", "cast(1 + id % 50 as int) as p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert checks._pdfs(spark, str(tmp_path)).rdd.getNumPartitions() == 3
    for name in ("pdf_characters", "pdf_token_scan", "pdf_kerned_scan"):
        assert catalogue.queries()[name](spark, str(tmp_path)).rdd.getNumPartitions() == 3


def test_characters_of_tables_are_many_tasks(spark, tmp_path):
    spark.range(2500).selectExpr("id as s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    assert checks.table_chars(spark, str(tmp_path)).rdd.getNumPartitions() == 6


def test_short_files_are_written_by_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        rows = spark.range(40).selectExpr("cast(id as string) as name", "0 as at", "'x' as body").coalesce(1)
        written = writers.write_files(rows, str(tmp_path / "f"), "name", "at", "body")
        assert written.count() == 40 and len(written.inputFiles()) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
