"""Rows with lineage that several test modules build."""

from datetime import date

LINEAGE = ("source.csv", 2, date(2026, 7, 30), "20260730_120000")
LINEAGE_SCHEMA = "source_file string, source_row_number bigint, load_date date, batch_id string"
REFERENCE = date(2026, 7, 30)


def table(spark, schema, *rows):
    """Rows without lineage; lineage is added with consecutive row numbers."""
    full = [(*row, LINEAGE[0], i + 2, *LINEAGE[2:]) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, f"{schema}, {LINEAGE_SCHEMA}")


def raw(spark, columns, *rows):
    return table(spark, ", ".join(f"`{c}` string" for c in columns), *rows)
