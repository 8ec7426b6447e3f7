from __future__ import annotations

from decimal import Decimal

import pytest

from parcelspark.sources.schemas import DDL, schema
from parcelspark.sources.tables import parquet_tables, read_sheet, write_report


@pytest.mark.parametrize("name", sorted(DDL))
def test_schemas_parse(name):
    assert len(schema(name)) >= 2


def test_sheet_and_report_round_trip(spark, tmp_path):
    header = ",".join(schema("smu_template_2").names)
    line = "07/15/2023,CGK,SUB,DPS,3,12.5,BM1,VM1,JAWA,SMU1,100.25,FL1,AIR,V1"
    (tmp_path / "sheet.csv").write_text(header + "\n" + line + "\n")
    sheet = read_sheet(spark, str(tmp_path / "sheet.csv"))
    assert sheet.schema == schema("smu_template_2")
    write_report(sheet, str(tmp_path / "smu_template_2.parquet"))
    write_report(sheet, str(tmp_path / "smu_template_2.parquet"))
    row = parquet_tables(spark, str(tmp_path), ["smu_template_2"])["smu_template_2"].collect()
    assert len(row) == 1 and row[0].smu_weight == Decimal("12.500000000") and row[0].no_of_packages == 3


def test_sheet_with_other_columns_is_refused(spark, tmp_path):
    names = schema("smu_template_2").names
    names[0] = "date"
    (tmp_path / "sheet.csv").write_text(",".join(names) + "\n" + ",".join("1" * len(names)) + "\n")
    with pytest.raises(Exception):
        read_sheet(spark, str(tmp_path / "sheet.csv")).collect()
