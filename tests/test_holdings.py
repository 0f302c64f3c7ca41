import pytest

from ledgerline.operators import holders


def test_missing_columns_are_empty_and_a_code_is_asked_for(spark):
    reports = spark.createDataFrame([("1", None, "20240105"), ("2", "x", "2024")], "corp_code string, repror string, rcept_dt string")
    (row,) = holders.large_holders(reports, " 1").collect()
    assert tuple(row) == ("", "2024-01-05", "1", "", "", "", "", "", "", "", "", "", "") and list(row.asDict()) == list(holders.LARGE_HOLDERS)
    assert holders.executives(reports, "2").first().rcept_dt == "2024"
    for call in (holders.large_holders, holders.executives, holders.standard_accounts):
        with pytest.raises(ValueError, match="required"):
            call(reports, " ")
