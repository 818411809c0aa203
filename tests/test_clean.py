import pytest
from pyspark.sql import functions as F

from checks.views import credit_raw
from riskframe.operators import clean
from riskframe.schemas import feature_table_schema
from riskframe.sources import scan
from riskframe.spec import CREDIT, DOMAINS, RAW_TARGET
from tests.conftest import SMALL


def values(df, column):
    return {r[0] for r in df.select(column).distinct().collect()}


def test_cleaned_names_types_and_domains(spark):
    df = clean.require_clean(clean.clean(credit_raw(spark, SMALL)))
    assert df.columns == [*CREDIT.clean, "Default"]
    assert RAW_TARGET not in df.columns
    assert all(c.capitalize() == c for c in df.columns)
    assert dict(df.dtypes)["Id"] == "string"
    assert values(df, "Education") == {1, 2, 3, 4}
    assert values(df, "Marriage") == {1, 2, 3}
    assert min(values(df, "Pay_6")) == 0
    assert clean.domain_violations(df, DOMAINS).isEmpty()


def test_corrections_are_single_pass_and_cover_payment_amounts(spark):
    df = spark.createDataFrame([(-1, -2.0, 5), (3, 7.5, 4)], "Pay_0 int, Pay_amt1 double, Education int")
    assert clean.correct_values(df).collect() == [(0, 0.0, 4), (3, 7.5, 4)]
    chained = clean.correct_values(df, {"Education": {5: 4, 4: 1}})
    assert [r["Education"] for r in chained.collect()] == [4, 1]


def test_gates(spark):
    good = spark.createDataFrame([("1", 2.0, 1)], "Id string, Age double, Default int")
    assert clean.require_clean(good) is good
    with pytest.raises(clean.QualityError, match="no rows"):
        clean.require_clean(good.limit(0))
    with pytest.raises(clean.QualityError, match="no rows"):
        clean.require_rows(good.limit(0))
    with pytest.raises(clean.QualityError, match="Age"):
        clean.require_clean(good.withColumn("Age", F.lit(None).cast("double")))
    with pytest.raises(clean.QualityError, match="Default"):
        clean.require_clean(good.drop("Default"))
    with pytest.raises(clean.QualityError, match="b, c"):
        clean.require_columns(good, ["Id", "b", "c"])
    with pytest.raises(clean.QualityError, match="numeric"):
        clean.require_numeric(good, "Id")


def test_csv_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = credit_raw(spark, SMALL)
    raw.write.option("header", True).csv(path)
    back = scan.scan_csv(spark, path)
    assert back.columns == raw.columns and back.dtypes == raw.dtypes
    assert sorted(back.collect()) == sorted(raw.collect())
    assert scan.scan_csv(spark, path, infer=True).columns == raw.columns
    with pytest.raises(FileNotFoundError):
        scan.scan_csv(spark, str(tmp_path / "absent"))


def test_conform_and_empty(spark, credit_rows):
    shuffled = credit_rows.select(*reversed(credit_rows.columns))
    df = scan.conform(shuffled, feature_table_schema())
    assert df.columns == CREDIT.clean
    assert {t for _, t in df.dtypes[1:]} == {"double"}
    none = scan.empty_like(credit_rows)
    assert none.isEmpty() and none.schema == credit_rows.schema


def test_missing_report(spark, credit_rows):
    report = clean.missing_columns_report(spark, credit_rows, ["Id", "nope"])
    assert [r[0] for r in report.collect()] == ["nope"]
