from farevalue.contracts import FLAGS, GOLD, METRICS, Drift, literal_rows, union_all
from pyspark.sql.types import StructType


def drifted(spark):
    schema = StructType.fromDDL("flight_id string, points_required string, unexpected_field string")
    return literal_rows(spark, schema, [("f1", "many", "extra")])


def test_drift_names_absent_mistyped_and_extra_columns(spark):
    drifts = GOLD.drift(drifted(spark))
    assert Drift("missing", "currency", "string", None) in drifts
    assert Drift("mismatch", "points_required", "bigint", "string") in drifts
    assert drifts[-1] == Drift("unexpected", "unexpected_field", None, "string")
    assert len(drifts) == 14


def test_extra_columns_are_sorted(spark):
    df = spark.range(1).selectExpr("id AS zeta", "id AS alpha")
    assert [d.column for d in GOLD.drift(df) if d.kind == "unexpected"] == ["alpha", "zeta"]


def test_no_drift_on_a_fitting_frame(spark):
    assert GOLD.drift(GOLD.empty(spark)) == []


def test_pad_adds_typed_nulls_and_keeps_the_rest(spark):
    padded = GOLD.pad(drifted(spark))
    assert padded.columns[:3] == ["flight_id", "points_required", "unexpected_field"]
    assert set(padded.columns) == {*GOLD.columns, "unexpected_field"}
    assert dict(padded.dtypes)["cash_price"] == "double"
    assert padded.first()["cash_price"] is None


def test_union_without_frames_is_empty_with_the_schema(spark):
    empty = union_all(FLAGS, spark)
    assert empty.columns == FLAGS.columns and empty.count() == 0


def test_union_goes_by_name(spark):
    one = spark.range(1).selectExpr("1 AS a", "2 AS b")
    other = spark.range(1).selectExpr("4 AS b", "3 AS a")
    rows = union_all(FLAGS, spark, one, other).collect()
    assert [tuple(r) for r in rows] == [(1, 2), (3, 4)]


def test_metric_columns_are_declared_not_null():
    assert METRICS.ddl.count("not null") == 9
