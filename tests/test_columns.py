import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.contracts import Contract
from sievework.functions import scalars, text
from sievework.layouts.shop import ORDERS_LOADED, PRODUCTS_LOADED
from sievework.operators import cleaning, flatten, integrity, keys, profiling
from sievework.plans import ingest


def values(spark, kind, data, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", expr(F.col("v"))).collect())]


def test_flags_keep_null_and_make_other_text_false(spark):
    assert values(spark, "string", ["t", "f", "x", " t", None], text.flag_tf) == [True, False, False, False, None]


def test_tri_state(spark):
    data = ["TRUE", "1", "Yes", "false", "0", "NO", "maybe", " true", None]
    assert values(spark, "string", data, text.tri_state) == [True, True, True, False, False, False, None, None, None]


def test_sentinels(spark):
    data = ["null", " null ", "NULL", "nullable", "", None]
    assert values(spark, "string", data, text.blank_sentinel) == [None, None, "NULL", "nullable", "", None]
    assert values(spark, "string", data, text.is_sentinel) == [True, True, False, False, False, False]


def test_text_defaults(spark):
    data = [" Mouse ", None, ""]
    assert values(spark, "string", data, lambda c: text.tidy(c, "?")) == ["Mouse", "?", ""]
    assert values(spark, "string", data, lambda c: text.tidy(c, "?", empty_as_null=True)) == ["Mouse", "?", "?"]
    assert values(spark, "string", [" Completed ", None], lambda c: text.tidy_lower(c, "unknown")) == ["completed", "unknown"]


def test_dates_and_times(spark):
    day = ["31/01/2024", "31/02/2024", "2024-01-31", "1/2/2024", "38:26.6", "", None, "31/01/2024x"]
    assert values(spark, "string", day, scalars.date_of) == [dt.date(2024, 1, 31)] + [None] * 7
    stamp = ["30/06/2026 03:41", "15:08.8", "30/06/2026", "30/06/2026 24:41", "30/06/2026 03:41:00"]
    assert values(spark, "string", stamp, scalars.timestamp_of)[0] is not None
    assert values(spark, "string", stamp, scalars.timestamp_of)[1:] == [None] * 4


@pytest.mark.parametrize("fmt", [scalars.DAY, scalars.DAY_MINUTE, scalars.DAY_SECOND])
def test_the_guard_never_rejects_readable_text(spark, fmt):
    data = ["31/01/2024", "31/01/2024 10:11", "31/01/2024 10:11:12", "31/01/+12024", "01/01/0001 00:00:00", "x", "", "1/1/2024",
            "31/01/+12024 10:11:12", "31/01/2024  10:11"]
    plain = values(spark, "string", data, lambda c: F.try_to_timestamp(c, F.lit(fmt)).cast("string"))
    assert values(spark, "string", data, lambda c: scalars.timestamp_of(c, fmt).cast("string")) == plain


def test_pairs_need_both_parts(spark):
    data = [("31/01/2024", "10:11:12"), ("31/01/2024", None), (None, "10:11:12"), (None, None), ("31/01/2024", "10:11")]
    df = spark.createDataFrame(data, "d string, t string").select(scalars.moment(F.col("d"), F.col("t")).alias("x"))
    assert [r["x"] is not None for r in df.collect()] == [True, False, False, False, False]


def test_numbers_never_raise(spark):
    assert values(spark, "string", ["-5", "abc", "", None, "99999999999"], scalars.whole) == [-5, None, None, None, None]
    got = values(spark, "string", ["81.900000000000006", "abc", None], scalars.money)
    assert got == [Decimal("81.90"), None, None]


def test_money_default_stays_decimal(spark):
    df = spark.createDataFrame([("5",), (None,), ("x",)], "v string").select(scalars.money_or_zero(F.col("v")).alias("m"))
    assert df.schema["m"].dataType.simpleString() == "decimal(10,2)"
    assert [str(r["m"]) for r in df.collect()] == ["5.00", "0.00", "0.00"]


def test_mean_is_rounded_once(spark):
    data = [("0.05", 10, "0.01"), ("-0.05", 10, "-0.01"), ("1.00", 3, "0.33"), ("2.00", 3, "0.67"), ("0.01", 3, "0.00")]
    df = spark.createDataFrame([(Decimal(a), n, w) for a, n, w in data], "t decimal(18,2), n bigint, want string")
    for r in df.select(scalars.exact_mean(F.col("t"), F.col("n")).alias("m"), "want").collect():
        assert str(r["m"]) == r["want"]
    # 499,999 values of 0.00 and one of 2499.99 average 0.00499998, which four spare digits make 0.0050
    near = spark.createDataFrame([(Decimal("2499.99"), 500_000)], "t decimal(18,2), n bigint")
    assert str(near.select(scalars.exact_mean(F.col("t"), F.col("n"))).first()[0]) == "0.00"


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Product ID", "ORDER \t DATE")
    assert cleaning.standard_names(df).columns == ["product_id", "order_date"]
    with pytest.raises(ValueError, match="collide"):
        cleaning.standard_names(df.toDF("A b", "a_b"))


def test_fingerprint_tells_null_from_empty_and_shifted_text(spark):
    data = [("a", "b"), ("ab", ""), ("", "ab"), ("a", None), (None, "a"), ("-", "a"), ("a", "b")]
    df = spark.createDataFrame(data, "x string, y string")
    got = [r["_row_key"] for r in keys.fingerprint(df).collect()]
    assert len(set(got)) == 6 and got[0] == got[6]
    again = [r["_row_key"] for r in keys.fingerprint(df.repartition(3)).collect()]
    assert sorted(again) == sorted(got)


def test_nested_drift_counts_a_place_once_for_its_text(spark):
    """Also where a key with a dot names the same place as a nested one; outermost places are not shuffled by row."""
    layout = StructType.fromDDL("a struct<b string>, c string")
    df = spark.createDataFrame([('{"a.b":1,"a":{"b":1},"c":1}',), ('{"c":1}',)], "j string")
    drift = flatten.nested_drift(df, "j", layout)
    assert {(r["path"], r["rule"], r["found"]): r["n_rows"] for r in drift.collect()} == {
        ("$.a.b", "type", "NUMBER"): 1, ("$.c", "type", "NUMBER"): 2,
    }


def test_nested_drift_tells_a_kind_once(spark):
    """A value's schema is looked at where the value is met, once a level; outermost blanks, lists and plain values count as before."""
    layout = StructType.fromDDL("a struct<b:int, c:array<string>>, n int")
    rows = [' \t\n{"a":{"b":"x","c":[1,1]},"n":1.5}', "[1]", "7", '"t"', "null", "{", "", None]
    drift = flatten.nested_drift(spark.createDataFrame([(r,) for r in rows], "j string"), "j", layout)
    plan = drift._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schemaOfVariant") == 4 and "regexp_extract" not in plan and "element_at" not in plan
    assert {tuple(r) for r in drift.collect()} == {
        ("$", "type", "ARRAY", 1), ("$", "type", "NUMBER", 1), ("$", "type", "STRING", 1), ("$", "unreadable", None, 2),
        ("$.a.b", "type", "STRING", 1), ("$.a.c[*]", "type", "NUMBER", 1),
    }


def test_nested_drift_at_every_depth(spark):
    layout = StructType.fromDDL("a struct<b:int, c:array<struct<d:string>>>, m map<string,boolean>, s string")
    rows = [
        '{"a":{"b":1,"c":[{"d":"x"},{"d":1},{"d":2,"e":null}]},"m":{"k":true,"j":"no"},"s":null}', '{"a":[1],"z":{"y":1}}',
        '{"z":2,"z2":[]}', '{"a', None, '"text"', "", '{"a":{"b":"1"}}', '{"a":{"b":"1"}}', "{}", "null",
    ]
    found = flatten.nested_drift(spark.createDataFrame([(r, 1) for r in rows], "j string, path int"), "j", layout)
    assert {tuple(r) for r in found.collect()} == {
        ("$", "unreadable", None, 2), ("$", "type", "STRING", 1), ("$.a", "type", "ARRAY", 1), ("$.a.b", "type", "STRING", 2),
        ("$.a.c[*].d", "type", "NUMBER", 1), ("$.a.c[*].e", "unknown_key", "VOID", 1), ("$.m.*", "type", "STRING", 1),
        ("$.z", "unknown_key", "OBJECT", 1), ("$.z", "unknown_key", "NUMBER", 1), ("$.z2", "unknown_key", "ARRAY", 1),
    }
    assert flatten.nested_drift(spark.createDataFrame([], "j string"), "j", layout).count() == 0


def test_profile_shapes_and_keys(spark):
    df = spark.createDataFrame([("null", "1"), (" null", "x"), ("a", None), ("a", "y"), ("b", "null")], "p string, q string")
    assert dict(profiling.sentinel_profile(df).collect()) == {"p": 2, "q": 1}
    audit = {r[0]: (r[1], r[2]) for r in profiling.shape_audit(df, {"q": r"^\d+$", "p": "."}, samples=1).collect()}
    assert audit == {"q": (2, ["x"]), "p": (0, None)}
    unique = {r["key"]: r["is_unique"] for r in profiling.key_uniqueness(df, [["p"], ["p", "q"]]).collect()}
    assert unique == {"p": False, "p,q": True}
    col = {"p": text.blank_sentinel(F.col("p"))}
    right = profiling.null_reconciliation(df, col, {"p": text.is_sentinel(F.col("p"))}).first()
    assert (right["expected"], right["introduced"], right["agrees"]) == (2, 2, True)
    assert not profiling.null_reconciliation(df, col, {"p": F.col("p") == "null"}).first()["agrees"]


RULES = Contract(
    "r", "id string, name string, n int, is_on boolean", key=("id",), required=("name",), max_length={"name": 3},
    text_ids=("id",), typed_prefixes=("is_",),
)


def test_contract_rows(spark):
    data = [("1", "abc", 1, True), ("2", "abcd", 1, True), ("3", None, 1, True), ("4", "a", 1, None), ("4", "b", None, None),
            (None, "a", 1, True), ("1.5E+13", "a", 1, True)]
    df = spark.createDataFrame(data, RULES.columns)
    good, bad = integrity.split_by_contract(df, RULES)
    assert sorted(r["id"] for r in good.collect()) == ["1"]
    held = {(r["id"], r["name"]): r["violations"] for r in bad.collect()}
    assert held == {
        ("2", "abcd"): ["max_length:name"], ("3", None): ["not_null:name"], ("4", "a"): ["unique:id"],
        ("4", "b"): ["unique:id"], (None, "a"): ["not_null:id"], ("1.5E+13", "a"): ["scientific_id:id"],
    }
    counts = {(r[0], r[1]): r[2] for r in integrity.contract_counts(df, RULES).collect()}
    assert counts["unique", "id"] == 2 and counts["not_null", "id"] == 1 and counts["max_length", "name"] == 1


def test_contract_schema(spark):
    same = spark.createDataFrame([], RULES.columns)
    assert RULES.drift(same.schema) == []
    other = spark.createDataFrame([], "id bigint, is_on string, n int, extra int")
    assert {(r, c) for r, c, _ in RULES.drift(other.schema)} == {
        ("missing_column", "name"), ("unexpected_column", "extra"), ("type_mismatch", "id"), ("type_mismatch", "is_on"),
        ("column_order", "r"), ("id_not_text", "id"), ("flag_left_as_text", "is_on"),
    }


def test_prepared_sources_meet_their_contracts(spark):
    at = dt.datetime(2026, 7, 1, 6)
    products = spark.createDataFrame(
        [("101", " Mouse ", "E ", "25.00", "TRUE"), ("x", None, None, "abc", "maybe")],
        "product_id string, product_name string, category string, price string, is_active string",
    ).toDF(" Product ID", "product_name", "category", "price", "is_active")
    done = ingest.prepare_products(products, at)
    assert PRODUCTS_LOADED.drift(done.schema) == []
    assert [tuple(r)[:5] for r in done.collect()] == [
        (101, "Mouse", "E", Decimal("25.00"), True), (None, "Unknown Product", None, None, None),
    ]
    orders = spark.createDataFrame(
        [("1", "2", "2024-01-10 09:15:00", " Completed ", None), ("3", "99", "junk", None, "35.00")],
        "order_id string, customer_id string, order_date string, status string, order_total string",
    )
    done = ingest.prepare_orders(orders, at)
    assert ORDERS_LOADED.drift(done.schema) == []
    got = [tuple(r) for r in done.collect()]
    assert got[0][3:] == ("completed", Decimal("0.00"), at) and got[1][2:4] == (None, "unknown")


def test_redaction(spark):
    df = spark.sql("SELECT named_struct('a', 'secret', 'b', 'kept') AS s UNION ALL SELECT NULL")
    blank = cleaning.redact(df, {"s": ["a"]}).collect()
    assert blank[0]["s"]["a"] is None and blank[0]["s"]["b"] == "kept" and blank[1]["s"] is None
    hashed = cleaning.redact(df, {"s": ["a"]}, salt="x").first()["s"]["a"]
    assert len(hashed) == 64


def test_narrowing_overflows_to_null(spark):
    df = spark.sql("SELECT 1e300D AS x, named_struct('y', 2.345D, 'z', 'k') AS s")
    got = flatten.narrow_decimals(df, ["x"], {"s": ["y"]}).first()
    assert got["x"] is None and got["s"]["y"] == Decimal("2.35") and got["s"]["z"] == "k"
