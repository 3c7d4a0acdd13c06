"""The bad-row fixture: one row per way a list or object can be faulty."""

import pytest
from pyspark.sql import functions as F

from sievework.functions import nested
from sievework.operators import exceptions as ex

OK = '{"isAdditionalLabel":false}'
CUT = '{"isAdditionalLabel":false'
LISTS, OBJECT = ex.ListSpec("articleNo string, price double"), ex.ObjectSpec("isAdditionalLabel boolean")

# id: (articles, article_number, custom_fields, match count, type as found, type after repair)
CASES = {
    "cut list": ('[{"articleNo":"K77","price":3.5', "K77", OK, 0, "articles_parse_failed", None),
    "other number": ('[{"articleNo":"K77","price":3.5},{"articleNo":"K78","price":4}]', "M01", OK, 0, "articles_no_match", "articles_no_match"),
    "cut object": ('[{"articleNo":"K77","price":3.5}]', "K77", CUT, 1, "custom_fields_parse_failed", "custom_fields_parse_failed"),
    "loose number": ('[{"articleNo":"K78 ","price":4},{"articleNo":" k77","price":3.5}]', "K77", OK, 0, "articles_no_match", None),
    "longer number": ('[{"articleNo":"K771","price":3.5}]', "K77", OK, 0, "articles_no_match", "articles_no_match"),
    "dup": ('[{"articleNo":"X1","price":1},{"articleNo":"X1","price":2}]', "X1", OK, 2,
            "articles_duplicate_match", "articles_duplicate_match"),
    "null": (None, "X1", OK, 0, "articles_no_match", "articles_no_match"),
    "empty": ("", "X1", OK, 0, "articles_parse_failed", "articles_parse_failed"),
    "emptyarr": ("[]", "X1", OK, 0, "articles_no_match", "articles_no_match"),
    "nullkey": ('[{"articleNo":"X1"}]', None, OK, 0, "articles_no_match", "articles_no_match"),
    "esc": (r'[{"articleNo":"X\,1"}]', "X,1", OK, 1, None, None),
    "dupfuzzy": ('[{"articleNo":"x1"},{"articleNo":" X1"}]', "X1", OK, 0, "articles_no_match", "articles_no_match"),
    "cut2": ('[{"articleNo":"X1"},{"articleNo":"X2","price":3', "X1", OK, 0, "articles_parse_failed", None),
    "midstr": ('[{"articleNo":"X1","na', "X1", OK, 0, "articles_parse_failed", "articles_parse_failed"),
    "oneobj": ('{"articleNo":"X1"}', "X1", OK, 1, None, None),
    "nullel": ('[null,{"articleNo":"X1"}]', "X1", OK, 1, None, None),
    "both": ('[{"articleNo":"X1","price":10.0', "X1", CUT, 0, "articles_parse_failed", "custom_fields_parse_failed"),
}
FINAL = ["id", "articles_match_count", "articles_parse_failed", "custom_fields_parse_failed", "exception_type",
         "has_exception", "repair_attempted", "repaired"]


@pytest.fixture(scope="module")
def bad(spark):
    data = [(i, a, n, c) for i, (a, n, c, *_) in CASES.items()]
    return spark.createDataFrame(data, "id string, articles string, article_number string, custom_fields string").cache()


def marked(df):
    return df.transform(ex.match_list, LISTS).transform(ex.parse_object_column, OBJECT).transform(
        ex.mark_exceptions, LISTS, OBJECT
    )


def test_classes(bad):
    got = {r["id"]: (r["articles_match_count"], r["exception_type"], r["has_exception"]) for r in marked(bad).collect()}
    assert got == {i: (c[3], c[4], c[4] is not None) for i, c in CASES.items()}


def test_repair(bad):
    done = {r["id"]: r for r in ex.repair(marked(bad), LISTS, OBJECT).collect()}
    for i, (_, _, _, count, found, left) in CASES.items():
        r = done[i]
        assert (r["exception_type"], r["has_exception"]) == (left, left is not None), i
        assert r["repair_attempted"] == (found is not None), i
        assert r["repaired"] == (found is not None and left is None), i
        assert r["articles_match_count"] == count, i
    assert done["cut list"]["_element"]["price"] == 3.5
    assert done["loose number"]["_element"]["articleNo"] == " k77"
    assert done["other number"]["_element"] is None


def test_first_fault_alone(bad):
    done = {r["id"]: r for r in ex.repair(marked(bad), LISTS, OBJECT, reclassify=False).collect()}
    assert done["both"]["repaired"] and not done["both"]["has_exception"] and done["both"]["custom_fields_parse_failed"]


@pytest.mark.parametrize("reclassify", [True, False])
def test_resolve_is_the_steps_in_one(bad, reclassify):
    steps = ex.repair(marked(bad), LISTS, OBJECT, reclassify).select(*FINAL, ex.ELEMENT, ex.OBJECT)
    fused = ex.resolve(bad, LISTS, OBJECT, reclassify).select(*FINAL, ex.ELEMENT, ex.OBJECT)
    assert sorted(map(str, steps.collect())) == sorted(map(str, fused.collect()))


def test_same_as_explode_and_join(bad):
    """The projection counts what exploding, filtering, grouping and joining back would."""
    exploded = bad.select("id", "article_number", F.explode_outer(nested.parse_list(F.col("articles"), LISTS.ddl)).alias("x"))
    counted = exploded.filter(F.col("x.articleNo") == F.col("article_number")).groupBy("id").count()
    joined = bad.join(counted, "id", "left").select("id", F.coalesce("count", F.lit(0)))
    ours = ex.match_list(bad, LISTS).select("id", "articles_match_count")
    assert dict(joined.collect()) == dict(ours.collect())


def test_every_row_is_routed_once(bad):
    done = ex.resolve(bad, LISTS, OBJECT)
    good, held = ex.route(done, ["id", "exception_type"])
    assert held.columns == ["id", "exception_type"]
    a, b = {r["id"] for r in good.collect()}, {r["id"] for r in held.collect()}
    assert a | b == set(CASES) and not a & b
    assert {"cut list", "loose number"} <= a and {"other number", "cut object", "longer number"} <= b
    together = good.select("id").unionByName(held.select("id"))
    assert together.exceptAll(bad.select("id")).isEmpty() and bad.select("id").exceptAll(together).isEmpty()


def test_summary_reconciles(bad):
    figures = dict(ex.run_summary(ex.resolve(bad, LISTS, OBJECT)).collect())
    assert list(figures.values()) == [17, 6, 14, 3, 11]
    assert all(ex.reconciled(figures).values())
    assert not all(ex.reconciled({**figures, "Rows still unresolved": 5}).values())


def test_repair_is_idempotent(bad):
    """Repairing a repaired frame again finds the same."""
    once = ex.resolve(bad, LISTS, OBJECT).select("id", "articles", "article_number", "custom_fields", "exception_type")
    again = ex.resolve(once.drop("exception_type"), LISTS, OBJECT)
    assert dict(once.select("id", "exception_type").collect()) == dict(again.select("id", "exception_type").collect())


@pytest.mark.parametrize(
    ("text", "k", "failed"),
    [
        ('{"k":1}', 1, False), ('{"k":1', None, True), ("", None, False), (None, None, False), ("[1]", None, True),
        ('{"k":"x","s":"a"}', None, True), ('{"k":1,"other":2}', 1, False), (r'{"k":1,"s":"a\,b"}', 1, False),
    ],
)
def test_object_edges(spark, text, k, failed):
    df = spark.createDataFrame([(text,)], "t string").select(nested.parse_object(F.col("t"), "k int, s string").alias("o"))
    row = df.select(F.col("o.k"), nested.object_unreadable(F.col("o"))).first()
    assert tuple(row) == (k, failed)


def test_number_for_a_text_field_and_object_kept_as_text(spark):
    df = spark.createDataFrame([('{"a":5,"b":{"from":1}}',)], "t string")
    o = nested.parse_object(F.col("t"), "a string, b string")
    assert tuple(df.select(o["a"], o["b"]).first()) == ("5", '{"from":1}')


def test_line_breaks_and_quotes_are_left_alone(spark):
    text = r'{"s":"a\nb \"c\" d\, e"}'
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(nested.parse_object(F.col("t"), "s string")["s"]).first()[0] == 'a\nb "c" d, e'
