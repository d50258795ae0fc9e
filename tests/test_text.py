"""Hand-made edge rows for the text sources and scalar functions."""

from pyspark.sql import functions as F

from rateflow.functions.exprs import jvm_trim, tag_tokens, text_after_prefix, year_month
from rateflow.schemas import PRODUCT, RATING
from rateflow.sources import text


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line_id int, value string")


def test_short_product_line_is_quarantined(spark):
    lines = _lines(spark, ["1^a^b", "2^ name ^x^y^url^c1|c2^t1|t2", "3^n^x^y^u^c^", "z^n^x^y^u^c^t"])
    good, bad = text.split_good_bad(text.parse_product_lines(lines), PRODUCT.fieldNames(),
                                    keys=["line_id"])
    g = good.collect()
    assert [(r.productId, r.name, r.tags) for r in g] == [(2, "name", "t1|t2")]
    reasons = {r.line_id: r.reason for r in bad.collect()}
    # trailing empty field dropped like String.split -> short row
    assert reasons == {0: "short_row", 2: "short_row", 3: "bad_value"}


def test_rating_lines_extra_fields_ignored(spark):
    lines = _lines(spark, ["1,2,3.5,100,extra", "1,2,x,100", "1,2,3.0"])
    good, bad = text.split_good_bad(text.parse_rating_lines(lines), RATING.fieldNames(),
                                    keys=["line_id"])
    assert [tuple(r) for r in good.collect()] == [(0, 1, 2, 3.5, 100)]
    assert sorted(r.reason for r in bad.collect()) == ["bad_value", "short_row"]


def test_log_prefix_cases(spark):
    lines = _lines(spark, [
        "x PRODUCT_RATING_PREFIX:",                                   # blank after prefix
        "PRODUCT_RATING_PREFIX:1|2|3.0|4 PRODUCT_RATING_PREFIX:9",    # two prefixes
        "t INFO PRODUCT_RATING_PREFIX:5|6|1.0|7\t\t",                 # tab padding
        "t ERROR 5|6|1.0|7",                                          # no prefix
    ])
    out = {r.line_id: r.value for r in text.extract_rating_payloads(lines).collect()}
    assert out == {1: "1|2|3.0|4", 2: "5|6|1.0|7"}


def test_jvm_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\t\x01 a b \n\x00",)], "s string")
    assert df.select(jvm_trim("s").alias("t")).first().t == "a b"


def test_month_edge(spark):
    df = spark.createDataFrame([(1259625600,), (1259625599,)], "ts int")
    assert [r.m for r in df.select(year_month("ts").alias("m")).collect()] == [200912, 200911]


def test_tokenizer_rules(spark):
    df = spark.createDataFrame([("A|b  C ",), ("",), ("   ",), (" x",)], "tags string")
    got = [r.t for r in df.select(tag_tokens("tags").alias("t")).collect()]
    assert got == [["a", "b", "", "c"], [""], [], ["", "x"]]


def test_text_after_prefix_absent_is_null(spark):
    df = spark.createDataFrame([("no prefix here",)], "v string")
    assert df.select(text_after_prefix("v").alias("p")).first().p is None


def test_sql_surface_equals_dataframe(spark):
    from rateflow.functions.sql import register_sql_functions
    register_sql_functions(spark)
    rows = spark.createDataFrame([(1259625600,), (1259625599,), (5,), (None,)], "ts int")
    got = rows.selectExpr("ts", "changeDate(ts) AS m").collect()
    assert got == rows.select("ts", year_month("ts").alias("m")).collect()


def test_statistics_are_in_order(spark):
    from rateflow.operators import stats
    r = spark.createDataFrame([(1, 12, 4.0, 1259625600), (2, 10, 2.0, 1259625599), (1, 11, 4.0, 5), (3, 10, 2.0, 1259625600),
                               (4, 13, 4.0, 5)], "userId int, productId int, score double, timestamp int")
    many = stats.rate_more_products(r).collect()
    assert [(x.productId, x["count"]) for x in many] == [(11, 1), (12, 1), (13, 1), (10, 2)]
    most = stats.rate_more_products(r, descending=True).collect()
    assert [x.productId for x in most] == [10, 11, 12, 13]
    recent = stats.rate_more_recently_products(r).collect()
    assert [(x.yearmonth, x.productId) for x in recent] == [(200912, 10), (200912, 12), (200911, 10), (197001, 11), (197001, 13)]
    mean = stats.average_products(r).collect()
    assert [x.productId for x in mean] == [11, 12, 13, 10]
