import pytest
from pyspark.sql import functions as F

from affinary.functions import calendar
from affinary.functions.columns import conform, drop_incomplete, narrow_types, round_floats, string_part
from affinary.functions.predicates import apply_filters, parse
from affinary.functions.vectors import cosine_score, l2_normalize, pairwise_dots
from affinary.operators.assembly import add_account_features, encode, mapping_table
from affinary.operators.learning import fit_min_max


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a >= 1", ("a", ">=", 1)),
        ("a is None", ("a", "is", None)),
        ("a is not None", ("a", "is not", None)),
        ("a not in [1, 2]", ("a", "not in", [1, 2])),
        ("name == 'x y'", ("name", "==", "x y")),
        ("flag == True", ("flag", "==", True)),
    ],
)
def test_parse(text, expected):
    assert parse(text) == expected


@pytest.mark.parametrize("text", ["1 < a < 5", "a < 5 < 9", "a", "a + 1 == 2", "a == b", "a > 1 and b > 2", "a ~ 1"])
def test_parse_rejects_what_it_cannot_say(text):
    with pytest.raises(ValueError):
        parse(text)


@pytest.mark.parametrize(
    ("predicate", "kept"),
    [
        ("a == 1", [1]),
        ("a != 1", [2, 3]),
        ("a < 2", [1]),
        ("a > 1", [2, 3]),
        ("a in [1, 3]", [1, 3]),
        ("a in [1, None]", [1, None]),
        ("a not in [1]", [2, 3, None]),
        ("a not in [1, None]", [2, 3]),
        ("a is None", [None]),
        ("a is not None", [1, 2, 3]),
        ("a == None", []),
        (("a", "=", 2), [2]),
    ],
)
def test_filters_and_nulls(spark, rows, predicate, kept):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int")
    assert [row[0] for row in rows(apply_filters(df, [predicate]))] == kept


def test_unknown_operator(spark):
    with pytest.raises(ValueError):
        apply_filters(spark.range(1), [("id", "like", "x")])


def test_filter_by_table_does_not_multiply(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    table = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "a int, b string")
    assert rows(apply_filters(df, [("a", "in", table)])) == [(1,), (2,)]
    assert rows(apply_filters(df, [("a", "not in", table)])) == [(3,)]


def test_days_before_crosses_months_and_leap_days():
    assert calendar.days_before(20240301, 1) == 20240229
    assert calendar.days_before(20230301, 1) == 20230228
    assert calendar.days_before(20240101, 1) == 20231231


def test_window_filters():
    assert calendar.window_filters(20240130, 20) == ["filename_date < 20240130", "filename_date >= 20240110"]
    assert calendar.window_filters(20240130, None, inclusive=True) == ["filename_date <= 20240130"]
    assert calendar.window_filters(20240130, 1, as_triples=True)[1] == ("filename_date", ">=", 20240129)


def test_splits():
    full = calendar.full_training_split(20230430, 90)
    assert full.train == ("filename_date >= 20230129", "filename_date < 20230429")
    assert full.validation == ("filename_date == 20230429",)
    refit = calendar.refit_split(20230430)
    assert refit.train == refit.validation == ("filename_date >= 20230429", "filename_date <= 20230430")
    moved = calendar.split_for_inference(["filename_date > 1", "g <= 10"], ["g <= 10"], 20230430, 90)
    assert moved.train == (*full.train, "g <= 10")
    assert moved.validation == (*full.validation, "g <= 10")


def test_weekend_friday_to_monday(spark, rows):
    days = spark.createDataFrame([(20240105,), (20240106,), (20240107,), (20240108,)], "filename_date int")
    flags = days.select("filename_date", calendar.encoded_weekday("filename_date"), calendar.is_weekend())
    assert [row[1:] for row in rows(flags)] == [(5, 0), (6, 1), (0, 1), (1, 0)]
    assert [calendar.weekend_of(day) for day in (20240105, 20240106, 20240107, 20240108)] == [0, 1, 1, 0]


def test_iso_week_belongs_to_the_iso_year(spark, rows):
    days = spark.createDataFrame([(20230101,), (20230227,)], "filename_date int")
    assert rows(days.select(calendar.iso_week_key("filename_date"))) == [("2022-52",), ("2023-9",)]


def test_narrow_types_keeps_columns_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, 300, "x"), (None, 5, "7")], "a bigint, b bigint, c string")
    with pytest.warns(UserWarning):
        narrow = narrow_types(df, {"a": "int8", "b": "int8", "c": "int32"})
    assert dict(narrow.dtypes) == {"a": "tinyint", "b": "bigint", "c": "string"}


def test_conform_and_round(spark, rows):
    df = spark.createDataFrame([(1, 0.12345650, 2.5)], "a int, b double, c double")
    assert dict(conform(df, {"a": "int64"}).dtypes)["a"] == "bigint"
    assert rows(round_floats(df.select("c"), 0)) == [(2.0,)]


def test_drop_incomplete(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(drop_incomplete(df)) == [(2, "x")]


def test_string_part_without_delimiter_is_null(spark, rows):
    df = spark.createDataFrame([("a#b",), ("a",), ("a#7#c",)], "id string")
    assert rows(df.select("id", string_part("id", "#", 1))) == [("a", None), ("a#7#c", "7"), ("a#b", "b")]
    assert rows(df.select("id", string_part("id", "#", 1, numeric=True)))[1] == ("a#7#c", 7.0)


def test_account_features(spark, rows):
    profiles = spark.createDataFrame([("p1#a", 1), ("p2#a", 2), ("p3", 3), ("p4#zz", 4)], "id string, x int")
    accounts = spark.createDataFrame([("q#a", "gold"), ("q#b", "blue")], "id string, tier string")
    joined = add_account_features(profiles, accounts, "id")
    assert rows(joined, "id", "x", "tier") == [("p1#a", 1, "gold"), ("p2#a", 2, "gold")]
    twice = accounts.unionByName(accounts)
    with pytest.raises(ValueError):
        add_account_features(profiles, twice, "id")
    # an account that no profile uses may repeat
    unused = accounts.unionByName(accounts.filter("tier = 'blue'"))
    assert add_account_features(profiles, unused, "id").count() == 2


def test_encode_unknown_is_null_and_mapping_required(spark, rows):
    df = spark.createDataFrame([(1, "top"), (2, "odd"), (3, None)], "id int, band string")
    mapping = mapping_table(spark, {"band_mapping": {"top": 1}}, "band")
    encoded = encode(df, "band", mapping)
    assert encoded.columns == ["id", "band"] and dict(encoded.dtypes)["band"] == "int"
    assert rows(encoded) == [(1, 1), (2, None), (3, None)]
    with pytest.raises(ValueError):
        mapping_table(spark, {}, "band")


def test_min_max_of_a_constant_is_one_half(spark, rows):
    df = spark.createDataFrame([(1.0, 3), (3.0, 3), (None, 3)], "a double, b int")
    scaled = fit_min_max(df, ["a", "b"]).transform(df, {"a": "a_scaled"})
    assert scaled.columns == ["a_scaled", "b"]
    assert rows(scaled) == [(0.0, 0.5), (1.0, 0.5), (None, 0.5)]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    row = df.select(
        l2_normalize(F.col("a")).alias("unit"),
        cosine_score(F.col("a"), F.col("b")).alias("score"),
        l2_normalize(F.col("z")).alias("zero"),
        pairwise_dots([F.col("a"), F.col("b"), F.col("a")]).alias("dots"),
    ).first()
    assert row.unit == pytest.approx([0.6, 0.8])
    assert row.score == pytest.approx((24 / 25 + 1) / 2)
    assert row.zero == [0.0, 0.0]
    assert row.dots == pytest.approx([24.0, 25.0, 24.0])
