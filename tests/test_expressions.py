from datetime import date

import pytest

from basketrank.functions import after, age_group, image_path, pad_id


def test_age_groups_have_open_upper_ends_and_take_null_as_oldest(spark):
    ages = [24, 25, 34, 35, 49, 50, None]
    rows = spark.createDataFrame([(a,) for a in ages], "age int").select(age_group("age")).collect()
    assert [r[0] for r in rows] == ["<25", "25-35", "25-35", "35-50", "35-50", "50+", "50+"]


def test_window_excludes_its_first_day(spark):
    days = spark.createDataFrame([(date(2020, 9, 1),), (date(2020, 9, 2),)], "d date")
    kept = days.where(after("d", date(2020, 9, 15), 14)).collect()
    assert [r.d for r in kept] == [date(2020, 9, 2)]


@pytest.mark.parametrize("raw, padded", [("0108775015", "0108775015"), ("108775015", "0108775015"), ("12345678901", "12345678901")])
def test_padding_never_cuts(spark, raw, padded):
    row = spark.createDataFrame([(raw,)], "a string").select(pad_id("a"), image_path("a")).first()
    assert row[0] == padded and row[1] == f"images/{padded}.jpg"
