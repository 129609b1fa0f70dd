from dataclasses import replace

import pytest

from basketrank.operators import stats


def by_key(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


def test_seven_day_window_is_empty_in_reference_mode_and_filled_when_fixed(transactions, calendar):
    clean = transactions([("2020-09-08", "a", "1", 2.0), ("2020-09-07", "a", "1", 4.0), ("2020-09-02", "a", "2", 6.0)])
    for mode, expected in [("reference", (None, None, 3)), ("fixed", (3, 2, 3))]:
        as_of = calendar.feature_as_of(mode)
        row = by_key(stats.customer_activity(stats.pair_activity(clean, calendar, as_of), calendar, as_of), "customer_id")["a"]
        assert (row["n_purchases_7d"], row["n_unique_articles_7d"], row["n_purchases_14d"]) == expected
        trend = by_key(stats.article_activity(stats.pair_activity(clean, calendar, as_of), calendar, as_of), "article_id")
        assert trend["1"]["sales_trend"] == pytest.approx(0.0 if mode == "reference" else 2 / 3)


def test_mean_of_unknown_prices_stays_null(transactions, calendar):
    pairs = stats.pair_activity(transactions([("2020-09-05", "a", "1", None), ("2020-09-05", "b", "1", 3.0)]), calendar, calendar.last_train)
    rows = by_key(stats.customer_activity(pairs, calendar, calendar.last_train), "customer_id")
    assert rows["a"]["avg_price_14d"] is None and rows["a"]["n_purchases_14d"] == 1
    assert rows["b"]["avg_price_14d"] == 3.0


def test_profile_fills_age_with_the_median_before_grouping(customers):
    profile = by_key(stats.customer_profile(customers([
        ("a", 28.0, "ACTIVE", "Regularly"), ("b", 32.0, "LEFT CLUB", "Monthly"), ("c", None, None, None), ("d", None, None, "NONE"),
    ])), "customer_id")
    assert profile["c"]["age"] == 30.0 and profile["c"]["age_group"] == "25-35"
    assert [profile[k]["is_club_member"] for k in "abc"] == [1, 0, None]
    assert [profile[k]["fashion_news_freq"] for k in "abcd"] == [1, 1, 0, 0]


def test_decay_sums_over_all_purchases(transactions, calendar):
    pairs = stats.pair_activity(transactions([("2020-09-05", "a", "1", 1.0), ("2020-09-05", "a", "1", 1.0), ("2020-09-14", "a", "1", 1.0)]), calendar, calendar.last_train)
    row = stats.pair_features(pairs).first()
    assert row.user_item_decay_weight == pytest.approx(2 * 0.95 ** 10 + 0.95)
    assert row.user_item_purchase_count == 3 and row.user_has_bought_before == 1


def test_unknown_buyers_are_an_age_group_of_their_own(transactions, customers, calendar):
    pairs = stats.pair_activity(transactions([("2020-09-05", "a", "1", 1.0), ("2020-09-05", "x", "1", 1.0), ("2020-09-06", "x", "1", 1.0)]), calendar, calendar.last_train)
    rows = stats.age_article_popularity(pairs, stats.customer_profile(customers([("a", 40.0)]))).collect()
    assert {(r[0], r[1], r[2]) for r in rows} == {("35-50", "1", 1), (None, "1", 2)}


def test_department_shares(transactions, articles, calendar):
    table = articles([("1", "n", 10, 0, 7, 0), ("2", "n", 11, 0, 8, 0)])
    pairs = stats.pair_activity(transactions([("2020-09-05", "a", "1", 1.0), ("2020-09-04", "a", "1", 1.0), ("2020-09-05", "a", "2", 1.0), ("2020-09-05", "a", "gone", 1.0)]), calendar, calendar.last_train)
    shares = {r.department_no: r.user_dept_affinity for r in stats.department_affinity(pairs, table).collect()}
    assert shares == {7: 0.5, 8: 0.25, None: 0.25}
    assert {r[1] for r in stats.user_product_types(pairs, table).collect()} == {10, 11, None}


def test_season_bounds_are_closed(transactions, calendar):
    pairs = stats.pair_activity(transactions([(d, "a", "1", 1.0) for d in ("2019-07-31", "2019-08-01", "2019-10-31", "2019-11-01")]), calendar, calendar.last_train)
    assert stats.article_activity(pairs, calendar, calendar.last_train).first().autumn_2019_sales == 2


def test_decay_base_is_a_setting(transactions, calendar):
    slow = replace(calendar, decay_base=0.5)
    pairs = stats.pair_activity(transactions([("2020-09-13", "a", "1", 1.0)]), slow, slow.last_train)
    assert stats.pair_features(pairs).first().user_item_decay_weight == 0.25
