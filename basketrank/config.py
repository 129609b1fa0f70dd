"""Calendar, feature list and ranker settings."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta


@dataclass(frozen=True)
class Calendar:
    """Split dates and trailing-window lengths (in days) of one run.

    Windows are strict: a window of n days before ``as_of`` keeps
    ``t_dat > as_of - n``.
    """

    test_start: date
    last_train: date
    val_start: date
    val_end: date
    season_start: date
    season_end: date
    week: int = 7
    fortnight: int = 14
    month: int = 30
    quarter: int = 90
    decay_base: float = 0.95

    @property
    def windows(self) -> dict[str, int]:
        """Feature-window suffix -> days."""
        return {"7d": self.week, "14d": self.fortnight, "30d": self.month}

    def feature_as_of(self, mode: str = "reference") -> date:
        """Day the feature windows look back from.

        ``reference`` looks back from the last training day although the
        feature history ends before the label week, so its shortest window
        is always empty; ``fixed`` looks back from the end of that history.
        """
        if mode == "reference":
            return self.last_train
        if mode == "fixed":
            return self.val_start - timedelta(days=1)
        raise ValueError(f"mode must be 'reference' or 'fixed', not {mode!r}")


# The competition calendar.
REFERENCE = Calendar(
    test_start=date(2020, 9, 16),
    last_train=date(2020, 9, 15),
    val_start=date(2020, 9, 9),
    val_end=date(2020, 9, 15),
    season_start=date(2019, 8, 1),
    season_end=date(2019, 10, 31),
)

# The same shape with every window 13 times as long, for the sparser test tables.
TESTDATA = Calendar(
    test_start=date(2001, 5, 3),
    last_train=date(2001, 5, 2),
    val_start=date(2001, 2, 1),
    val_end=date(2001, 5, 2),
    season_start=date(1999, 8, 1),
    season_end=date(1999, 10, 31),
    week=91,
    fortnight=182,
    month=390,
    quarter=1170,
    decay_base=0.996062,
)

# Candidate source names.
SOURCES = ["repurchase", "global_popular", "age_popular", "als", "embedding_sim", "item_item"]

# The features a ranker learns from, in order.
FEATURE_COLS = [
    "age", "is_club_member", "fashion_news_freq",
    "n_purchases_7d", "n_purchases_14d", "n_purchases_30d",
    "n_unique_articles_30d", "avg_price_30d", "days_since_last_purchase",
    "article_popularity_7d", "article_popularity_14d", "article_popularity_age_group_14d",
    "days_since_article_last_sold",
    "product_type_no", "colour_group_code", "department_no",
    "user_has_bought_before", "user_bought_same_product_type", "user_bought_same_department",
    "embedding_similarity",
    "user_item_decay_weight",
    "sales_trend",
    "candidate_source_repurchase", "candidate_source_global_popular",
    "candidate_source_age_popular", "candidate_source_als",
    "candidate_source_embedding_sim", "candidate_source_item_item",
    "user_item_purchase_count", "user_dept_affinity",
    "price_deviation", "article_age_days", "autumn_2019_sales",
]

# The shorter list, without the cross and advanced features.
FEATURE_COLS_SHORT = FEATURE_COLS[:28]

IMAGE_DIMS = 32


@dataclass(frozen=True)
class RankerParams:
    """Settings of the boosted ranker; ``max_depth`` stands in for a leaf limit."""

    rounds: int = 1000
    learning_rate: float = 0.02
    max_depth: int = 8
    min_rows_per_leaf: int = 30
    max_bins: int = 255
    ndcg_at: int = 12
    #: Gradients scaled per customer, from pairs with a row among the first ``truncation``; else plain ones of NDCG's own cut.
    normalise: bool = True
    truncation: int = 30
    early_stopping: int = 50
    log_every: int = 50
    watch: str = "holdout"
    holdout_share: float = 0.1
    stage_every: int = 10
    seed: int = 42


RANKER = RankerParams()
RANKER_FAST = replace(RANKER, rounds=500, learning_rate=0.05, max_depth=7, min_rows_per_leaf=20)
