from datetime import date

import pytest

from basketrank.config import REFERENCE
from basketrank.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture()
def calendar():
    return REFERENCE


@pytest.fixture()
def transactions(spark):
    def make(rows):
        return spark.createDataFrame(
            [(date.fromisoformat(day), c, a, p) for day, c, a, p in rows],
            "t_dat date, customer_id string, article_id string, price double",
        )

    return make


@pytest.fixture()
def customers(spark):
    def make(rows):
        full = [tuple(row) + (None,) * (4 - len(row)) for row in rows]
        return spark.createDataFrame(
            full, "customer_id string, age double, club_member_status string, fashion_news_frequency string"
        )

    return make


@pytest.fixture()
def articles(spark):
    def make(rows):
        return spark.createDataFrame(
            rows,
            "article_id string, prod_name string, product_type_no int, colour_group_code int, "
            "department_no int, perceived_colour_value_id int",
        )

    return make
