"""The queries of ``queries.py`` written out in SQL, for comparison in another engine."""

from __future__ import annotations

from ..config import SOURCES

ORACLE: dict[str, str] = {}

# Calendar of the test tables, as in config.TESTDATA.
LAST, TEST, VAL_START, VAL_END = "DATE '2001-05-02'", "DATE '2001-05-03'", "DATE '2001-02-01'", "DATE '2001-05-02'"
FIXED = "DATE '2001-01-31'"
WEEK, FORTNIGHT, MONTH, QUARTER = 91, 182, 390, 1170
DECAY = "CAST(0.996062 AS DOUBLE)"

TABLES = f"""
WITH transactions AS (
  SELECT CAST(o_orderdate AS DATE) AS t_dat, o_custkey AS customer_id, l_partkey AS article_id,
         l_extendedprice AS price
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
), customers AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(16 + c_acctbal / 10000 * 64) AS INT) END AS age,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'ACTIVE' WHEN 'AUTOMOBILE' THEN 'PRE-CREATE'
                      WHEN 'MACHINERY' THEN 'LEFT CLUB' END AS club_member_status,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'Regularly' WHEN 'HOUSEHOLD' THEN 'Monthly'
                      WHEN 'BUILDING' THEN 'NONE' END AS fashion_news_frequency
  FROM customer
), articles AS (
  SELECT p_partkey AS article_id, p_name AS prod_name, p_size AS product_type_no,
    CAST(substr(p_brand, 7) AS INT) AS department_no,
    CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS colour_group_code,
    p_size % 8 AS perceived_colour_value_id
  FROM part
), train_tx AS (SELECT * FROM transactions WHERE t_dat < {TEST}
), clean AS (SELECT * FROM transactions WHERE t_dat < {VAL_START}
), label_tx AS (SELECT * FROM transactions WHERE t_dat BETWEEN {VAL_START} AND {VAL_END}
), test_tx AS (SELECT * FROM transactions WHERE t_dat >= {TEST})"""


def age_group(age: str) -> str:
    return f"CASE WHEN {age} < 25 THEN '<25' WHEN {age} < 35 THEN '25-35' WHEN {age} < 50 THEN '35-50' ELSE '50+' END"


def r(expression: str, digits: int = 6) -> str:
    """Rounded as ``tidy`` in queries.py does it."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"floor(CAST({expression} AS DOUBLE) * {scale} + CAST(0.501 AS DOUBLE)) / {scale}"


CANDIDATES = f""",
repurchase AS (
  SELECT DISTINCT customer_id, article_id, 'repurchase' AS source FROM train_tx WHERE t_dat > {LAST} - {FORTNIGHT}
), age_counts AS (
  SELECT {age_group('age')} AS age_group, article_id, count(*) AS n
  FROM train_tx JOIN customers USING (customer_id) WHERE t_dat > {LAST} - {FORTNIGHT} GROUP BY ALL
), age_best AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY age_group ORDER BY n DESC, article_id) AS INT) AS rank
    FROM age_counts) WHERE rank <= 100
), warm AS (
  SELECT customer_id, {age_group('age')} AS age_group FROM customers
  WHERE customer_id IN (SELECT customer_id FROM train_tx WHERE t_dat > {LAST} - {QUARTER})
    AND customer_id NOT IN (SELECT customer_id FROM train_tx WHERE t_dat > {LAST} - {FORTNIGHT})
), age_popular AS (
  SELECT customer_id, article_id, 'age_popular' AS source FROM warm JOIN age_best USING (age_group)
), interactions AS (
  SELECT customer_id, article_id, count(*) AS n FROM train_tx WHERE t_dat > {LAST} - {QUARTER} GROUP BY ALL
), merged AS (
  SELECT * FROM repurchase UNION SELECT * FROM age_popular
), pairs AS (SELECT DISTINCT customer_id, article_id FROM merged
), overlapping AS (
  SELECT * FROM merged UNION SELECT customer_id, article_id, 'als' FROM interactions WHERE n > 1
), sold_week AS (
  SELECT article_id, count(*) AS n FROM train_tx WHERE t_dat > {LAST} - {WEEK} GROUP BY ALL
), global12 AS (
  SELECT article_id, n, CAST(row_number() OVER (ORDER BY n DESC, article_id) AS INT) AS rank
  FROM sold_week QUALIFY rank <= 12
)"""

SCORED = f""",
decay AS (
  SELECT customer_id, article_id, sum(pow({DECAY}, CAST({LAST} - t_dat AS DOUBLE))) AS w FROM clean GROUP BY ALL
), scored AS (
  SELECT customer_id, article_id, round(coalesce(w, CAST(0 AS DOUBLE)), 6) AS score
  FROM pairs LEFT JOIN decay USING (customer_id, article_id)
), labelled AS (
  SELECT s.*, CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS label
  FROM scored s LEFT JOIN (SELECT DISTINCT customer_id, article_id FROM label_tx) b USING (customer_id, article_id)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) AS INT) AS rank
  FROM labelled
), predicted AS (
  SELECT customer_id, article_id, rank FROM ranked WHERE rank <= 12
  UNION ALL
  SELECT customer_id, article_id, rank FROM customers CROSS JOIN global12
  WHERE customer_id NOT IN (SELECT customer_id FROM scored)
), truth AS (SELECT DISTINCT customer_id, article_id, 1 AS hit FROM test_tx
), actual AS (SELECT customer_id, count(*) AS n_actual FROM truth GROUP BY ALL
)"""


def ap(predicted: str, *keys: str) -> str:
    """AP@12 of every ranking in ``predicted`` (keys, article_id, rank)."""
    key = ", ".join(["customer_id", *keys])
    return f"""
  SELECT {key}, sum(CASE WHEN hit = 1 THEN hits / rank ELSE CAST(0 AS DOUBLE) END) / min(least(n_actual, 12)) AS ap
  FROM (SELECT *, sum(hit) OVER (PARTITION BY {key} ORDER BY rank ROWS UNBOUNDED PRECEDING) AS hits
        FROM {predicted} LEFT JOIN truth USING (customer_id, article_id)) JOIN actual USING (customer_id)
  GROUP BY {key}"""


def add(name: str, body: str, *parts: str) -> None:
    ORACLE[name] = TABLES + "".join(parts) + "\n" + body.strip()


# --- sources, splits, predicates --------------------------------------------

TX_OUT = f"SELECT CAST(t_dat AS VARCHAR) AS t_dat, customer_id, article_id, {r('price', 4)} AS price FROM"
add("q_load_tx", f"{TX_OUT} transactions")
add("q_table_sizes", """
SELECT 'transactions' AS table_name, count(*) AS n_rows, 4 AS n_columns FROM transactions
UNION ALL SELECT 'train_tx_clean', count(*), 4 FROM clean
UNION ALL SELECT 'articles', count(*), 6 FROM articles
UNION ALL SELECT 'customers', count(*), 4 FROM customers""")
add("q_split_counts", """
SELECT (SELECT count(*) FROM transactions) AS n_all, (SELECT count(*) FROM train_tx) AS n_train,
       (SELECT count(*) FROM clean) AS n_clean, (SELECT count(*) FROM test_tx) AS n_test""")
add("q_window_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE t_dat > {LAST} - {days}) AS n_{suffix}"
    for suffix, days in [("7d", WEEK), ("14d", FORTNIGHT), ("30d", MONTH), ("90d", QUARTER)]
) + " FROM train_tx")
add("q_label_week", f"{TX_OUT} label_tx")
add("q_sample_customers", f"""{TX_OUT} transactions
WHERE customer_id IN (SELECT customer_id FROM customers WHERE fashion_news_frequency = 'Regularly')""")
add("q_age_group", f"""
SELECT customer_id, {age_group('age')} AS candidate_stage,
       {age_group('coalesce(age, (SELECT median(age) FROM customers))')} AS feature_stage FROM customers""")

# --- candidates -------------------------------------------------------------

add("q_cand_repurchase", "SELECT * FROM repurchase", CANDIDATES)
add("q_warm_customers", "SELECT customer_id FROM warm", CANDIDATES)
add("q_popular_by_age", "SELECT age_group, article_id, n, rank FROM age_best", CANDIDATES)
add("q_cand_age_popular", "SELECT * FROM age_popular", CANDIDATES)
add("q_cand_global_popular", f"""
SELECT customer_id, article_id, 'global_popular' AS source
FROM customers CROSS JOIN (SELECT article_id FROM sold_week ORDER BY n DESC, article_id LIMIT 100)
WHERE customer_id NOT IN (SELECT customer_id FROM train_tx WHERE t_dat > {LAST} - {QUARTER})""", CANDIDATES)
add("q_id_index", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS id_column, count(DISTINCT {c}) AS n, count(DISTINCT {c}) AS n_index, 0 AS first_index,
       CAST(count(DISTINCT {c}) - 1 AS INT) AS last_index FROM interactions""" for c in ("customer_id", "article_id")),
    CANDIDATES)
add("q_interactions", "SELECT * FROM interactions", CANDIDATES)
add("q_bm25", f"""
, lengths AS (SELECT customer_id, sum(n) AS row_sum FROM interactions GROUP BY ALL),
buyers AS (SELECT article_id, count(*) AS df FROM interactions GROUP BY ALL),
totals AS (SELECT count(*) AS users, avg(row_sum) AS mean_sum FROM lengths)
SELECT customer_id, article_id, n, {r('''
  n * CAST(101 AS DOUBLE)
  / (CAST(100 AS DOUBLE) * (CAST(0.2 AS DOUBLE) + CAST(0.8 AS DOUBLE) * row_sum / mean_sum) + n)
  * (ln(users) - ln(CAST(1 AS DOUBLE) + df))''')} AS weight
FROM interactions JOIN lengths USING (customer_id) JOIN buyers USING (article_id) CROSS JOIN totals""", CANDIDATES)
add("q_cand_merged", "SELECT * FROM merged", CANDIDATES)
add("q_source_pivot", "SELECT customer_id, article_id, " + ", ".join(
    f"CAST(max(CASE WHEN source = '{s}' THEN 1 ELSE 0 END) AS INT) AS candidate_source_{s}" for s in SOURCES
) + " FROM overlapping GROUP BY ALL", CANDIDATES)

# --- statistics -------------------------------------------------------------


def windowed(as_of: str) -> str:
    out = []
    for suffix, days in [("7d", WEEK), ("14d", FORTNIGHT), ("30d", MONTH)]:
        inside = f"FILTER (WHERE t_dat > {as_of} - {days})"
        out.append(f"nullif(count(*) {inside}, 0) AS n_purchases_{suffix}")
        out.append(f"nullif(count(DISTINCT article_id) {inside}, 0) AS n_unique_articles_{suffix}")
        out.append(f"avg(price) {inside} AS avg_price_{suffix}")
    return ", ".join(out)


def statistics(as_of: str) -> str:
    return f""",
customer_stats AS (
  SELECT customer_id, {windowed(as_of)}, CAST({as_of} - max(t_dat) AS INT) AS days_since_last_purchase,
         avg(price) AS cust_avg_price FROM clean GROUP BY ALL
), profile AS (
  SELECT customer_id, coalesce(CAST(age AS DOUBLE), (SELECT median(age) FROM customers)) AS age,
         CAST(club_member_status = 'ACTIVE' AS INT) AS is_club_member,
         CASE WHEN fashion_news_frequency IN ('Regularly', 'Monthly') THEN 1 ELSE 0 END AS fashion_news_freq,
         {age_group('coalesce(age, (SELECT median(age) FROM customers))')} AS age_group
  FROM customers
), article_stats AS (
  SELECT article_id,
    nullif(count(*) FILTER (WHERE t_dat > {as_of} - {WEEK}), 0) AS article_popularity_7d,
    nullif(count(*) FILTER (WHERE t_dat > {as_of} - {FORTNIGHT}), 0) AS article_popularity_14d,
    CAST({as_of} - max(t_dat) AS INT) AS days_since_article_last_sold,
    CAST({as_of} - min(t_dat) AS INT) AS article_age_days,
    avg(price) AS art_avg_price,
    count(*) FILTER (WHERE t_dat > {as_of} - {WEEK}) / (count(*) + 1) AS sales_trend,
    nullif(count(*) FILTER (WHERE t_dat BETWEEN DATE '1999-08-01' AND DATE '1999-10-31'), 0) AS autumn_2019_sales
  FROM clean GROUP BY ALL
), age_article AS (
  SELECT age_group, article_id, count(*) AS article_popularity_age_group_14d
  FROM clean LEFT JOIN profile USING (customer_id) WHERE t_dat > {as_of} - {FORTNIGHT} GROUP BY ALL
), pair_stats AS (
  SELECT customer_id, article_id, sum(pow({DECAY}, CAST({as_of} - t_dat AS DOUBLE))) AS user_item_decay_weight,
         count(*) AS user_item_purchase_count, 1 AS user_has_bought_before FROM clean GROUP BY ALL
), prod_types AS (
  SELECT DISTINCT customer_id, product_type_no FROM clean LEFT JOIN articles USING (article_id)
), departments AS (
  SELECT customer_id, department_no, count(*) AS bought FROM clean LEFT JOIN articles USING (article_id) GROUP BY ALL
), affinity AS (
  SELECT customer_id, department_no, bought / total AS user_dept_affinity
  FROM departments JOIN (SELECT customer_id, count(*) AS total FROM clean GROUP BY ALL) USING (customer_id)
)"""


STATS, STATS_FIXED = statistics(LAST), statistics(FIXED)
WINDOW_COLS = ", ".join(
    f"n_purchases_{s}, n_unique_articles_{s}, {r(f'avg_price_{s}', 4)} AS avg_price_{s}" for s in ("7d", "14d", "30d")
)
add("q_customer_stats", f"SELECT customer_id, {WINDOW_COLS} FROM customer_stats", STATS)
add("q_customer_stats_fixed", f"SELECT customer_id, {WINDOW_COLS} FROM customer_stats", STATS_FIXED)
add("q_customer_recency", "SELECT customer_id, days_since_last_purchase FROM customer_stats", STATS)
add("q_age_median", f"SELECT {r('median(age)')} AS age_median FROM customers")
add("q_customer_profile", f"SELECT customer_id, {r('age')} AS age, is_club_member, fashion_news_freq, age_group FROM profile", STATS)
for name, part in [("q_article_popularity", STATS), ("q_article_popularity_fixed", STATS_FIXED)]:
    add(name, "SELECT article_id, article_popularity_7d, article_popularity_14d FROM article_stats", part)
add("q_age_article_popularity", "SELECT * FROM age_article", STATS)
add("q_article_recency", "SELECT article_id, days_since_article_last_sold FROM article_stats", STATS)
add("q_article_age", "SELECT article_id, article_age_days FROM article_stats", STATS)
for name, part in [("q_sales_trend", STATS), ("q_sales_trend_fixed", STATS_FIXED)]:
    add(name, f"SELECT article_id, {r('sales_trend')} AS sales_trend FROM article_stats", part)
add("q_season_sales", "SELECT article_id, autumn_2019_sales FROM article_stats WHERE autumn_2019_sales IS NOT NULL", STATS)
add("q_avg_prices", f"""
SELECT 'customer' AS side, customer_id AS id, {r('cust_avg_price', 4)} AS avg_price FROM customer_stats
UNION ALL SELECT 'article', article_id, {r('art_avg_price', 4)} FROM article_stats""", STATS)
add("q_user_item_decay", f"SELECT customer_id, article_id, {r('user_item_decay_weight')} AS user_item_decay_weight FROM pair_stats", STATS)
add("q_user_bought", "SELECT customer_id, article_id, user_has_bought_before FROM pair_stats", STATS)
add("q_user_item_count", "SELECT customer_id, article_id, user_item_purchase_count FROM pair_stats", STATS)
add("q_user_prod_types", "SELECT * FROM prod_types", STATS)
add("q_user_departments", "SELECT customer_id, department_no FROM departments", STATS)
add("q_dept_affinity", f"SELECT customer_id, department_no, {r('user_dept_affinity')} AS user_dept_affinity FROM affinity", STATS)

# --- features, labels, samples ----------------------------------------------

FLAGS = {
    "is_club_member": "is_club_member", "fashion_news_freq": "fashion_news_freq",
    "user_has_bought_before": "user_has_bought_before",
    "user_bought_same_product_type": "t.customer_id IS NOT NULL",
    "user_bought_same_department": "a.customer_id IS NOT NULL",
    **{f"candidate_source_{s}": f"candidate_source_{s}" for s in SOURCES},
}
COUNTS = [
    "n_purchases_7d", "n_purchases_14d", "n_purchases_30d", "n_unique_articles_30d", "article_popularity_7d",
    "article_popularity_14d", "article_popularity_age_group_14d", "user_item_decay_weight", "sales_trend",
    "user_dept_affinity", "user_item_purchase_count", "autumn_2019_sales",
]
RECENCY = {
    "days_since_last_purchase": "days_since_last_purchase",
    "days_since_article_last_sold": "days_since_article_last_sold",
    "article_age_days": "article_age_days",
    "price_deviation": "abs(art_avg_price - cust_avg_price)",
}
MEANS = ["avg_price_7d", "avg_price_14d", "avg_price_30d"]
FEATURES = """,
flagged AS (SELECT customer_id, article_id, """ + ", ".join(
    f"max(CASE WHEN source = '{s}' THEN 1 ELSE 0 END) AS candidate_source_{s}" for s in SOURCES
) + """ FROM merged GROUP BY ALL),
features AS (
  SELECT p.customer_id, p.article_id, coalesce(b.label, 0) AS label, age_group, department_no, product_type_no,
    colour_group_code, perceived_colour_value_id, n_unique_articles_7d, n_unique_articles_14d, """ + ", ".join(
    [f"{r('age')} AS age"]
    + [f"coalesce(CAST({e} AS INT), 0) AS {c}" for c, e in FLAGS.items()]
    + [f"{r(f'coalesce({c}, 0)')} AS {c}" for c in COUNTS]
    + [f"{r(f'coalesce({e}, 9999)', 4 if 'price' in c else 6)} AS {c}" for c, e in RECENCY.items()]
    + [f"{r(f'coalesce({c}, avg({c}) OVER ())', 4)} AS {c}" for c in MEANS]
) + """
  FROM flagged p
  LEFT JOIN (SELECT DISTINCT customer_id, article_id, 1 AS label FROM label_tx) b USING (customer_id, article_id)
  LEFT JOIN profile USING (customer_id)
  LEFT JOIN customer_stats USING (customer_id)
  LEFT JOIN article_stats USING (article_id)
  LEFT JOIN age_article USING (age_group, article_id)
  LEFT JOIN articles USING (article_id)
  LEFT JOIN pair_stats USING (customer_id, article_id)
  LEFT JOIN prod_types t USING (customer_id, product_type_no)
  LEFT JOIN affinity a USING (customer_id, department_no)
)"""
add("q_features", "SELECT * EXCLUDE (label) FROM features", CANDIDATES, STATS, FEATURES)
add("q_features_fixed", "SELECT * EXCLUDE (label) FROM features", CANDIDATES, STATS_FIXED, FEATURES)
add("q_train_features", "SELECT * FROM features", CANDIDATES, STATS, FEATURES)
add("q_features_vec", "SELECT customer_id, article_id, " + ", ".join(
    r(f"coalesce(embedding[{i + 1}], 0)") + f" AS img_feat_{i}" for i in range(64)
) + " FROM pairs LEFT JOIN embeddings ON vec_id = article_id", CANDIDATES)
add("q_labels", "SELECT customer_id, article_id, label FROM labelled", CANDIDATES, SCORED)
SAMPLE = """,
negatives AS (
  SELECT customer_id, article_id, label, row_number() OVER (
    ORDER BY (customer_id * 1000003 + article_id * 7919 + 42) % 2147483647, customer_id, article_id) AS position
  FROM labelled WHERE label = 0
), sampled AS (
  SELECT customer_id, article_id, label FROM labelled WHERE label = 1
  UNION ALL SELECT customer_id, article_id, label FROM negatives
  WHERE position <= 10 * (SELECT count(*) FROM labelled WHERE label = 1)
)"""
add("q_sample_negatives_exact", "SELECT * FROM sampled", CANDIDATES, SCORED, SAMPLE)
add("q_group_sizes", "SELECT customer_id, count(*) AS group_size FROM sampled GROUP BY ALL", CANDIDATES, SCORED, SAMPLE)

# --- ranker -----------------------------------------------------------------

IDEAL = """,
sizes AS (
  SELECT customer_id, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM labelled GROUP BY ALL
), ideal AS (
  SELECT customer_id, min(neg) AS neg, sum(1 / log2(i + 1)) AS ideal
  FROM sizes JOIN (SELECT unnest(range(1, 13)) AS i) ON i <= pos GROUP BY ALL
)"""
add("q_ndcg12", f"""
SELECT customer_id, {r('sum(CASE WHEN rank <= 12 THEN label / log2(rank + 1) ELSE 0 END) / min(ideal)')} AS ndcg
FROM ranked JOIN ideal USING (customer_id) GROUP BY ALL""", CANDIDATES, SCORED, IDEAL)
add("q_lambdas", f"""
, discounted AS (
  SELECT *, CASE WHEN rank <= 12 THEN 1 / log2(rank + 1) ELSE 0 END AS d
  FROM ranked JOIN ideal USING (customer_id) WHERE neg > 0
), swaps AS (
  SELECT p.customer_id, p.article_id AS better, n.article_id AS worse,
         1 / (1 + exp(p.score - n.score)) AS rho, abs(p.d - n.d) / p.ideal AS delta
  FROM discounted p JOIN discounted n ON p.customer_id = n.customer_id AND p.label = 1 AND n.label = 0
), parts AS (
  SELECT customer_id, better AS article_id, rho * delta AS l, rho * (1 - rho) * delta AS h FROM swaps
  UNION ALL SELECT customer_id, worse, -rho * delta, rho * (1 - rho) * delta FROM swaps
)
SELECT customer_id, article_id, {r('sum(l)')} AS lambda, {r('sum(h)')} AS hessian FROM parts GROUP BY ALL""",
    CANDIDATES, SCORED, IDEAL)

add("q_lambdas_normalised", f"""
, ideal30 AS (
  SELECT customer_id, sum(1 / log2(i + 1)) AS ideal
  FROM sizes JOIN (SELECT unnest(range(1, 31)) AS i) ON i <= pos WHERE neg > 0 GROUP BY ALL
), discounted AS (
  SELECT *, 1 / log2(rank + 1) AS d, max(score) OVER (PARTITION BY customer_id) > min(score) OVER (PARTITION BY customer_id) AS spread
  FROM ranked JOIN ideal30 USING (customer_id)
), swaps AS (
  SELECT p.customer_id, p.article_id AS better, n.article_id AS worse, 1 / (1 + exp(p.score - n.score)) AS rho,
         abs(p.d - n.d) / p.ideal / CASE WHEN p.spread THEN CAST(0.01 AS DOUBLE) + abs(p.score - n.score) ELSE 1 END AS delta
  FROM discounted p JOIN discounted n ON p.customer_id = n.customer_id AND p.label = 1 AND n.label = 0
  WHERE least(p.rank, n.rank) <= 30
), parts AS (
  SELECT customer_id, better AS article_id, rho * delta AS l, rho * (1 - rho) * delta AS h FROM swaps
  UNION ALL SELECT customer_id, worse, -rho * delta, rho * (1 - rho) * delta FROM swaps
  UNION ALL SELECT customer_id, article_id, 0, 0 FROM discounted
), summed AS (SELECT customer_id, article_id, sum(l) AS l, sum(h) AS h FROM parts GROUP BY ALL
), scaled AS (
  SELECT *, sum(abs(l)) OVER (PARTITION BY customer_id) AS total FROM summed
)
SELECT customer_id, article_id, {r('l * log2(1 + total) / total')} AS lambda, {r('h * log2(1 + total) / total')} AS hessian
FROM scaled""", CANDIDATES, SCORED, IDEAL)
# Candidates as training makes them: from what was bought before the label week.
HONEST = CANDIDATES.replace("train_tx", "clean").replace(LAST, FIXED)
add("q_ranker_checks", """
SELECT count(*) AS n_scored, count(DISTINCT customer_id) AS n_customers, CAST(0 AS BIGINT) AS n_not_finite,
       TRUE AS several_trees, TRUE AS better_than_a_source FROM pairs""", HONEST)
add("q_model_round_trip", "SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_different FROM pairs", HONEST)

# --- ranking, submission, evaluation ----------------------------------------

add("q_top50", f"SELECT customer_id, article_id, {r('score')} AS score, rank FROM ranked WHERE rank <= 50", CANDIDATES, SCORED)
add("q_top12", """
SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY rank) AS top12
FROM ranked WHERE rank <= 12 GROUP BY ALL""", CANDIDATES, SCORED)
add("q_global_top12", "SELECT article_id, n, rank FROM global12", CANDIDATES)
add("q_missing_customers", "SELECT customer_id FROM customers WHERE customer_id NOT IN (SELECT customer_id FROM pairs)", CANDIDATES)
add("q_submission", """
SELECT customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY rank) AS prediction
FROM predicted GROUP BY ALL""", CANDIDATES, SCORED)
add("q_submission_round_trip", """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, string_agg(CAST(article_id AS VARCHAR), ' ' ORDER BY rank) AS prediction
FROM predicted GROUP BY ALL""", CANDIDATES, SCORED)
add("q_pipeline_submission", """
SELECT customer_id, CASE WHEN n IS NULL THEN (SELECT count(*) FROM global12) ELSE least(12, n) END AS n_listed,
       least(12, coalesce(n, 0)) AS n_candidates
FROM customers LEFT JOIN (SELECT customer_id, count(*) AS n FROM pairs GROUP BY ALL) USING (customer_id)""", CANDIDATES)
add("q_resume", """
SELECT run, count(*) AS n_pairs, count(DISTINCT customer_id) AS n_customers
FROM repurchase CROSS JOIN (SELECT unnest(['first', 'resumed', 'fewer customers']) AS run) JOIN customers USING (customer_id)
WHERE run <> 'fewer customers' OR club_member_status IS NOT NULL GROUP BY run""", CANDIDATES)
add("q_ground_truth", "SELECT customer_id, article_id, n_actual AS n_bought FROM truth JOIN actual USING (customer_id)",
    CANDIDATES, SCORED)
add("q_ap12", f"SELECT customer_id, {r('ap')} AS ap FROM ({ap('predicted')})", CANDIDATES, SCORED)
add("q_map12", f"SELECT {r('avg(ap)', 9)} AS map_at_12, count(*) AS n_customers FROM ({ap('predicted')})", CANDIDATES, SCORED)


def ablated(copies: str) -> str:
    names = ", ".join(f"('{s}')" for s in SOURCES)
    return f""",
sources(removed) AS (VALUES {names}
), all_tx_week AS (
  SELECT article_id, count(*) AS n FROM transactions WHERE t_dat > {LAST} - {WEEK} GROUP BY ALL
), fallback AS (
  SELECT article_id, CAST(row_number() OVER (ORDER BY n DESC, article_id) AS INT) AS rank FROM all_tx_week QUALIFY rank <= 12
), kept AS (
  SELECT {copies} removed, customer_id, article_id FROM overlapping JOIN sources ON source <> removed
), kept_ranked AS (
  SELECT removed, customer_id, article_id, CAST(row_number() OVER (
    PARTITION BY removed, customer_id ORDER BY score DESC, article_id) AS INT) AS rank
  FROM kept JOIN scored USING (customer_id, article_id) QUALIFY rank <= 12
), all_predicted AS (
  SELECT removed, customer_id, article_id, rank FROM kept_ranked
  UNION ALL
  SELECT removed, customer_id, article_id, rank FROM customers CROSS JOIN sources CROSS JOIN fallback
  WHERE NOT EXISTS (SELECT 1 FROM kept_ranked k WHERE k.removed = sources.removed AND k.customer_id = customers.customer_id)
), baseline AS (SELECT avg(ap) AS m FROM ({ap('predicted')})
), removed_map AS (SELECT removed, avg(ap) AS m FROM ({ap('all_predicted', 'removed')}) GROUP BY ALL
)
SELECT 'None (full)' AS "Removed", {r('m', 9)} AS "MAP@12", CAST(0 AS DOUBLE) AS "Delta" FROM baseline
UNION ALL
SELECT concat('- ', removed), {r('removed_map.m', 9)}, {r('removed_map.m - baseline.m', 9)} FROM removed_map CROSS JOIN baseline"""


OVERLAPPING_PAIRS = CANDIDATES.replace(
    "pairs AS (SELECT DISTINCT customer_id, article_id FROM merged\n), overlapping AS (\n"
    "  SELECT * FROM merged UNION SELECT customer_id, article_id, 'als' FROM interactions WHERE n > 1\n)",
    "overlapping AS (\n"
    "  SELECT * FROM merged UNION SELECT customer_id, article_id, 'als' FROM interactions WHERE n > 1\n"
    "), pairs AS (SELECT DISTINCT customer_id, article_id FROM overlapping\n)",
)
add("q_ablation", ablated("DISTINCT"), OVERLAPPING_PAIRS, SCORED)
add("q_ablation_raw", ablated(""), OVERLAPPING_PAIRS, SCORED)

# --- look-ups ---------------------------------------------------------------

PADDED = "CASE WHEN length(CAST({0} AS VARCHAR)) < 10 THEN lpad(CAST({0} AS VARCHAR), 10, '0') ELSE CAST({0} AS VARCHAR) END"
PAD = PADDED.format("article_id")
add("q_recommendation_lookup", f"""
SELECT customer_id, rank, {PAD} AS article_id, coalesce(prod_name, 'Unknown Product') AS prod_name,
       'images/' || {PAD} || '.jpg' AS image_path
FROM predicted LEFT JOIN articles USING (article_id)""", CANDIDATES, SCORED)
add("q_recent_purchases", f"""
SELECT customer_id, rank, CAST(t_dat AS VARCHAR) AS t_dat, article_id, prod_name, 'images/' || {PAD} || '.jpg' AS image_path
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, article_id, price) AS INT) AS rank
      FROM transactions) LEFT JOIN articles USING (article_id) WHERE rank <= 5""")

# --- vectors ----------------------------------------------------------------

add("q_vector_columns", "SELECT vec_id AS article_id, " + ", ".join(
    f"{r(f'embedding[{i + 1}]')} AS img_feat_{i}" for i in range(64)) + " FROM embeddings")
add("q_embedding_similarity", f"""
, dims AS (SELECT vec_id AS article_id, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
), profile AS (
  SELECT customer_id, i, sum(w * x) / sum(w) AS x FROM decay JOIN dims USING (article_id) GROUP BY ALL
), similar_pairs AS (
  SELECT customer_id, article_id, sum(v.x * p.x) / sqrt(sum(v.x * v.x) * sum(p.x * p.x)) AS similarity
  FROM pairs JOIN dims v USING (article_id) JOIN profile p USING (customer_id, i) GROUP BY ALL
)
SELECT customer_id, article_id, {r('coalesce(similarity, 0)')} AS embedding_similarity
FROM pairs LEFT JOIN similar_pairs USING (customer_id, article_id)""", CANDIDATES, SCORED)

NEIGHBOURS = """, sizes AS (SELECT article_id, count(*) AS n FROM interactions GROUP BY ALL
), common AS (
  SELECT a.article_id, b.article_id AS neighbour_id, count(*) AS n
  FROM interactions a JOIN interactions b ON a.customer_id = b.customer_id AND a.article_id <> b.article_id GROUP BY ALL
), alike AS (
  SELECT article_id, neighbour_id, c.n / sqrt(CAST(x.n * y.n AS DOUBLE)) AS similarity
  FROM common c JOIN sizes x USING (article_id) JOIN sizes y ON y.article_id = c.neighbour_id
), neighbours AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY article_id ORDER BY similarity DESC, neighbour_id) AS INT) AS rank
  FROM alike WHERE similarity >= CAST(0.2 AS DOUBLE) QUALIFY rank <= 50
)"""
ALL_NEIGHBOURS = NEIGHBOURS.replace("WHERE similarity >= CAST(0.2 AS DOUBLE) ", "")
add("q_item_similarity", f"SELECT article_id, neighbour_id, {r('similarity')} AS similarity, rank FROM neighbours", CANDIDATES, ALL_NEIGHBOURS)
ITEM_ITEM = """, item_item AS (
SELECT customer_id, article_id, 'item_item' AS source FROM (
  SELECT customer_id, neighbour_id AS article_id, round(sum(similarity), 9) AS score
  FROM interactions JOIN neighbours USING (article_id) GROUP BY ALL
) WHERE (customer_id, article_id) NOT IN (SELECT (customer_id, article_id) FROM interactions)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) <= 100)"""
add("q_cand_item_item", "SELECT * FROM item_item", CANDIDATES, NEIGHBOURS, ITEM_ITEM)
EMBEDDING = """, dims AS (
  SELECT vec_id AS article_id, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings WHERE vec_id IN (SELECT article_id FROM articles)
), units AS (SELECT article_id, i, x / sqrt(sum(x * x) OVER (PARTITION BY article_id)) AS x FROM dims
), profile AS (SELECT customer_id, i, sum(w * x) / sum(w) AS x FROM decay JOIN dims USING (article_id) GROUP BY ALL
), directions AS (SELECT customer_id, i, x / sqrt(sum(x * x) OVER (PARTITION BY customer_id)) AS x FROM profile
), compared AS (
  SELECT customer_id, article_id, round(sum(u.x * d.x), 9) AS score FROM units u JOIN directions d USING (i) GROUP BY ALL
), embedding_sim AS (
  SELECT customer_id, article_id, 'embedding_sim' AS source FROM compared
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) <= 100
)"""
add("q_cand_embedding_sim", "SELECT * FROM embedding_sim", CANDIDATES, SCORED, EMBEDDING)
add("q_pipeline_candidates", """
, sold AS (
  SELECT article_id, row_number() OVER (ORDER BY count(*) DESC, article_id) AS place
  FROM train_tx WHERE t_dat > """ + f"{LAST} - {WEEK}" + """ GROUP BY article_id QUALIFY place <= 100
), global_popular AS (
  SELECT customer_id, article_id, 'global_popular' AS source FROM customers CROSS JOIN sold
  WHERE customer_id NOT IN (SELECT customer_id FROM interactions)
), all_sources AS (
  SELECT * FROM merged UNION SELECT * FROM global_popular
  UNION SELECT i.* FROM item_item i JOIN customers USING (customer_id)
  UNION SELECT e.* FROM embedding_sim e JOIN customers USING (customer_id)
)
SELECT customer_id, article_id, """ + ", ".join(
    f"max(CAST(source = '{name}' AS INT)) AS candidate_source_{name}" for name in SOURCES
) + " FROM all_sources GROUP BY ALL", CANDIDATES, NEIGHBOURS, ITEM_ITEM, SCORED, EMBEDDING)

# --- round trips and checks of fitted results ---------------------------------

add("q_csv_round_trip", f"""
SELECT CAST(t_dat AS VARCHAR) AS t_dat, lpad(CAST(customer_id AS VARCHAR), 10, '0') AS customer_id,
       lpad(CAST(article_id AS VARCHAR), 10, '0') AS article_id, {r('price', 4)} AS price, prod_name, product_type_no,
       department_no, colour_group_code, age, club_member_status, fashion_news_frequency
FROM transactions JOIN articles USING (article_id) JOIN customers USING (customer_id)""")
add("q_parquet_round_trip", f"{TX_OUT} transactions")
add("q_als_checks", """
SELECT customer_id, least(100, (SELECT count(DISTINCT article_id) FROM interactions) - count(*)) AS n_given,
       CAST(0 AS BIGINT) AS n_bought
FROM interactions GROUP BY customer_id
HAVING (SELECT count(DISTINCT article_id) FROM interactions) > count(*)""", CANDIDATES)
add("q_pca_checks", """
SELECT count(*) AS n_vectors, TRUE AS centred, TRUE AS uncorrelated, TRUE AS falling FROM embeddings""")
