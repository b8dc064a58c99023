"""The same queries as plain SQL over the given tables, for comparison with the registered Spark queries."""

RAW = """raw AS (
  SELECT event_id,
         CASE WHEN event_id % 31 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S UTC') END AS event_time,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
         p_type AS category_id,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE p_type || '.' || p_name END AS category_code,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE '  ' || p_brand || ' ' END AS brand,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS price,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS user_session
  FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT))"""

RECORDS = RAW + """, records AS (
  SELECT product_id AS key,
         CAST(json_object('event_id', event_id, 'event_time', event_time, 'event_type', event_type,
                          'product_id', product_id, 'category_id', category_id, 'category_code', category_code,
                          'brand', brand, 'price', price, 'user_id', user_id, 'user_session', user_session)
              AS VARCHAR) AS value,
         epoch_ms(event_id * 1000) AS timestamp
  FROM raw)"""

EVENT_TS = "CAST(try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS TIMESTAMP)"

SILVER = RAW + f""", silver AS (
  SELECT product_id, category_id,
         CASE WHEN category_code IS NULL THEN 'unknown' ELSE lower(trim(category_code)) END AS category_code,
         CASE WHEN brand IS NULL THEN 'unknown' ELSE lower(trim(brand)) END AS brand,
         CASE WHEN price IS NULL THEN 0.0::DOUBLE ELSE price END AS price,
         user_id, user_session, event_type, {EVENT_TS} AS event_timestamp
  FROM raw
  WHERE event_type IN ('view', 'cart', 'purchase') AND product_id IS NOT NULL AND user_id IS NOT NULL)"""

CLEAN = RAW + """, clean AS (
  SELECT * REPLACE (coalesce(price, 0.0::DOUBLE) AS price) FROM raw
  WHERE event_time IS NOT NULL AND event_type IN ('view', 'cart', 'purchase')
    AND product_id IS NOT NULL AND user_id IS NOT NULL)"""

SHOP = """shop AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, p_type AS category_id,
         CASE WHEN l_partkey % 13 = 0 THEN 'unknown' ELSE lower(p_type) END AS category_code,
         CASE WHEN l_partkey % 17 = 0 THEN 'unknown' ELSE lower(p_brand) END AS brand,
         l_extendedprice AS price, CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS user_session,
         CASE l_returnflag WHEN 'R' THEN 'view' WHEN 'A' THEN 'cart' ELSE 'purchase' END AS event_type,
         l_shipdate AS event_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def mean(column):
    return f"CAST(sum(CAST({column} AS DECIMAL(18,4))) AS DOUBLE) / count({column})"


def plain_mean(column):
    """The engine's own mean, cut to ten-thousandths off centre as the registered queries do."""
    return f"floor(avg({column}) * 10000 + 0.3585786438) / 10000.0::DOUBLE"


def with_plain_means(tables):
    return tables.replace(mean("price"), plain_mean("price"))


def quoted(column="brand"):
    return f"{column} || '\"\",' || chr(10) || '\"'"


def tallies(view, cart, purchase):
    return f"""count(*) AS total_events, count(*) FILTER (WHERE event_type = 'view') AS {view},
         count(*) FILTER (WHERE event_type = 'cart') AS {cart},
         count(*) FILTER (WHERE event_type = 'purchase') AS {purchase}"""


KEYS = "product_id, category_id, category_code, brand"
TALLIES = tallies("view_count", "cart_count", "purchase_count")
RATES = """CASE WHEN view_count > 0 THEN cart_count::DOUBLE / view_count ELSE 0.0::DOUBLE END AS view_to_cart_rate,
         CASE WHEN cart_count > 0 THEN purchase_count::DOUBLE / cart_count ELSE 0.0::DOUBLE END AS cart_to_purchase_rate,
         CASE WHEN view_count > 0 THEN purchase_count::DOUBLE / view_count ELSE 0.0::DOUBLE END AS view_to_purchase_rate"""
PRICES = f"{mean('price')} AS avg_price, min(price) AS min_price, max(price) AS max_price"
TIMES = "min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen"

STATS = SHOP + f""", counted AS (
  SELECT {KEYS}, {TALLIES}, count(DISTINCT user_id) AS unique_users, count(DISTINCT user_session) AS unique_sessions,
         {PRICES}, {TIMES}
  FROM shop GROUP BY ALL), stats AS (
  SELECT *, {RATES}, view_count + 3 * cart_count + 10 * purchase_count AS popularity_score,
         unique_users + unique_sessions * 0.5::DOUBLE AS engagement_score
  FROM counted)"""

CATEGORIES = SHOP + f""", categories AS (
  SELECT category_id, category_code, count(DISTINCT product_id) AS product_count, count(DISTINCT brand) AS brand_count,
         {tallies('total_views', 'total_carts', 'total_purchases')}, count(DISTINCT user_id) AS unique_users,
         {mean('price')} AS avg_category_price, min(event_timestamp) AS first_activity, max(event_timestamp) AS last_activity
  FROM shop GROUP BY category_id, category_code)"""

_BRANDS = f"""brands AS (
  SELECT brand, count(DISTINCT product_id) AS product_count, count(DISTINCT category_id) AS category_count,
         {tallies('total_views', 'total_carts', 'total_purchases')}, count(DISTINCT user_id) AS unique_users,
         {mean('price')} AS avg_brand_price, min(event_timestamp) AS first_activity, max(event_timestamp) AS last_activity
  FROM shop WHERE brand <> 'unknown' GROUP BY brand)"""
BRANDS = SHOP + ", " + _BRANDS

RANKS = {
    "most_viewed": "view_count",
    "most_carted": "cart_count",
    "most_purchased": "purchase_count",
    "most_popular": "popularity_score",
}


def top(rank_type, size=100):
    return f"""SELECT product_id, category_code, brand, avg_price, '{rank_type}' AS rank_type, {RANKS[rank_type]} AS rank_value
  FROM stats ORDER BY {RANKS[rank_type]} DESC, {KEYS} LIMIT {size}"""


RANKINGS = ", rankings AS (" + " UNION ALL ".join(f"SELECT * FROM ({top(name)})" for name in RANKS) + ")"

PRICE_TIER = """CASE WHEN avg_price < 50 THEN 'budget' WHEN avg_price < 200 THEN 'mid_range'
         WHEN avg_price < 500 THEN 'premium' ELSE 'luxury' END"""
ENGAGEMENT_TIER = """CASE WHEN engagement_score < 10 THEN 'low' WHEN engagement_score < 50 THEN 'medium'
         WHEN engagement_score < 100 THEN 'high' ELSE 'very_high' END"""

FEATURES = STATS + f""", features AS (
  SELECT {KEYS}, avg_price, view_count, cart_count, purchase_count, popularity_score, view_to_cart_rate,
         cart_to_purchase_rate, view_to_purchase_rate, unique_users, engagement_score,
         percent_rank() OVER (ORDER BY popularity_score) AS popularity_percentile,
         {PRICE_TIER} AS price_tier, {ENGAGEMENT_TIER} AS engagement_tier
  FROM stats)"""

SIMILAR = STATS + """, spots AS (
  SELECT product_id, category_id AS cluster, popularity_score FROM stats
  UNION ALL SELECT product_id, brand, popularity_score FROM stats WHERE CAST(product_id AS BIGINT) % 5 = 0), pairs AS (
  SELECT a.product_id, b.product_id AS similar_product_id, a.cluster, abs(a.popularity_score - b.popularity_score) AS score_diff
  FROM spots a JOIN spots b ON a.cluster = b.cluster AND a.product_id <> b.product_id
  QUALIFY row_number() OVER (PARTITION BY a.product_id, b.product_id
    ORDER BY abs(a.popularity_score - b.popularity_score), a.cluster) = 1), alike AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + score_diff / 1000.0::DOUBLE) AS similarity_score,
         CAST(row_number() OVER (PARTITION BY product_id ORDER BY score_diff, similar_product_id) AS INTEGER) AS rank
  FROM pairs QUALIFY rank <= 10)"""

RATINGS = SHOP + """, ratings AS (
  SELECT user_id, product_id,
         sum(CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'cart' THEN 3.0::DOUBLE
                             WHEN 'purchase' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END) AS total_rating,
         count(*) AS interaction_count
  FROM shop GROUP BY user_id, product_id), rated AS (
  SELECT *, total_rating + ln(interaction_count + 1) AS final_rating FROM ratings)"""

INDEXED = RATINGS + """, users AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS user_index
  FROM rated GROUP BY user_id), products AS (
  SELECT product_id, CAST(row_number() OVER (ORDER BY count(*) DESC, product_id) - 1 AS INTEGER) AS product_index
  FROM rated GROUP BY product_id), indexed AS (
  SELECT user_index AS "user", product_index AS item, user_id, product_id, final_rating AS rating
  FROM rated JOIN users USING (user_id) JOIN products USING (product_id)), sided AS (
  SELECT *, CASE WHEN CAST('0x' || substr(md5('42:' || "user" || ':' || item), 1, 7) AS BIGINT) < 214748364
                 THEN 'train' ELSE 'test' END AS side
  FROM indexed)"""

TRAINED = INDEXED + """, train AS (SELECT * FROM sided WHERE side = 'train'), known_users AS (
  SELECT DISTINCT "user", user_id FROM train), known_items AS (SELECT DISTINCT item FROM train), places AS (
  SELECT CAST(unnest(range(1, 1 + least(10, (SELECT count(*) FROM known_items)))) AS INTEGER) AS rank)"""

VECTORS = STATS + """, by_brand AS (
  SELECT brand, CAST(row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS DOUBLE) AS brand_index
  FROM stats GROUP BY brand), by_category AS (
  SELECT category_code, CAST(row_number() OVER (ORDER BY count(*) DESC, category_code) - 1 AS DOUBLE) AS category_index
  FROM stats GROUP BY category_code), vectors AS (
  SELECT product_id, avg_price, popularity_score::DOUBLE AS popularity_score,
         unique_users::DOUBLE / total_events AS engagement_rate, brand_index, category_index
  FROM stats JOIN by_brand USING (brand) JOIN by_category USING (category_code))"""

CATALOGUE = STATS + """, catalogue AS (
  SELECT product_id, category_code, brand, avg_price AS price, view_count, cart_count, purchase_count, popularity_score
  FROM stats)"""
CATALOGUE_COLUMNS = "product_id, category_code, brand, price, view_count, cart_count, purchase_count"
# Cents nearest to the exact binary value of the price, halves upward.
CENTS = """(CAST(floor(price) AS BIGINT) * 100
        + ((CAST(floor((price - floor(price)) * 4503599627370496) AS BIGINT) * 100 + 2251799813685248) >> 52))"""
FOUND = "product_id, category_code, brand, avg_price, popularity_score, price_tier"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

RECORD_ROWS = f"WITH {RECORDS} SELECT key, value, timestamp FROM records"
SILVER_ROWS = f"WITH {SILVER} SELECT * FROM silver"
PARSED = f"""WITH {RAW} SELECT product_id AS kafka_key, epoch_ms(event_id * 1000) AS kafka_timestamp, event_time, event_type,
  product_id, category_id, category_code, brand, price, user_id, user_session, CAST(NULL AS VARCHAR) AS processed_timestamp
  FROM raw"""


def _scaled(column):
    return f"round({column} / stddev_samp({column}) OVER (), 6) AS {column}"


def _section(name, source, key, value, order, size):
    return f"""SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position,
  {key} AS key, {value} AS value FROM {source} QUALIFY position <= {size}"""


def _dashboard():
    parts = [
        _section(name, f"(SELECT * FROM rankings WHERE rank_type = '{kind}')", "product_id", "rank_value",
                 "rank_value DESC, product_id, category_code, brand", 5)
        for name, kind in (("top_viewed", "most_viewed"), ("top_carted", "most_carted"), ("top_purchased", "most_purchased"))
    ]
    parts += [
        f"SELECT 'total_{table}' AS section, 1 AS position, 'count' AS key, count(*) AS value FROM {table}"
        for table in ("categories", "brands")
    ]
    parts.append(_section("categories", "categories", "category_id || '/' || category_code", "total_events",
                          "total_events DESC, category_id, category_code", 10))
    parts.append(_section("brands", "brands", "brand", "total_events", "total_events DESC, brand", 10))
    body = " UNION ALL ".join(f"SELECT * FROM ({part})" for part in parts)
    categories = CATEGORIES[len(SHOP) + 2:]
    return f"WITH {STATS}{RANKINGS}, {categories}, {_BRANDS} {body}"


SQL = {
    # sources and sinks
    "src_csv_events": f"WITH {RAW} SELECT * EXCLUDE (event_id) REPLACE ({quoted()} AS brand) FROM raw",
    "src_kafka_raw": RECORD_ROWS,
    "src_kafka_events": PARSED,
    "prj_kafka_cast": RECORD_ROWS,
    "snk_bronze_stream": RECORD_ROWS,
    "snk_silver_stream": SILVER_ROWS,
    "snk_console": f"""WITH {RAW} SELECT count(*) AS input_rows, least(2, count(*)) AS printed_rows,
      CAST(12 AS BIGINT) AS columns FROM raw""",
    "src_bronze_batch": RECORD_ROWS,
    "snk_silver_batch": SILVER_ROWS,
    "src_silver": f"""WITH {SILVER} SELECT DATE '2024-01-02' AS processing_date, event_type, count(*) AS events
      FROM silver GROUP BY event_type""",
    "snk_gold": f"WITH {STATS} SELECT *, count(*) OVER () AS written_rows FROM stats",
    "snk_reco_tables": f"""WITH {TRAINED}, {SIMILAR[len(SHOP) + 2:]}
      SELECT 'user_recommendations' AS "table", user_id AS id, count(*) AS "rows" FROM known_users, places GROUP BY user_id
      UNION ALL SELECT 'similar_products', product_id, count(*) FROM alike GROUP BY product_id""",
    "snk_models": f"""WITH {TRAINED}, {STATS[len(SHOP) + 2:]}
      SELECT 'user_factors' AS "table", count(*) AS "rows" FROM known_users
      UNION ALL SELECT 'item_factors', count(*) FROM known_items
      UNION ALL SELECT 'cluster_centers', least(20, count(*)) FROM stats""",
    "src_parquet_object": "SELECT * FROM orders",
    "src_parquet_folder": """SELECT * FROM orders
      UNION ALL BY NAME SELECT * EXCLUDE (c_custkey), c_custkey AS o_custkey FROM customer""",
    "snk_parquet_object": f"WITH {RAW} SELECT * FROM raw",
    "src_csv_object": f"SELECT * REPLACE ({quoted('p_name')} AS p_name) FROM part",
    "snk_csv_object": f"WITH {RAW} SELECT * REPLACE ({quoted()} AS brand) FROM raw",
    "src_file_listing": f"""WITH {RAW} SELECT event_type, CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes,
      CAST(0 AS BIGINT) AS nameless FROM raw GROUP BY event_type""",
    "snk_kafka_events": f"""WITH {CLEAN} SELECT product_id AS key,
      CAST(json_object('event_time', event_time, 'event_type', event_type, 'product_id', product_id,
           'category_id', category_id, 'category_code', category_code, 'brand', brand, 'price', price,
           'user_id', user_id, 'user_session', user_session, 'processed_timestamp', '2024-01-02T03:04:05.000000')
           AS VARCHAR) AS value FROM clean""",
    "src_paced_replay": RECORD_ROWS,
    "src_sample_events": """SELECT '2024-01-02 03:04:05 UTC' AS event_time,
      CASE WHEN o_orderkey % 2 = 0 THEN 'view' ELSE 'cart' END AS event_type,
      'product_' || o_orderkey AS product_id,
      CASE WHEN o_orderkey % 2 = 0 THEN '2232732093077520756' ELSE '2232732100769874463' END AS category_id,
      CASE WHEN o_orderkey % 2 = 0 THEN 'construction.tools.light' ELSE 'appliances.personal.massager' END AS category_code,
      CASE WHEN o_orderkey % 2 = 0 THEN 'apple' ELSE 'bosch' END AS brand,
      CASE WHEN o_orderkey % 2 = 0 THEN 1302.48::DOUBLE ELSE 313.52::DOUBLE END AS price,
      'user_' || o_orderkey AS user_id,
      CASE WHEN o_orderkey % 2 = 0 THEN 'sample-session-001' ELSE 'sample-session-002' END AS user_session
      FROM orders""",
    "src_images_binary": f"""WITH {RAW} SELECT category_code AS category,
      CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM raw WHERE category_code IS NOT NULL
      GROUP BY category_code""",
    "src_model_parts": f"""WITH {STATS} SELECT 'stages' AS source,
      count(DISTINCT brand) + count(DISTINCT category_code) + 1 + least(20, count(*)) AS "rows" FROM stats""",
    # ingest and cleaning
    "ing_drop_missing": f"""WITH {RAW} SELECT * FROM raw WHERE event_time IS NOT NULL AND event_type IS NOT NULL
      AND product_id IS NOT NULL AND user_id IS NOT NULL""",
    "ing_valid_events": f"WITH {RAW} SELECT event_id, event_type FROM raw WHERE event_type IN ('view', 'cart', 'purchase')",
    "ing_cast_ids": """SELECT event_id, CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS VARCHAR) AS category_id,
      CAST(user_id AS VARCHAR) AS user_id
      FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)""",
    "ing_fill_price": f"WITH {RAW} SELECT event_id, coalesce(price, 0.0::DOUBLE) AS price FROM raw",
    "ing_null_text": f"WITH {RAW} SELECT event_id, category_code, brand FROM raw",
    "ing_stamp": f"WITH {RAW} SELECT event_id, '2024-01-02T03:04:05.000000' AS processed_timestamp FROM raw",
    "ing_clean_report": f"""WITH {CLEAN} SELECT (SELECT count(*) FROM raw) AS initial_rows, count(*) AS final_rows FROM clean""",
    "ing_parse_json": PARSED,
    "ing_required": f"""WITH {RAW} SELECT event_id, product_id, user_id FROM raw
      WHERE product_id IS NOT NULL AND user_id IS NOT NULL""",
    "ing_event_ts": f"WITH {RAW} SELECT event_id, {EVENT_TS} AS event_timestamp FROM raw",
    "ing_norm_brand": f"WITH {RAW} SELECT event_id, coalesce(lower(trim(brand)), 'unknown') AS brand FROM raw",
    "ing_norm_category": f"""WITH {RAW} SELECT event_id, coalesce(lower(trim(category_code)), 'unknown') AS category_code
      FROM raw""",
    "ing_processing_cols": f"""WITH {RAW} SELECT event_id, DATE '2024-01-02' AS processing_date,
      TIMESTAMP '2024-01-02 03:04:05' AS processing_timestamp FROM raw""",
    "ing_silver": f"""WITH {SILVER} SELECT *, DATE '2024-01-02' AS processing_date,
      TIMESTAMP '2024-01-02 03:04:05' AS processing_timestamp FROM silver""",
    "ing_distinct_categories": f"WITH {RAW} SELECT DISTINCT category_code FROM raw WHERE category_code IS NOT NULL",
    "ing_category_slug": f"""WITH {RAW} SELECT DISTINCT category_code, replace(category_code, '.', '_') AS folder
      FROM raw WHERE category_code IS NOT NULL""",
    # aggregations
    "agg_event_counts": f"WITH {SHOP} SELECT {KEYS}, {TALLIES} FROM shop GROUP BY ALL",
    "agg_distincts": f"""WITH {SHOP} SELECT category_id, count(DISTINCT user_id) AS unique_user_id,
      count(DISTINCT user_session) AS unique_user_session, count(DISTINCT product_id) AS unique_product_id,
      count(DISTINCT brand) AS unique_brand, count(DISTINCT category_code) AS unique_category_code
      FROM shop GROUP BY category_id""",
    "agg_price_stats": with_plain_means(f"WITH {SHOP} SELECT {KEYS}, {PRICES} FROM shop GROUP BY ALL"),
    "agg_time_bounds": f"WITH {SHOP} SELECT {KEYS}, {TIMES} FROM shop GROUP BY ALL",
    "agg_conversion_rates": f"WITH {STATS} SELECT {KEYS}, view_to_cart_rate, cart_to_purchase_rate, view_to_purchase_rate FROM stats",
    "agg_popularity": f"WITH {STATS} SELECT {KEYS}, popularity_score FROM stats",
    "agg_engagement_score": f"WITH {STATS} SELECT {KEYS}, engagement_score FROM stats",
    "agg_engagement_rate": f"WITH {STATS} SELECT {KEYS}, unique_users::DOUBLE / total_events AS engagement_rate FROM stats",
    "gold_product_statistics": with_plain_means(f"WITH {STATS} SELECT * FROM stats"),
    "gold_category_statistics": with_plain_means(f"WITH {CATEGORIES} SELECT * FROM categories"),
    "gold_brand_statistics": with_plain_means(f"WITH {BRANDS} SELECT * FROM brands"),
    "reco_ratings": f"WITH {RATINGS} SELECT * REPLACE (round(final_rating, 9) AS final_rating) FROM rated",
    "reco_product_features": with_plain_means(f"""WITH {STATS} SELECT {KEYS}, avg_price, total_events AS interaction_count, view_count,
      cart_count, purchase_count, unique_users, popularity_score, unique_users::DOUBLE / total_events AS engagement_rate
      FROM stats"""),
    "reco_cluster_sizes": f"WITH {SIMILAR} SELECT cluster, count(*) AS count FROM spots GROUP BY cluster",
    "agg_row_counts": " UNION ALL ".join(f"""SELECT '{name}' AS "table", count(*) AS "rows" FROM {name}""" for name in TABLES),
    # joins, windows, rankings
    "join_same_cluster": f"WITH {SIMILAR} SELECT * EXCLUDE (rank) FROM alike",
    "join_index_lookup": f"""WITH {INDEXED} SELECT user_id, product_id, round(CAST(CAST(rating AS FLOAT) AS DOUBLE), 3) AS rating
      FROM indexed""",
    **{f"rank_{name}": f"WITH {STATS} {top(name)}" for name in RANKS},
    "gold_product_rankings": f"WITH {STATS}{RANKINGS} SELECT * FROM rankings",
    "win_percent_rank": f"""WITH {STATS} SELECT {KEYS}, popularity_score,
      percent_rank() OVER (ORDER BY popularity_score) AS popularity_percentile FROM stats""",
    "feat_price_tier": f"""WITH {STATS}, cheaper AS (SELECT * REPLACE (avg_price / 100 AS avg_price) FROM stats)
      SELECT {KEYS}, avg_price, {PRICE_TIER} AS price_tier FROM cheaper""",
    "feat_engagement_tier": f"WITH {STATS} SELECT {KEYS}, engagement_score, {ENGAGEMENT_TIER} AS engagement_tier FROM stats",
    "gold_recommendation_features": f"WITH {FEATURES} SELECT * FROM features",
    "win_topk_similar": f"WITH {SIMILAR} SELECT * FROM alike WHERE rank <= 5",
    "reco_similar_products": f"WITH {SIMILAR} SELECT * FROM alike",
    # recommendation and clustering
    "ml_index_ids": f"""WITH {INDEXED} SELECT 'user' AS kind, user_id AS label, user_index AS index FROM users
      UNION ALL SELECT 'product', product_id, product_index FROM products""",
    "ml_split": f"""WITH {INDEXED} SELECT side, "user", item FROM sided""",
    "ml_als_fit": f"""WITH {TRAINED} SELECT 'user' AS side, "user" AS id, 10 AS factors FROM known_users
      UNION ALL SELECT 'item', item, 10 FROM known_items""",
    "ml_als_score": f"""WITH {TRAINED} SELECT "user", item, true AS scored FROM sided
      WHERE side = 'test' AND "user" IN (SELECT "user" FROM known_users) AND item IN (SELECT item FROM known_items)""",
    "ml_rmse": f"""WITH {RATINGS} SELECT round(sqrt(avg(pow(interaction_count - final_rating, 2))), 6) AS rmse FROM rated""",
    "ml_recommend_all": f"""WITH {TRAINED} SELECT "user", CAST(max(rank) AS INTEGER) AS picks, true AS falling, true AS once
      FROM known_users, places GROUP BY "user" """,
    "ml_recommend_flat": f"""WITH {TRAINED} SELECT "user", rank, true AS scored FROM known_users, places""",
    "ml_user_range": f"""WITH {INDEXED} SELECT CAST(user_index AS BIGINT) AS "user" FROM users""",
    "ml_generate_recommendations": f"WITH {TRAINED} SELECT user_id, rank, true AS scored FROM known_users, places",
    "ml_index_categorical": f"WITH {VECTORS} SELECT product_id, brand_index, category_index FROM vectors",
    "ml_assemble": f"WITH {VECTORS} SELECT * FROM vectors",
    "ml_scale": f"""WITH {VECTORS} SELECT product_id, {', '.join(_scaled(c) for c in (
        'avg_price', 'popularity_score', 'engagement_rate', 'brand_index', 'category_index'))} FROM vectors""",
    "ml_kmeans": f"WITH {STATS} SELECT product_id, true AS assigned FROM stats",
    "ml_cluster_products": f"WITH {STATS} SELECT product_id, true AS assigned FROM stats",
    # serving
    "q_product_statistics": f"WITH {STATS} SELECT * FROM stats",
    "q_top_products": f"""WITH {STATS}{RANKINGS} SELECT * FROM rankings WHERE rank_type = 'most_carted'
      ORDER BY rank_value DESC, product_id, category_code, brand LIMIT 10""",
    "q_search_text": f"""WITH {FEATURES} SELECT {FOUND} FROM features
      WHERE regexp_matches(category_code, 'brand#1[0-5]|eco') OR regexp_matches(brand, 'brand#1[0-5]|eco')""",
    "q_filter_category": f"WITH {FEATURES} SELECT {FOUND} FROM features WHERE regexp_matches(category_code, '^s.*d$')",
    "q_filter_brand": f"WITH {FEATURES} SELECT {FOUND} FROM features WHERE regexp_matches(brand, 'brand#1')",
    "q_filter_price": f"WITH {FEATURES} SELECT {FOUND} FROM features WHERE avg_price >= 40000 AND avg_price <= 52000",
    "q_filter_tier": f"""WITH {FEATURES}, cheaper AS (SELECT * REPLACE (avg_price / 100 AS avg_price) FROM features),
      again AS (SELECT * REPLACE ({PRICE_TIER} AS price_tier) FROM cheaper)
      SELECT {FOUND} FROM again WHERE price_tier = 'premium'""",
    "q_search_products": f"""WITH {FEATURES} SELECT {FOUND} FROM features
      WHERE (regexp_matches(category_code, 'brand#1') OR regexp_matches(brand, 'brand#1'))
        AND regexp_matches(category_code, 's') AND avg_price >= 0 AND price_tier = 'luxury'
      ORDER BY popularity_score DESC, {KEYS} LIMIT 20""",
    "q_product_details": f"WITH {STATS} SELECT * FROM stats WHERE product_id = '1' ORDER BY {KEYS} LIMIT 1",
    "q_similar_products": f"""WITH {SIMILAR} SELECT * FROM alike WHERE product_id = '1'
      ORDER BY similarity_score DESC, similar_product_id LIMIT 5""",
    "q_user_recommendations": f"WITH {TRAINED} SELECT user_id, rank, true AS scored FROM known_users, places WHERE user_id = '1'",
    "q_category_statistics": f"WITH {CATEGORIES} SELECT * FROM categories",
    "q_brand_statistics": f"WITH {BRANDS} SELECT * FROM brands",
    "q_recommendations_table": f"WITH {TRAINED} SELECT user_id, rank, true AS scored FROM known_users, places",
    "q_dashboard": _dashboard(),
    # catalogue
    "ui_browse_filter": f"""WITH {CATALOGUE} SELECT {CATALOGUE_COLUMNS} FROM catalogue
      WHERE contains(lower(category_code || ' ' || brand), 'd brand#1') AND category_code = 'standard' AND price >= 1000""",
    "ui_price_range": f"""WITH {CATALOGUE}, cheaper AS (SELECT * REPLACE (price / 100 AS price) FROM catalogue)
      SELECT {CATALOGUE_COLUMNS} FROM cheaper WHERE price >= 100 AND price <= 500""",
    "ui_filter_options": f"""WITH {CATALOGUE} SELECT 'category' AS kind, category_code AS option FROM catalogue
      WHERE category_code <> '' UNION SELECT 'brand', brand FROM catalogue WHERE brand <> ''""",
    "ui_page": f"""WITH {CATALOGUE} SELECT {CATALOGUE_COLUMNS} FROM catalogue
      ORDER BY product_id, category_code, brand LIMIT 12 OFFSET 24""",
    "ui_top5": f"""WITH {CATALOGUE} SELECT CAST(row_number() OVER (ORDER BY coalesce(purchase_count, 0) DESC, product_id,
      category_code, brand) AS INTEGER) AS position, product_id, category_code, coalesce(purchase_count, 0) AS shown_count
      FROM catalogue QUALIFY position <= 5""",
    "ui_match_score": f"""WITH {CATALOGUE} SELECT product_id, CAST(greatest(10, least(100, floor(
      0.1::DOUBLE * view_count + 2 * cart_count + 5 * purchase_count + 0.5::DOUBLE))) AS BIGINT) AS match_score FROM catalogue""",
    "ui_display_columns": f"""WITH {CATALOGUE} SELECT {CATALOGUE_COLUMNS},
      coalesce(replace(category_code, '.', ' > '), '-') AS category_text,
      upper(substr(brand, 1, 1)) || substr(brand, 2) AS brand_text,
      '$' || ({CENTS} // 100) || '.' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0') AS price_text FROM catalogue""",
    "ui_suggest": f"""WITH {CATALOGUE} SELECT {CATALOGUE_COLUMNS} FROM catalogue
      WHERE contains(lower(category_code || ' ' || brand), 'brand#2')
      ORDER BY popularity_score DESC, product_id, category_code, brand LIMIT 5""",
    "ui_live_top": with_plain_means(f"""WITH {STATS}, offers AS ({' UNION ALL '.join(
        f"SELECT {KEYS}, avg_price, '{name}' AS rank_type, {measure} AS rank_value FROM stats"
        for name, measure in RANKS.items())})
      SELECT product_id, category_code, brand, avg_price, rank_type, rank_value,
             CAST(row_number() OVER (PARTITION BY rank_type ORDER BY rank_value DESC, {KEYS}) AS INTEGER) AS position
      FROM offers QUALIFY position <= 100"""),
}
