"""Windows, quantiles and the model workloads."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import functions as F

from lakemodels.analytics import isoforest, kmeans, scaling, tfidf
from lakemodels.functions import scalars
from lakemodels.operators.quantile import flag_low
from lakemodels.operators.windows import running_sum
from lakemodels.plans.registry import plan, read


@plan("""
    SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id) AS DOUBLE) AS total
    FROM events
""", name="running_sum")
def running_total_of_events(spark, folder):
    events = read(spark, folder, "events").select("event_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    totals = running_sum(events, F.col("value"), ["ts", "event_id"], name="total")
    return totals.select("event_id", F.col("total").cast("double").alias("total"))


@plan("""
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS total
    FROM events
""")
def running_sum_by_user(spark, folder):
    events = read(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.col("value").cast("decimal(18,2)").alias("value")
    )
    totals = running_sum(events, F.col("value"), ["ts", "event_id"], ["user_id"], name="total")
    return totals.select("event_id", "user_id", F.col("total").cast("double").alias("total"))


_FEATURES = ["n_orders", "avg_order_value", "days_active"]

_CUSTOMER_FEATURES = """
    f AS (SELECT o_custkey AS customer_id, CAST(count(*) AS DOUBLE) AS n_orders,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value,
                 CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS DOUBLE) AS days_active
          FROM orders GROUP BY 1)
"""


def _customer_features(spark, folder):
    orders = read(spark, folder, "orders")
    return orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("avg_order_value"),
        F.date_diff(F.max("o_orderdate").cast("date"), F.min("o_orderdate").cast("date")).cast("double").alias("days_active"),
    )


@plan(f"""
    WITH {_CUSTOMER_FEATURES}
    SELECT customer_id,
           round((n_orders - avg(n_orders) OVER ()) / stddev_pop(n_orders) OVER (), 6) AS n_orders_scaled,
           round((avg_order_value - avg(avg_order_value) OVER ()) / stddev_pop(avg_order_value) OVER (), 6)
               AS avg_order_value_scaled,
           round((days_active - avg(days_active) OVER ()) / stddev_pop(days_active) OVER (), 6) AS days_active_scaled
    FROM f
""")
def standardize(spark, folder):
    scaled = scaling.standardize(_customer_features(spark, folder), _FEATURES)
    return scaled.select("customer_id", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _FEATURES])


# Fixed centroids: few small orders, few large ones, many orders over years.
_CENTROIDS = [[6.0, 220000.0, 1200.0], [9.0, 270000.0, 1900.0], [14.0, 250000.0, 2300.0]]
_SPREAD = [3.0, 45000.0, 400.0]


def _distance_sql(center):
    return " + ".join(
        f"((CAST({name} AS DOUBLE) - 0e0) / {spread}e0 - {value / spread!r}e0) * "
        f"((CAST({name} AS DOUBLE) - 0e0) / {spread}e0 - {value / spread!r}e0)"
        for name, spread, value in zip(_FEATURES, _SPREAD, center)
    )


_ASSIGNED = f"""
    {_CUSTOMER_FEATURES},
    d AS (SELECT *, {_distance_sql(_CENTROIDS[0])} AS d0, {_distance_sql(_CENTROIDS[1])} AS d1,
                 {_distance_sql(_CENTROIDS[2])} AS d2 FROM f),
    a AS (SELECT customer_id, n_orders, avg_order_value, days_active,
                 CAST(CASE least(d0, d1, d2) WHEN d0 THEN 0 WHEN d1 THEN 1 ELSE 2 END AS SMALLINT) AS cluster_id FROM d)
"""


def _assigned(spark, folder):
    scaled = [[v / s for v, s in zip(center, _SPREAD)] for center in _CENTROIDS]
    return kmeans.assign_clusters(_customer_features(spark, folder), _FEATURES, scaled, [0.0] * 3, _SPREAD)


@plan(f"WITH {_ASSIGNED} SELECT customer_id, cluster_id FROM a")
def kmeans_assign(spark, folder):
    return _assigned(spark, folder).select("customer_id", "cluster_id")


@plan(f"""
    WITH {_ASSIGNED}
    SELECT cluster_id, count(*) AS n_rows, round(avg(n_orders), 6) AS avg_n_orders,
           round(avg(avg_order_value), 4) AS avg_avg_order_value, round(avg(days_active), 6) AS avg_days_active
    FROM a GROUP BY cluster_id
""")
def cluster_summary(spark, folder):
    summary = kmeans.cluster_summary(_assigned(spark, folder), _FEATURES)
    digits = {"avg_n_orders": 6, "avg_avg_order_value": 4, "avg_days_active": 6}
    return summary.withColumns({c: F.round(c, d) for c, d in digits.items()})


@plan()
def kmeans_clusters(spark, folder):
    return kmeans.kmeans_clusters(_customer_features(spark, folder), _FEATURES)


@plan("""
    SELECT o_custkey AS customer_id, CAST(0 AS BIGINT) AS nearer_centroids, true AS centroid_is_mean FROM orders GROUP BY 1
""")
def kmeans_invariants(spark, folder):
    """What holds for any k-means result: no other centroid is nearer to a row, and a centroid is its members' mean.

    Both up to what the last iteration may still move: a hundredth of a standard deviation.
    """
    clusters = kmeans.kmeans_clusters(_customer_features(spark, folder), _FEATURES)
    means = clusters.groupBy("cluster_id", "centroid").agg(*[F.avg(c).alias(f"mean_{c}") for c in _FEATURES])
    spreads = clusters.agg(*[F.stddev(c).alias(f"spread_{c}") for c in _FEATURES])
    # One row per cluster and one row.
    known = means.crossJoin(spreads).withColumn(
        "centroid_is_mean",
        reduce(and_, [F.abs(F.col(f"centroid.{c}") - F.col(f"mean_{c}")) <= F.col(f"spread_{c}") / 100 for c in _FEATURES]),
    )
    listed = known.agg(F.collect_list(F.struct("cluster_id", "centroid", "centroid_is_mean", *[f"spread_{c}" for c in _FEATURES])).alias("known"))
    far = lambda m: F.sqrt(reduce(add, [((F.col(c) - m["centroid"][c]) / m[f"spread_{c}"]) ** 2 for c in _FEATURES]))
    own = F.filter("known", lambda m: m["cluster_id"] == F.col("cluster_id"))[0]
    nearer = F.size(F.filter("known", lambda m: far(m) + 0.01 < far(F.filter("known", lambda o: o["cluster_id"] == F.col("cluster_id"))[0])))
    return clusters.crossJoin(F.broadcast(listed)).select(
        "customer_id", nearer.cast("bigint").alias("nearer_centroids"), own["centroid_is_mean"].alias("centroid_is_mean")
    )


@plan()
def isolation_forest(spark, folder):
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ordered_at"),
        scalars.hour_of_day(F.col("o_orderdate")).alias("hour_of_day"),
        scalars.day_of_week(F.col("o_orderdate")).alias("day_of_week"),
    )
    return isoforest.isolation_forest(orders, "order_id", ["amount", "hour_of_day", "day_of_week"])


@plan("""
    SELECT o_orderkey AS order_id, true AS score_in_range, true AS flag_follows_score, true AS flagged_share_holds FROM orders
""")
def isolation_forest_invariants(spark, folder):
    """What holds for any forest: scores lie within a unit of their offset, negative ones are flagged, and no more than the share asked for."""
    scored = isolation_forest(spark, folder)
    flagged = F.count_if("is_anomaly") <= F.ceil(0.005 * F.count(F.lit(1)))
    # One row; offsets lie in [-1, 0), as raw scores do.
    held = scored.agg(flagged.alias("flagged_share_holds"))
    return scored.crossJoin(F.broadcast(held)).select(
        "order_id",
        (F.abs("anomaly_score") < 1).alias("score_in_range"),
        (F.col("is_anomaly") == (F.col("anomaly_score") < 0)).alias("flag_follows_score"),
        "flagged_share_holds",
    )


@plan("""
    SELECT o_orderkey, o_totalprice, o_totalprice < (SELECT quantile_cont(o_totalprice, 0.005) FROM orders) AS is_anomaly
    FROM orders
""")
def quantile_flag(spark, folder):
    orders = read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return flag_low(orders, "o_totalprice", 0.005)


def _weights_sql(table, key, text):
    return f"""
        words AS (SELECT {key} AS id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term
                  FROM {table} WHERE {text} IS NOT NULL),
        tf AS (SELECT id, term, count(*) AS tf FROM words GROUP BY id, term),
        n AS (SELECT count(*) AS n FROM {table} WHERE {text} IS NOT NULL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        raw AS (SELECT id, term, tf, df, tf * (ln((1e0 + n) / (1e0 + df)) + 1e0) AS raw
                FROM tf JOIN df USING (term), n WHERE df <= 0.95e0 * n),
        weights AS (SELECT id, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)
    """


def _neighbours_sql(table, key, text, name=None):
    return f"""
        WITH {_weights_sql(table, key, text)},
        pairs AS (SELECT a.id, b.id AS other, round(sum(a.weight * b.weight), 6) AS similarity
                  FROM weights a JOIN weights b ON a.term = b.term AND a.id <> b.id
                  GROUP BY a.id, b.id HAVING sum(a.weight * b.weight) > 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, other) AS rank FROM pairs)
        SELECT id AS {key}, other AS similar_{key}, CAST(rank AS SMALLINT) AS rank, similarity
        FROM ranked WHERE rank <= 3
    """


@plan(f"""
    WITH {_weights_sql('documents', 'doc_id', 'text')}
    SELECT id AS doc_id, term, tf, df, round(weight, 6) AS weight FROM weights
""")
def tfidf_weights(spark, folder):
    weights = tfidf.tfidf_weights(read(spark, folder, "documents"), "doc_id", F.col("text"))
    return weights.withColumn("weight", F.round("weight", 6))


@plan(_neighbours_sql("part", "p_partkey", "p_name || ' ' || p_type || ' ' || p_brand"))
def tfidf_top_n(spark, folder):
    text = scalars.joint_text(F.col("p_name"), F.col("p_type"), F.col("p_brand"))
    return tfidf.tfidf_top_n(read(spark, folder, "part"), "p_partkey", text, 3)


@plan(_neighbours_sql("documents", "doc_id", "text"))
def tfidf_top_n_documents(spark, folder):
    return tfidf.tfidf_top_n(read(spark, folder, "documents"), "doc_id", F.col("text"), 3)
