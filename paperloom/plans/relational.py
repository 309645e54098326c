"""Relational and temporal queries that document pipelines lean on, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import table

QUERIES, SQL = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return keep


@query("SELECT n_name, CAST(count(*) AS BIGINT) AS n, round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))), 2)::DOUBLE AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY n_name")
def star_join_aggregate(spark, d):
    li = table(spark, d, "lineitem").filter("l_shipdate >= timestamp '1995-01-01'")
    j = li.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")), 2).cast("double").alias("revenue"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') GROUP BY o_orderpriority")
def semi_anti(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    key = F.col("l_orderkey") == F.col("o_orderkey")
    return o.join(li.filter("l_quantity > 45"), key, "left_semi").join(li.filter("l_returnflag = 'R'"), key, "left_anti").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("(SELECT page_id FROM ocr_words UNION SELECT page_id FROM ocr_pages) EXCEPT (SELECT page_id FROM ocr_words INTERSECT SELECT page_id FROM ocr_exports)")
def set_operations(spark, d):
    w, p, e = (table(spark, d, t).select("page_id") for t in ("ocr_words", "ocr_pages", "ocr_exports"))
    return w.union(p).distinct().subtract(w.intersect(e))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("s"))


@query("SELECT o_orderkey, rank() OVER q AS rank, dense_rank() OVER q AS dense, CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INT) AS quarter, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS before FROM orders WINDOW q AS (PARTITION BY o_custkey ORDER BY o_totalprice)")
def window_rank_analytic(spark, d):
    q = Window.partitionBy("o_custkey").orderBy("o_totalprice")
    r = Window.partitionBy("o_custkey").orderBy("o_totalprice", "o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", F.rank().over(q).cast("long").alias("rank"), F.dense_rank().over(q).cast("long").alias("dense"), F.ntile(4).over(r).alias("quarter"), F.lag("o_orderkey").over(r).alias("before"))


@query("SELECT event_type, time_bucket(INTERVAL 1 hour, ts) AS start, count(*) AS n FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("start"), "n")


@query("SELECT user_id, CAST(s AS BIGINT) AS session, count(*) AS n FROM (SELECT user_id, sum(CASE WHEN b IS NULL OR ts - b >= INTERVAL 30 minute THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)) GROUP BY ALL")
def sessions(spark, d):
    o = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.timestamp_diff("SECOND", F.lag("ts").over(o), F.col("ts"))
    e = table(spark, d, "events").withColumn("new", F.when(gap.isNull() | (gap >= 1800), 1).otherwise(0))
    return e.withColumn("session", F.sum("new").over(o)).groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT a.event_id, b.event_id AS before FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL) b ON a.user_id = b.user_id AND a.ts >= b.ts")
def asof_events(spark, d):
    e = table(spark, d, "events").filter("event_type in ('purchase', 'click')")
    o = Window.partitionBy("user_id").orderBy("ts", F.col("event_type"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("event_type") == "click", F.col("event_id")), ignorenulls=True).over(o)
    return e.withColumn("before", last).filter("event_type = 'purchase'").select("event_id", "before")


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_props_extract(spark, d):
    return table(spark, d, "events").select(F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM orders GROUP BY o_orderstatus")
def pivot_priorities(spark, d):
    p = table(spark, d, "orders").groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).count().na.fill(0)
    return p.select("o_orderstatus", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))


@query("SELECT feed_name, channel, count(p.page_id) AS n_pages FROM scan_feeds f LEFT JOIN (SELECT DISTINCT page_id, feed_id FROM ocr_pages) p ON f.feed_id = p.feed_id GROUP BY ALL")
def pages_by_feed(spark, d):
    p = table(spark, d, "ocr_pages").select("page_id", "feed_id").distinct().groupBy("feed_id").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "scan_feeds").join(p, "feed_id", "left").select("feed_name", "channel", F.coalesce("n", F.lit(0)).alias("n_pages"))
