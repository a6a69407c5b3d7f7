"""Queries on sources, sinks and validation (2.1, 2.2) and on column functions (2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import pair_key, pair_score
from ..functions.numbers import clamp, is_number, ratio, to_number
from ..functions.times import days_between, from_millis, iso_to_timestamp, to_millis, window_floor
from ..operators.drift import categorical_baseline
from ..operators.intake import (
    dead_letters, intake_counts, late_by_clock, unknown_if_null, valid_rows, with_error,
)
from ..operators.late import classify_late, with_late_metadata
from ..sources.files import first_rows, parse_csv_lines, parse_json_events
from ..sources.sinks import as_json
from ..sources.tables import EVENT_COLUMNS, behaviour
from .inputs import ARRIVALS_SQL, FAULTY_SQL, arrivals, faulty_rows, latest_ms
from .registry import query


def _json_lines(spark, folder):
    text = F.to_json(F.struct(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        "event_type", "product_id", "price", "user_id",
    ))
    cut = F.when(F.pmod("event_id", F.lit(50)) == 0, F.expr("substring(_t, 1, length(_t) - 1)")).otherwise(F.col("_t"))
    return behaviour(spark, folder, with_catalog=False).withColumn("_t", text).select("event_id", cut.alias("value"))


@query("s1_json_intake", """
SELECT event_id, event_id % 50 <> 0 AS parsed,
       CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
       CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 50 <> 0 THEN product_id END AS product_id,
       CASE WHEN event_id % 50 <> 0 THEN price END AS price,
       CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id
FROM ev
""")
def s1_json_intake(spark, folder):
    return parse_json_events(_json_lines(spark, folder)).select(
        "event_id", F.col("event").isNotNull().alias("parsed"),
        *[f"event.{c}" for c in ("event_time", "event_type", "product_id", "price", "user_id")],
    )


@query("p1_parse_filter", """
SELECT event_type, count(*) AS events, round(sum(price), 2) AS total
FROM ev WHERE event_id % 50 <> 0 GROUP BY event_type
""")
def p1_parse_filter(spark, folder):
    parsed = parse_json_events(_json_lines(spark, folder)).where(F.col("event").isNotNull())
    return parsed.groupBy("event.event_type").agg(
        F.count("*").alias("events"), F.round(F.sum("event.price"), 2).alias("total")
    )


@query("s2_csv_lines", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time, 'a, "b" ' || brand AS brand,
       CAST(price AS VARCHAR) AS price, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 7 <> 0 THEN 'sess-' || user_id END AS user_session
FROM ev
""")
def s2_csv_lines(spark, folder):
    events = behaviour(spark, folder)
    start = F.concat_ws(
        ",", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "event_type", "product_id", F.lit("1234"),
        "category_code", F.concat(F.lit('"a, ""b"" '), F.col("brand"), F.lit('"')), F.col("price").cast("string"),
    )
    rest = F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit("")).otherwise(
        F.concat(F.lit(","), F.col("user_id"), F.lit(",sess-"), F.col("user_id"))
    )
    surplus = F.when(
        (F.pmod("event_id", F.lit(7)) != 0) & (F.pmod("event_id", F.lit(11)) == 0), F.lit(",x,y")
    ).otherwise(F.lit(""))
    lines = events.select("event_id", F.concat(start, rest, surplus).alias("value"))
    return parse_csv_lines(lines).select(
        "event_id", "event_time", "brand", "price", "user_id", "user_session"
    )


@query("s3_baseline_rows", """
SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN price END AS price
FROM ev ORDER BY event_id LIMIT 10000
""")
def s3_baseline_rows(spark, folder):
    rows = behaviour(spark, folder, with_catalog=False).select(
        "event_id",
        F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit("abc")).otherwise(F.col("price").cast("string"))
        .alias("price"),
    )
    return first_rows(rows, [F.col("event_id")], 10_000)


@query("s4_json_output", """
SELECT to_json({'event_id': event_id, 'user_id': user_id, 'product_id': product_id,
                'score': ('0x' || substr(md5(user_id || '_' || product_id), 1, 8))::BIGINT % 1000 / 1000.0::DOUBLE,
                'reason': 'scored'})::VARCHAR AS value
FROM ev
""")
def s4_json_output(spark, folder):
    scored = behaviour(spark, folder, with_catalog=False).select(
        "event_id", "user_id", "product_id", pair_score(F.col("user_id"), F.col("product_id")).alias("score"),
        F.lit("scored").alias("reason"),
    )
    return as_json(scored)


@query("s5_clean_rows", f"""
WITH {FAULTY_SQL}
SELECT event_id, event_time, event_type, product_id, user_id, user_session,
       CASE WHEN isnan(number) THEN 'NaN' WHEN isinf(number) THEN 'Infinity' ELSE CAST(number AS VARCHAR) END AS price
FROM raw WHERE error IS NULL
""")
def s5_clean_rows(spark, folder):
    return valid_rows(with_error(faulty_rows(spark, folder))).select(
        "event_id", "event_time", "event_type", "product_id", "user_id", "user_session",
        F.col("price").cast("string").alias("price"),
    )


@query("s6_dead_letters", f"""
WITH {FAULTY_SQL}
SELECT event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session, error
FROM raw WHERE error IS NOT NULL
""")
def s6_dead_letters(spark, folder):
    return dead_letters(with_error(faulty_rows(spark, folder))).select(*EVENT_COLUMNS, "error")


@query("s7_baseline_json", """
WITH shares AS (
  SELECT 'event_type' AS col, event_type AS val, count(*) / sum(count(*)) OVER () AS share FROM ev GROUP BY 2
  UNION ALL
  (SELECT 'category_code', coalesce(category_code, 'unknown'), count(*) / sum(count(*)) OVER () FROM ev GROUP BY 2
   ORDER BY count(*) DESC, 2 LIMIT 20)
  UNION ALL
  (SELECT 'brand', coalesce(brand, 'unknown'), count(*) / sum(count(*)) OVER () FROM ev GROUP BY 2
   ORDER BY count(*) DESC, 2 LIMIT 20)
)
SELECT to_json({'column': col, 'value': val, 'share': round(share, 6)})::VARCHAR AS value FROM shares
""")
def s7_baseline_json(spark, folder):
    shares = categorical_baseline(behaviour(spark, folder))
    return as_json(shares.select("column", "value", F.round("share", 6).alias("share")))


@query("p2_validation", f"WITH {FAULTY_SQL} SELECT event_id, error FROM raw")
def p2_validation(spark, folder):
    return with_error(faulty_rows(spark, folder)).select("event_id", "error")


@query("p3_split_counts", f"""
WITH {FAULTY_SQL}
SELECT count(*) AS processed, count(*) FILTER (error IS NULL) AS valid, count(error) AS rejected FROM raw
""")
def p3_split_counts(spark, folder):
    return intake_counts(with_error(faulty_rows(spark, folder)))


@query("p4_score_threshold", """
WITH scored AS (
  SELECT event_id, ('0x' || substr(md5(user_id || '_' || product_id), 1, 8))::BIGINT % 1000 / 1000.0::DOUBLE AS score
  FROM ev)
SELECT event_id, score FROM scored WHERE score >= 0.3
""")
def p4_score_threshold(spark, folder):
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", pair_score(F.col("user_id"), F.col("product_id")).alias("score")
    ).where(F.col("score") >= 0.3)


@query("p5_unknown_values", """
SELECT coalesce(nullif(category_code, 'PROMO'), 'unknown') AS category_code,
       coalesce(nullif(brand, 'Brand#1'), 'unknown') AS brand, count(*) AS events
FROM ev GROUP BY 1, 2
""")
def p5_unknown_values(spark, folder):
    holes = behaviour(spark, folder).select(
        F.nullif("category_code", F.lit("PROMO")).alias("category_code"),
        F.nullif("brand", F.lit("Brand#1")).alias("brand"),
    )
    return holes.groupBy(
        unknown_if_null("category_code").alias("category_code"), unknown_if_null("brand").alias("brand")
    ).agg(F.count("*").alias("events"))


@query("p6_event_hour", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour FROM ev")
def p6_event_hour(spark, folder):
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", F.hour("event_time").alias("event_hour")
    )


@query("p7_late_by_clock", """
SELECT event_type, count(*) FILTER (ts < (SELECT max(ts) FROM ev) - INTERVAL 1 HOUR) AS late_events,
       count(*) AS events
FROM ev GROUP BY event_type
""")
def p7_late_by_clock(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    now = events.agg(F.max("event_time").alias("now")).scalar()
    return events.withColumn("_late", late_by_clock("event_time", now)).groupBy("event_type").agg(
        F.count_if("_late").alias("late_events"), F.count("*").alias("events")
    )


@query("p8_late_metadata", f"""
WITH {ARRIVALS_SQL}
SELECT event_id, late_class,
       CASE WHEN late_class = 'moderate' THEN 'true' END AS late_processed,
       CASE WHEN late_class = 'moderate' THEN CAST(ts_ms AS VARCHAR) END AS original_timestamp,
       CASE WHEN late_class = 'moderate' THEN CAST(arrival_ms AS VARCHAR) END AS processed_timestamp,
       CASE WHEN late_class = 'very_late' THEN 'true' END AS very_late,
       CASE WHEN late_class = 'very_late' THEN 'true' END AS discarded_from_windows,
       delay_seconds
FROM classified WHERE late_class IN ('moderate', 'very_late')
""")
def p8_late_metadata(spark, folder):
    classified = classify_late(arrivals(spark, folder)).where("late_class in ('moderate', 'very_late')")
    late = with_late_metadata(classified, F.col("arrival_ms"))
    named = ["late_processed", "original_timestamp", "processed_timestamp", "very_late", "discarded_from_windows"]
    return late.select(
        "event_id", "late_class", *[F.try_element_at("metadata", F.lit(n)).alias(n) for n in named],
        F.try_element_at("metadata", F.lit("delay_seconds")).cast("double").alias("delay_seconds"),
    )


@query("f1_json_functions", """
SELECT event_id, product_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"k":' || product_id || '}' AS again
FROM events JOIN ev USING (event_id)
""")
def f1_json_functions(spark, folder):
    from ..sources.tables import table

    parsed = F.from_json("props", "k long")
    return table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("product_id"), parsed["k"].alias("k"),
        F.to_json(parsed).alias("again"),
    )


@query("f2_time_functions", """
SELECT event_id, ts_ms, ts_ms - ts_ms % 60000 AS minute_ms, epoch_ms(date_trunc('second', ts)) AS iso_ms,
       ((SELECT max(ts_ms) FROM ev) - ts_ms) / 86400000.0::DOUBLE AS days_ago
FROM ev
""")
def f2_time_functions(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    iso = iso_to_timestamp(F.date_format(from_millis(F.col("ts_ms")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return events.select(
        "event_id", to_millis(F.col("event_time")).alias("ts_ms"),
        window_floor(F.col("ts_ms"), 60_000).alias("minute_ms"), to_millis(iso).alias("iso_ms"),
        days_between(F.col("ts_ms"), latest_ms(events)).alias("days_ago"),
    )


@query("f3_math_functions", """
SELECT event_id, round(sqrt(price), 6) AS root, round(ln(price + 1), 6) AS logarithm,
       greatest(least(price / 100, 1.0), 0.0) AS clamped, coalesce(100 / nullif(price, 0), 0.0) AS share
FROM ev
""")
def f3_math_functions(spark, folder):
    price = F.col("price")
    return behaviour(spark, folder, with_catalog=False).select(
        "event_id", F.round(F.sqrt(price), 6).alias("root"), F.round(F.ln(price + 1), 6).alias("logarithm"),
        clamp(price / 100.0).alias("clamped"), ratio(F.lit(100.0), price).alias("share"),
    )


@query("f4_set_functions", """
SELECT user_id, array_to_string(list_sort(list_distinct(list(product_id))), ',') AS products,
       len(list_distinct(list(product_id))) AS products_seen,
       array_to_string(list_sort(list_distinct(list(product_id)))[1:3], ',') AS first_three
FROM ev GROUP BY user_id
""")
def f4_set_functions(spark, folder):
    events = behaviour(spark, folder, with_catalog=False)
    viewed = F.collect_set(F.when(F.col("event_type") == "view", F.col("product_id")))
    other = F.collect_set(F.when(F.col("event_type") != "view", F.col("product_id")))
    both = F.array_sort(F.array_union(viewed, other))
    return events.groupBy("user_id").agg(both.alias("_p")).select(
        "user_id", F.array_join("_p", ",").alias("products"), F.size("_p").cast("long").alias("products_seen"),
        F.array_join(F.slice("_p", 1, 3), ",").alias("first_three"),
    )


@query("f5_key_functions", """
SELECT event_id, user_id || ':' || product_id AS pair, CASE WHEN event_id % 3 = 0 THEN NULL ELSE price END AS number,
       event_id % 3 <> 0 AS numeric
FROM ev
""")
def f5_key_functions(spark, folder):
    text = F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    return behaviour(spark, folder, with_catalog=False).withColumn("_text", text).select(
        "event_id", pair_key(F.col("user_id"), F.col("product_id")).alias("pair"),
        to_number(F.col("_text")).alias("number"), is_number(F.col("_text")).alias("numeric"),
    )
