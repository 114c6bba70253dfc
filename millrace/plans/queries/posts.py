"""Dedup, filters, samples, search and ranking."""

from pyspark.sql import functions as F

from millrace.operators.posts import closest, dedup_recent, filter_any, search, stable_sample, trending
from millrace.plans.queries.registry import query, table


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props FROM events WHERE ts >= TIMESTAMP '2024-01-11 00:00:00'")
def dedup_recent_events(spark, sf_dir):
    """Events that arrive twice, those of the 20 days before the end of January"""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "props")
    once = dedup_recent(e.unionByName(e), "event_id", "ts", "20 days", now="timestamp'2024-01-31 00:00:00'")
    return once.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "props")


@query("""
SELECT doc_id FROM documents
WHERE list_has_any(string_split_regex(lower(text), '[^\\p{L}\\p{N}_#@]+'), ['license', 'copyright'])
   OR list_has_all(string_split_regex(lower(text), '[^\\p{L}\\p{N}_#@]+'), ['que', 'los'])
   OR source IN ('src3', 'src5', 'src7', 'src8')
""")
def documents_by_keyword_or_source(spark, sf_dir):
    """More than a hundred keywords, some with other characters than letters, a phrase of two words, or certain authors"""
    tail = F.expr("CASE source WHEN 'src7' THEN ' c++, too' WHEN 'src8' THEN ' (New-York)' WHEN 'src9' THEN ' c++17 new-yorker' ELSE '' END")
    docs = table(spark, sf_dir, "documents").withColumn("text", F.concat("text", tail))
    rare = [f"neverseen{i}" for i in range(120)]
    return filter_any(docs, "text", [*rare, "c++", "new-york", "license", "Copyright", "los que"], user="source", follow=["src3", "src5"]).select("doc_id")


@query("""
SELECT event_id FROM events
WHERE user_id IN (8, 46) OR (value / 2 - 60 BETWEEN -50 AND -40 AND json_extract_string(props, '$.k')::INT * 3.0 - 150 BETWEEN 20 AND 90)
   OR (value / 2 - 60 BETWEEN -60 AND -55 AND (json_extract_string(props, '$.k')::INT * 3.0 - 150 >= 140 OR json_extract_string(props, '$.k')::INT * 3.0 - 150 <= -140))
""")
def events_by_user_or_box(spark, sf_dir):
    """Users or boxes, one of them across the date line; places are made from the values"""
    places = table(spark, sf_dir, "events").withColumns(_place())
    return filter_any(places, user="user_id", follow=[8, 46], lat="lat", lon="lon", boxes=[(20, -50, 90, -40), (140, -60, -140, -55)]).select("event_id")


def _place():
    return {"lat": F.col("value") / 2 - 60, "lon": F.get_json_object("props", "$.k").cast("int") * F.lit(3.0) - 150}


@query("SELECT event_id, event_type FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 15))::BIGINT < 57646075230342348")
def same_sample_for_everyone(spark, sf_dir):
    """Five percent"""
    return stable_sample(table(spark, sf_dir, "events"), "event_id", 5).select("event_id", "event_type")


@query("""
SELECT doc_id, lang, ((rn - 1) // 20 + 1)::BIGINT AS page
FROM (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents
      WHERE lang = 'en' AND contains(lower(text), 'the') AND contains(lower(text), 'and')) WHERE rn <= 60
""")
def search_documents(spark, sf_dir):
    """Three pages of the longest English documents with two words"""
    found = search(table(spark, sf_dir, "documents"), "And the", lang="en", order=[F.desc("n_chars"), "doc_id"], count=20, page=3)
    return found.select("doc_id", "lang", "page")


@query("""
SELECT event_id, ((rn - 1) // 25 + 1)::BIGINT AS page
FROM (SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id) AS rn
      FROM (SELECT *, value / 2 - 60 AS lat, json_extract_string(props, '$.k')::INT * 3.0 - 150 AS lon FROM events)
      WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
        AND 2 * 6371.0 * asin(sqrt(pow(sin(radians(lat + 55.0) / 2), 2) + cos(radians(lat)) * cos(radians(-55.0)) * pow(sin(radians(lon - 10.0) / 2), 2))) <= 800)
WHERE rn <= 50
""")
def search_near_a_place(spark, sf_dir):
    """The newest events within 800 km of a point"""
    places = table(spark, sf_dir, "events").withColumns(_place())
    found = search(places, since="timestamp_ntz'2024-01-10 00:00:00'", lat="lat", lon="lon", near=(-55.0, 10.0, 800.0), order=[F.desc("ts"), "event_id"], count=25, page=2)
    return found.select("event_id", "page")


@query("""
SELECT day AS window_start, topic, n, rank::INT AS rank FROM (
  SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS topic, count(*) AS n,
         row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY count(*) DESC, event_type) AS rank
  FROM events GROUP BY date_trunc('day', ts), event_type)
WHERE rank <= 3
""")
def trending_types(spark, sf_dir):
    """The three most frequent event types of each day"""
    top = trending(table(spark, sf_dir, "events"), "event_type", "ts", "1 day", 3)
    return top.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "topic", "n", "rank")


@query("""
SELECT event_id, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat + 50.0) / 2), 2) + cos(radians(lat)) * cos(radians(-50.0)) * pow(sin(radians(lon - 20.0) / 2), 2))), 6) AS km
FROM (SELECT *, value / 2 - 60 AS lat, json_extract_string(props, '$.k')::INT * 3.0 - 150 AS lon FROM events)
ORDER BY km, event_id LIMIT 10
""")
def closest_places(spark, sf_dir):
    """The ten places nearest to a point"""
    near = closest(table(spark, sf_dir, "events").withColumns(_place()), "lat", "lon", (-50.0, 20.0), 10, "event_id")
    return near.select("event_id", F.round("distance_km", 6).alias("km"))
