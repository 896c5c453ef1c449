"""Column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from .registry import query
from .views import Views, with_views


@query("snowflake_time", with_views("ev_ids", """
    SELECT event_id, id, epoch_us(ts) // 1000 AS ms FROM ev_ids JOIN events USING (event_id)"""))
def _(v: Views) -> DataFrame:
    return v.ev_ids().withColumn("ms", fn.snowflake_time(F.col("id")))


@query("snowflake_machine", with_views("ev_ids", """
    SELECT event_id, user_id % 1024 AS machine FROM ev_ids JOIN events USING (event_id)"""))
def _(v: Views) -> DataFrame:
    return v.ev_ids().select("event_id", fn.snowflake_machine(F.col("id")).alias("machine"))


@query("snowflake_sequence", with_views("ev_ids", """
    SELECT event_id, event_id % 4096 AS sequence FROM ev_ids"""))
def _(v: Views) -> DataFrame:
    return v.ev_ids().select("event_id", fn.snowflake_sequence(F.col("id")).alias("sequence"))


@query("snowflake_id_range", f"""
    SELECT e.event_id, ((epoch_us(e.ts) // 1000 - 1288834974657) << 22) | (CAST(m.machine AS BIGINT) << 12) AS id
    FROM events e, (SELECT unnest({list(fn.MACHINE_IDS)}) AS machine) m""")
def _(v: Views) -> DataFrame:
    """Candidate ids of the millisecond of every event."""
    spans = v.ev().select(
        "event_id", F.unix_millis("ts").alias("begin_ms"), (F.unix_millis("ts") + 1).alias("end_ms")
    )
    return fn.expand_snowflake_ids(spans, "begin_ms", "end_ms").select("event_id", "id")


@query("clean_file_name", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_-]', '', 'g') AS name FROM pages")
def _(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", fn.clean_file_name(F.col("url")).alias("name"))


@query("default_job_name", """
    SELECT doc_id, 'search_' || substring(text, 1, 20) AS job,
           'user_timeline_2_' || lang || '_' || source AS list_job
    FROM documents""")
def _(v: Views) -> DataFrame:
    return v.table("documents").select(
        "doc_id", fn.default_job_name("search", F.col("text")).alias("job"),
        fn.default_list_job_name("user_timeline", F.array("lang", "source")).alias("list_job"),
    )


@query("extract_mentions", with_views("mentions", """
    SELECT status_id, array_to_string(user_mentions, ' ') AS found FROM mentions"""))
def _(v: Views) -> DataFrame:
    return v.mentions().select("status_id", F.array_join("user_mentions", " ").alias("found"))


# Written apart from the package: candidates are cut at blanks, quotes and brackets, stripped of
# closing points, and judged by their start and the last label of their host. The hosts of these
# tables end in com, net, org, or two letters.
@query("extract_urls", r"""
    WITH t AS (
      SELECT d.doc_id, d.text || ' ' || COALESCE(p.url, '') || ' bit.ly/a' || doc_id || ' (youtu.be/x) cbc.ca a.b@c.de' AS t
      FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id),
    cut AS (SELECT doc_id, string_split_regex(t, '[[:space:]<>"''()\[\]{}]+') AS pieces FROM t),
    found AS (
      SELECT doc_id, flatten([regexp_extract_all(x, '(?i)(?:https?://|www[.]).+|(?:[a-z0-9._%+-]+@)?(?:[a-z0-9-]+[.])+[a-z]{2,}(?:[/?#:].*)?')
                              FOR x IN pieces IF contains(x, '.') OR contains(x, '://')]) AS us FROM cut),
    trimmed AS (SELECT doc_id, [rtrim(u, '.,;:!?') FOR u IN us] AS us FROM found)
    SELECT doc_id, array_to_string([u FOR u IN us IF
             lower(u) LIKE 'http://%' OR lower(u) LIKE 'https://%' OR lower(u) LIKE 'www.%'
             OR (NOT contains(regexp_extract(u, '^[^/?#:]*'), '@')
                 AND (length(regexp_extract(u, '^[^/?#:]*[.]([^/?#:.]*)', 1)) = 2
                      OR lower(regexp_extract(u, '^[^/?#:]*[.]([^/?#:.]*)', 1)) IN ('com', 'net', 'org')))], ' ') AS found
    FROM trimmed""")
def _(v: Views) -> DataFrame:
    text = F.concat(
        "text", F.lit(" "), F.coalesce("url", F.lit("")), F.lit(" bit.ly/a"), F.col("doc_id").cast("string"),
        F.lit(" (youtu.be/x) cbc.ca a.b@c.de"))
    rows = v.table("documents").join(
        v.table("pages").select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left"
    )
    return rows.select("doc_id", F.array_join(fn.extract_urls(text), " ").alias("found"))


@query("normalize_hashtags", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag <> 'N' THEN l_returnflag || ',' || l_linestatus END AS tags
    FROM lineitem""")
def _(v: Views) -> DataFrame:
    tags = fn.normalize_hashtags(fn.wrap_hashtags(F.col("tags")))
    return v.items().select("l_orderkey", "l_linenumber", tags.alias("tags"))


@query("wrap_hashtags", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '[]' ELSE
             '[{"text":"' || l_returnflag || '"},{"text":"' || l_linestatus || '"}]' END AS tags
    FROM lineitem""")
def _(v: Views) -> DataFrame:
    return v.items().select(
        "l_orderkey", "l_linenumber", F.to_json(fn.wrap_hashtags(F.col("tags"))).alias("tags")
    )


@query("parse_url_parts", with_views("page_parts", """
    SELECT page_id, nullif(scheme, '') AS "schema", nullif(netloc, '') AS netloc, nullif(path, '') AS path,
           '' AS params, nullif(query, '') AS query, nullif(fragment, '') AS fragment,
           nullif(regexp_extract(userinfo, '^([^:]*)', 1), '') AS username,
           nullif(regexp_extract(userinfo, '^[^:]*:(.*)$', 1), '') AS password,
           nullif(lower(regexp_extract(address, '^([^:]*)', 1)), '') AS hostname,
           TRY_CAST(nullif(regexp_extract(address, ':([0-9]+)$', 1), '') AS INTEGER) AS port
    FROM page_parts"""))
def _(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", fn.parse_url_parts(F.col("url")).alias("p")).select(
        "page_id", "p.*"
    )


@query("parse_url_blank", with_views("page_parts", """
    SELECT page_id, '' AS tweet_id, '' AS job_id, '' AS job_name, url, scheme AS "schema", netloc,
           regexp_replace(path, ';[^/]*$', '') AS path, regexp_extract(path, ';([^/]*)$', 1) AS params,
           query, fragment, regexp_extract(userinfo, '^([^:]*)', 1) AS username,
           regexp_extract(userinfo, '^[^:]*:(.*)$', 1) AS password,
           lower(regexp_extract(address, '^([^:]*)', 1)) AS hostname,
           regexp_extract(address, ':([0-9]+)$', 1) AS port
    FROM page_parts"""))
def _(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", fn.parse_url_blank(F.col("url")).alias("p")).select(
        "page_id", "p.*"
    )


@query("epoch_seconds", "SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS seconds FROM events")
def _(v: Views) -> DataFrame:
    return v.ev().select("event_id", fn.epoch_seconds(F.col("ts")).alias("seconds"))


@query("millis_to_timestamp", "SELECT event_id, epoch_us(ts) // 1000 * 1000 AS us FROM events")
def _(v: Views) -> DataFrame:
    ts = fn.millis_to_timestamp(F.unix_millis("ts"))
    return v.ev().select("event_id", F.unix_micros(ts).alias("us"))


@query("to_json_string", """
    SELECT event_id, CAST(user_id AS VARCHAR) AS scalar, '"' || event_type || '"' AS quoted,
           '{"user_id":' || user_id || ',"kind":' ||
             CASE WHEN event_type = 'error' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS nested,
           CASE WHEN event_type <> 'view' THEN '[' || user_id || ']' END AS maybe
    FROM events""")
def _(v: Views) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return v.ev().select(
        "event_id", fn.to_json_string(F.col("user_id")).alias("scalar"),
        fn.to_json_string(F.col("event_type")).alias("quoted"),
        fn.to_json_string(F.struct("user_id", kind.alias("kind"))).alias("nested"),
        fn.to_json_string(F.when(F.col("event_type") != "view", F.array("user_id"))).alias("maybe"),
    )


@query("lower_trim", "SELECT p_partkey, lower(p_name) AS name FROM part")
def _(v: Views) -> DataFrame:
    padded = F.concat(F.lit(" \t "), F.upper("p_name"), F.lit("\n "))
    return v.table("part").select("p_partkey", fn.lower_trim(padded).alias("name"))


@query("study_url_from_id", """
    SELECT o_orderkey, 'https://clinicaltrials.gov/show/NCT' || o_orderkey AS study_url FROM orders""")
def _(v: Views) -> DataFrame:
    trial = F.concat(F.lit("NCT"), "o_orderkey")
    return v.table("orders").select("o_orderkey", fn.study_url_from_id(trial).alias("study_url"))


@query("link_urls", """
    SELECT page_id, '<a href="' || url || '" target="_blank">' || url || '</a> ' ||
           '<a href="http://b.example" target="_blank">http://b.example</a>' AS html
    FROM pages""")
def _(v: Views) -> DataFrame:
    two = F.concat_ws(" ", "url", F.lit("http://b.example"))
    return v.table("pages").select("page_id", fn.link_urls(two).alias("html"))


@query("embed_img", """
    SELECT page_id, CASE WHEN page_id % 3 = 2 THEN
             '<a href="' || url || '" target="_blank"><img src="' || url || '"/></a>' ELSE '' END AS html
    FROM pages""")
def _(v: Views) -> DataFrame:
    image = F.when(F.col("page_id") % 3 == 2, F.col("url")).when(F.col("page_id") % 3 == 1, "")
    return v.table("pages").select("page_id", fn.embed_img(image).alias("html"))


@query("menu_anchor", """
    SELECT page_id, '<a href="' || url || '" target="_blank">page ' || page_id || '</a>' AS html FROM pages""")
def _(v: Views) -> DataFrame:
    label = F.concat(F.lit("page "), "page_id")
    return v.table("pages").select("page_id", fn.menu_anchor(F.col("url"), label).alias("html"))
