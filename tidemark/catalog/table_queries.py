"""Distinct rows, numbering, sets, arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from .registry import query
from .views import AS_OF, AS_OF_SQL, Views, with_views


@query("dedupe_keep_first", "SELECT min(doc_id) AS doc_id, n_chars, text FROM documents GROUP BY text, n_chars")
def _(v: Views) -> DataFrame:
    return op.dedupe_keep_first(v.table("documents").select("doc_id", "n_chars", "text"), ["text"], ["doc_id"])


@query("distinct_values", "SELECT DISTINCT user_id FROM events")
def _(v: Views) -> DataFrame:
    return op.distinct_values(v.ev(), "user_id")


@query("last_wins_map", """
    SELECT p_name, max(p_partkey) AS p_partkey, arg_max(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_name""")
def _(v: Views) -> DataFrame:
    return op.last_wins_map(v.table("part").select("p_name", "p_partkey", "p_brand"), "p_name", "p_partkey")


@query("split_counts", with_views("mentions", """
    SELECT (SELECT count(*) FROM documents) AS n_posts,
           (SELECT CAST(sum(len(user_mentions)) AS BIGINT) FROM mentions) AS n_mentions,
           (SELECT count(*) FROM pages) AS n_urls"""))
def _(v: Views) -> DataFrame:
    mentions = v.mentions().select("status_id", F.explode("user_mentions"))
    return op.split_counts(v.table("documents"), mentions, op.explode_urls(v.page_urls()))


@query("assert_unique", "SELECT text, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1")
def _(v: Views) -> DataFrame:
    return op.assert_unique(v.table("documents"), ["text"])


@query("factorize_mod_edges", """
    SELECT o_orderkey, CAST(c % 12 AS BIGINT) AS "ColorInt" FROM orders JOIN (
        SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) AS c FROM orders GROUP BY o_custkey)
    USING (o_custkey)""")
def _(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_orderkey", "o_custkey")
    return op.factorize_mod_edges(rows, "o_custkey", "o_orderkey").select("o_orderkey", "ColorInt")


@query("factorize_mod_nodes", """
    SELECT c_custkey, CAST((c - 1) % 12 AS BIGINT) AS "Color2" FROM customer JOIN (
        SELECT c_mktsegment, row_number() OVER (ORDER BY min(c_custkey)) AS c FROM customer GROUP BY 1)
    USING (c_mktsegment) WHERE c_custkey > (SELECT min(c_custkey) FROM customer)""")
def _(v: Views) -> DataFrame:
    return op.factorize_mod_nodes(v.table("customer"), "c_mktsegment", "c_custkey").select("c_custkey", "Color2")


@query("drop_first_row",
       "SELECT p_partkey, p_name FROM part WHERE p_partkey > (SELECT min(p_partkey) FROM part)")
def _(v: Views) -> DataFrame:
    return op.drop_first_row(v.table("part").select("p_partkey", "p_name"), "p_partkey")


@query("chunk_rows", """
    SELECT o_orderkey, r - 1 AS row_no, CAST((r - 1) // 1000 AS BIGINT) AS batch_no
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders)""")
def _(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_orderkey", "o_orderdate")
    return op.chunk_rows(rows, [F.desc("o_orderdate"), "o_orderkey"], 1000).drop("o_orderdate")


@query("page_ranges", """
    SELECT c_nationkey, n, unnest(generate_series(1, n, 25)) AS page_from,
           unnest(generate_series(1, n, 25)) + 24 AS page_to
    FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)""")
def _(v: Views) -> DataFrame:
    counts = v.table("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return op.page_ranges(counts, "n", 25)


@query("rolling_rate", """
    SELECT event_id, event_type, sum(k) OVER w / sum(ms) OVER w AS rate,
           CAST(sum(k) OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS total
    FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                 CAST(round(value * 100) AS BIGINT) + 1 AS ms FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def _(v: Views) -> DataFrame:
    rows = v.ev_typed().select(
        "event_id", "event_type", "k", (F.round(F.col("value") * 100).cast("bigint") + 1).alias("ms")
    )
    return op.rolling_rate(rows, "event_type", "event_id", "ms", "k").select(
        "event_id", "event_type", "rate", "total"
    )


@query("union_by_name_fill", """
    SELECT CAST(c_custkey AS VARCHAR) AS trial_id, c_name AS name, c_mktsegment AS segment, '' AS nation
    FROM customer
    UNION ALL
    SELECT CAST(s_suppkey + 1450 AS VARCHAR), s_name, '', CAST(s_nationkey AS VARCHAR) FROM supplier
    WHERE s_suppkey + 1450 NOT IN (SELECT c_custkey FROM customer)""")
def _(v: Views) -> DataFrame:
    first = v.table("customer").select(
        F.col("c_custkey").alias("trial_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    second = v.table("supplier").select(
        (F.col("s_suppkey") + 1450).alias("trial_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    return op.union_by_name_fill(first, second, "trial_id", "name")


@query("concat_same_schema", "SELECT event_id, user_id FROM events")
def _(v: Views) -> DataFrame:
    e = v.ev().select("event_id", "user_id", "ts")
    middle = F.lit("2024-01-15").cast("timestamp")
    return op.concat_same_schema(e.where(F.col("ts") < middle), e.where(F.col("ts") >= middle)).drop("ts")


@query("terms_union_all", "SELECT lower(p_name) AS term FROM part UNION ALL SELECT lower(p_type) FROM part")
def _(v: Views) -> DataFrame:
    return op.terms_union_all(v.table("part").select("p_name"), v.table("part").select("p_type"))


_SYNONYM_ROWS = r"""
    SELECT p_partkey AS row_no, lower(p_name) AS name, unnest([lower(regexp_extract(p_name, '\S+$')),
           lower(p_brand), lower(p_name), 'ab']) AS synonym FROM part"""


@query("split_synonyms", f"""
    SELECT row_no, name, string_agg(synonym, '|') AS synonyms
    FROM (SELECT row_no, name, unnest([noun, brand]) AS synonym FROM (
        SELECT p_partkey AS row_no, lower(p_name) AS name, lower(p_brand) AS brand,
               lower(regexp_extract(p_name, '\\S+$')) AS noun FROM part))
    WHERE synonym <> name AND length(synonym) >= 3 GROUP BY row_no, name""")
def _(v: Views) -> DataFrame:
    return op.split_synonyms(v.drug_words(), "Common name", "Synonyms").select(
        "row_no", "name", F.array_join("synonyms", "|").alias("synonyms")
    )


@query("drug_synonym_edges", f"""
    SELECT name AS drug, synonym FROM ({_SYNONYM_ROWS})
    WHERE synonym <> name AND length(synonym) >= 3""")
def _(v: Views) -> DataFrame:
    return op.drug_synonym_edges(op.split_synonyms(v.drug_words(), "Common name", "Synonyms"))


@query("study_url_edges", with_views("studies", "SELECT study_url, trial_id FROM studies"))
def _(v: Views) -> DataFrame:
    return op.study_url_edges(op.flatten_trials(v.trials()))


@query("flatten_trials", with_views("studies", "SELECT * FROM studies"))
def _(v: Views) -> DataFrame:
    return op.flatten_trials(v.trials())


@query("explode_mentions", """
    SELECT l_orderkey AS tweet_id, m.id AS user_id, m.k || m.id AS user_name, '@' || m.k || m.id AS user_screen_name,
           'job' AS job_name, CAST(NULL AS VARCHAR) AS job_id
    FROM (SELECT l_orderkey, unnest([{'k': 's', 'id': l_suppkey}, {'k': 'p', 'id': l_partkey}]) AS m FROM lineitem)""")
def _(v: Views) -> DataFrame:
    return op.explode_mentions(v.items(), "job")


@query("scraped_mentions", with_views("mentions", """
    SELECT status_id AS tweet_id, array_to_string(user_mentions, ' ') AS names, 'job' AS job_name FROM mentions"""))
def _(v: Views) -> DataFrame:
    return op.scraped_mentions(v.mentions(), "job").select(
        "tweet_id", F.array_join("user_screen_name", " ").alias("names"), "job_name"
    )


@query("explode_urls", with_views("page_parts", """
    SELECT page_id AS tweet_id, url AS full_url, 'job' AS job_name, scheme AS "schema",
           lower(address) AS hostname, path, nullif(query, '') AS query
    FROM page_parts
    UNION ALL SELECT page_id, 'http://x.example:8080/p', 'job', 'http', 'x.example', '/p', NULL FROM page_parts"""))
def _(v: Views) -> DataFrame:
    two = v.page_urls().withColumn("urls", F.concat("urls", F.array(F.lit("http://x.example:8080/p"))))
    return op.explode_urls(two, "job").select(
        "tweet_id", "full_url", "job_name", "schema", "hostname", "path", "query"
    )


@query("first_url", with_views("page_parts", """
    SELECT page_id AS tweet_id, url AS full_url, address AS netloc FROM page_parts"""))
def _(v: Views) -> DataFrame:
    two = v.page_urls().withColumn("urls", F.concat("urls", F.array(F.lit("http://x.example/p"))))
    none = v.table("documents").select(
        (-F.col("doc_id")).alias("status_id"), F.array().cast("array<string>").alias("urls")
    )
    return op.first_url(two.unionByName(none)).select("tweet_id", "full_url", "netloc")


@query("url_columns", with_views("page_parts", f"""
    SELECT page_id AS tweet_id, url AS full_url, 'job' AS job_name, scheme AS "schema", netloc,
           nullif(path, '') AS path, '' AS params, nullif(query, '') AS query,
           nullif(fragment, '') AS fragment, CAST(NULL AS VARCHAR) AS username,
           CAST(NULL AS VARCHAR) AS password, lower(address) AS hostname, CAST(NULL AS INTEGER) AS port,
           epoch_us({AS_OF_SQL}) AS record_created_us
    FROM page_parts"""))
def _(v: Views) -> DataFrame:
    rows = op.url_columns(op.first_url(v.page_urls(), "job"), AS_OF)
    return rows.withColumn("record_created_us", F.unix_micros("record_created_at")).drop("record_created_at")


@query("account_columns", f"""
    SELECT c_mktsegment AS location, c_name AS name, epoch_us({AS_OF_SQL}) AS record_created_us,
           'u' || c_custkey AS screen_name, c_nationkey AS friends_count, c_custkey AS followers_count,
           'job' AS job_name
    FROM customer""")
def _(v: Views) -> DataFrame:
    profiles = v.table("customer").select(
        F.col("c_mktsegment").alias("location"), F.col("c_name").alias("name"),
        F.concat(F.lit("u"), "c_custkey").alias("username"),
        F.col("c_nationkey").alias("following"), F.col("c_custkey").alias("followers"),
    )
    rows = op.account_columns(profiles, "job", AS_OF)
    return rows.withColumn("record_created_us", F.unix_micros("record_created_at")).drop("record_created_at")


@query("phrase_query", with_views("vocab", """
    SELECT CAST((r - 1) // 20 AS BIGINT) AS batch_no, string_agg('"' || term || '"', ' OR ' ORDER BY r) AS query
    FROM (SELECT term, row_number() OVER (ORDER BY term) AS r FROM vocab) GROUP BY 1"""))
def _(v: Views) -> DataFrame:
    return op.phrase_query(v.vocab(), "term")
