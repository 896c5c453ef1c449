"""The given tables seen as posts, stores, vocabularies and trials, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract_mentions, snowflake_id
from ..session import work_dir

AS_OF = "2024-02-01 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


# Single words, pairs and fours of the vocabulary view.
TERMS = ("[a-z]{3,}", "[a-z]+ [a-z]+", "[a-z]+ [a-z]+ [a-z]+ [a-z]+")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def new_path(self, label: str) -> str:
        return work_dir(self.spark, label)

    def posts(self) -> DataFrame:
        root = F.col("conv_id") * 1000 + 1
        return self.table("conversations").select(
            (root + F.col("turn")).alias("status_id"),
            root.alias("conversation_id"),
            F.when(F.col("turn") > 0, root + F.col("turn") - 1).otherwise(0).alias("reply_to"),
            F.col("role").alias("user_name"),
            F.col("text").alias("full_text"),
        )

    def raw_posts(self) -> DataFrame:
        """Posts as they arrive, with few columns."""
        return self.posts().select(
            F.col("status_id").alias("id"),
            F.col("status_id").cast("string").alias("id_str"),
            "full_text",
            F.col("reply_to").alias("in_reply_to_status_id"),
            F.struct(
                F.length("user_name").cast("bigint").alias("id"), F.col("user_name").alias("screen_name")
            ).alias("user"),
        )

    def post_rows(self) -> DataFrame:
        """Posts in the columns of a graph batch."""
        return self.posts().select(
            F.col("status_id").alias("tweet_id"),
            F.length("user_name").cast("bigint").alias("user_id"),
            F.when(F.col("reply_to") > 0, "REPLY").otherwise("TWEET").alias("tweet_type"),
            F.col("reply_to").alias("reply_tweet_id"),
            F.lit(None).cast("bigint").alias("quoted_status_id"),
            F.lit(None).cast("bigint").alias("retweet_id"),
            F.lit("posts").alias("job_name"), F.lit(None).cast("string").alias("job_id"),
            F.col("full_text").alias("text"),
        )

    def hyd(self) -> DataFrame:
        status = F.when(F.col("quality") == 1, "FULL").when(F.col("quality") == 0, "PARTIAL")
        return self.table("documents").join(self.table("labels"), "doc_id", "left").select(
            F.col("doc_id").alias("id"), status.alias("hydrated")
        )

    def stored(self) -> DataFrame:
        """The store proper: only labelled documents."""
        return self.hyd().where(F.col("hydrated").isNotNull())

    def ev(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def ev_typed(self) -> DataFrame:
        """Events with post types: errors quote, clicks share, k above 50 answers."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        return self.ev().withColumns({
            "k": k,
            "is_quote_status": F.col("event_type") == "error",
            "retweeted": F.col("event_type") == "click",
            "in_reply_to_status_id": F.when(k > 50, k),
        })

    def ev_ids(self) -> DataFrame:
        ms = F.unix_millis("ts")
        return self.ev().select(
            "event_id",
            snowflake_id(ms, F.col("user_id") % 1024, F.col("event_id") % 4096).alias("id"),
        )

    def ev_edges(self) -> DataFrame:
        """Events as a graph batch: errors quote and clicks share the event before."""
        before = F.when(F.col("event_id") > 0, F.col("event_id") - 1)
        return self.ev().select(
            F.col("event_id").alias("tweet_id"), "user_id",
            F.when(F.col("event_type") == "error", "QUOTE_RETWEET")
            .when(F.col("event_type") == "click", "RETWEET").otherwise("TWEET").alias("tweet_type"),
            F.lit(None).cast("bigint").alias("reply_tweet_id"),
            before.alias("quoted_status_id"), before.alias("retweet_id"),
            F.lit("events").alias("job_name"), F.lit(None).cast("string").alias("job_id"),
        )

    def vocab(self) -> DataFrame:
        """Words, and terms of two and of four words, of whole texts."""
        text = F.lower("text")
        found = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in TERMS]
        return self.table("benchmark").select(F.explode(F.concat(*found)).alias("term")).distinct()

    def topics(self) -> DataFrame:
        """Each term under the topic of its length."""
        return self.vocab().select(
            F.concat(F.lit("t"), F.length("term") % 3).alias("topic"), F.col("term").alias("phrase")
        )

    def mentions(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("status_id"), extract_mentions(F.col("text")).alias("user_mentions")
        )

    def order_mentions(self) -> DataFrame:
        """Orders as posts that mention suppliers."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("tweet_id"), F.col("l_suppkey").alias("user_id"),
            F.concat(F.lit("s"), "l_suppkey").alias("user_name"),
            F.concat(F.lit("@s"), "l_suppkey").alias("user_screen_name"),
            F.lit("orders").alias("job_name"), F.lit(None).cast("string").alias("job_id"),
        )

    def page_urls(self) -> DataFrame:
        return self.table("pages").select(
            F.col("page_id").alias("status_id"), F.array("url").alias("urls")
        )

    def items(self) -> DataFrame:
        """Order lines as posts with short lists: two tags (none for flag N), two links, two accounts."""
        tags = F.array("l_returnflag", "l_linestatus")
        account = [
            F.struct(F.col(c).alias("id"), F.concat(F.lit(c[2]), c).alias("name"),
                     F.concat(F.lit("@" + c[2]), c).alias("screen_name"))
            for c in ("l_suppkey", "l_partkey")
        ]
        return self.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_orderkey").alias("status_id"),
            F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(tags).alias("tags"),
            F.array(F.concat(F.lit("http://p/"), "l_partkey"), F.concat(F.lit("http://s/"), "l_suppkey"))
            .alias("links"),
            F.array(*account).alias("user_mentions"),
        )

    def trials(self) -> DataFrame:
        """Orders as result pages of two studies each: one in full, whose arms are a part (missing for
        every fifth order), and one with little more than its id."""
        arm = [
            F.struct(F.struct(F.array(n).alias("ArmGroupInterventionName")).alias("ArmGroupInterventionList"))
            for n in (F.concat_ws(", ", "p_name", "p_brand"), F.col("p_type"))
        ]
        arms = F.when(F.col("p_name").isNotNull() & (F.col("o_orderkey") % 5 != 0), F.struct(
            F.struct(F.array(*arm).alias("ArmGroup")).alias("ArmGroupList")))

        def study(prefix: str, official: Column, arms: Column, design: Column) -> Column:
            return F.struct(F.struct(F.struct(
                F.struct(
                    F.concat(F.lit(prefix), "o_orderkey").alias("NCTId"),
                    official.alias("OfficialTitle"),
                    F.concat(F.lit("Brief "), "o_orderpriority").alias("BriefTitle"),
                ).alias("IdentificationModule"),
                arms.alias("ArmsInterventionsModule"), design.alias("DesignModule"),
            ).alias("ProtocolSection")).alias("Study"))

        design = F.struct(
            F.col("o_orderstatus").alias("StudyType"),
            F.struct(F.col("o_custkey").cast("string").alias("EnrollmentCount")).alias("EnrollmentInfo"),
        )
        title = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("Official "), "o_orderpriority"))
        parts = self.table("part").select(F.col("p_partkey").alias("o_custkey"), "p_name", "p_brand", "p_type")
        both = F.array(
            study("NCT", title, arms, design),
            study("NCX", F.lit(None).cast("string"), F.when(F.lit(False), arms), F.when(F.lit(False), design)),
        )
        return self.table("orders").join(parts, "o_custkey", "left").select(F.struct(
            F.lit(2).cast("bigint").alias("NStudiesFound"), both.alias("FullStudies")
        ).alias("FullStudiesResponse"))

    def intl(self) -> DataFrame:
        """Every fourth order as a study of an international list; every twelfth under the id of a national one."""
        parts = self.table("part").select(F.col("p_partkey").alias("o_custkey"), "p_name", "p_type")
        prefix = F.when(F.col("o_orderkey") % 3 == 0, "NCT").otherwise("ISRCTN")
        return self.table("orders").where(F.col("o_orderkey") % 4 == 0).join(parts, "o_custkey", "left").select(
            F.concat(prefix, "o_orderkey").alias("trial_id"), F.concat(F.lit("https://list/"), "o_orderkey").alias("study_url"),
            F.concat_ws(" and ", "p_type", "p_name").alias("intervention"), F.col("o_orderstatus").alias("countries"))

    def drug_words(self) -> DataFrame:
        """Parts as a vocabulary: the name, and its noun, brand and type as synonyms."""
        return self.table("part").select(
            F.concat(F.lit(" "), F.initcap("p_name")).alias("Common name"),
            F.concat_ws("|", F.regexp_extract("p_name", r"\S+$", 0), "p_brand", "p_name", F.lit("ab"))
            .alias("Synonyms"),
            F.col("p_partkey").alias("row_no"),
        )

    def stream(self, name: str) -> DataFrame:
        """A table as a file stream, be it one file or a folder of files."""
        # A stream takes a plain path for a folder; a pattern finds a file as well as what is in a folder.
        return self.spark.readStream.schema(self.table(name).schema).parquet(f"{self.sf_dir}/{name}.parque[t]")

    def timed_posts(self, raw: DataFrame | None = None) -> DataFrame:
        """Posts with a time: conversations begin 45 s apart, turns follow after 20 s; every seventh post is an hour old."""
        raw = self.table("conversations") if raw is None else raw
        late = F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, 3600).otherwise(0)
        return raw.select(
            (F.col("conv_id") * 1000 + 1 + F.col("turn")).alias("id"),
            F.timestamp_seconds(F.lit(1_700_000_000) + F.col("conv_id") * 45 + F.col("turn") * 20 - late).alias("ts"), F.col("text").alias("full_text"))

    def ev_stream(self) -> DataFrame:
        return self.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))


# --- the same views in SQL -------------------------------------------------------------------

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"

CTE = {
    "posts": """posts AS (
        SELECT conv_id * 1000 + turn + 1 AS status_id, conv_id * 1000 + 1 AS conversation_id,
               CASE WHEN turn > 0 THEN conv_id * 1000 + turn ELSE 0 END AS reply_to,
               role AS user_name, text AS full_text
        FROM conversations)""",
    "timed_posts": """timed_posts AS (
        SELECT conv_id * 1000 + 1 + turn AS id, text AS full_text,
               1700000000 + conv_id * 45 + turn * 20 - CASE WHEN (conv_id + turn) % 7 = 0 THEN 3600 ELSE 0 END AS s
        FROM conversations)""",
    "hyd": """hyd AS (
        SELECT d.doc_id AS id,
               CASE l.quality WHEN 1 THEN 'FULL' WHEN 0 THEN 'PARTIAL' END AS hydrated
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "ev_typed": """ev_typed AS (
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CASE WHEN event_type = 'error' THEN 'retweet_quote'
                    WHEN event_type = 'click' THEN 'retweet'
                    WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 THEN 'reply'
                    ELSE 'original' END AS status_type
        FROM events)""",
    "ev_ids": """ev_ids AS (
        SELECT event_id,
               ((epoch_us(ts) // 1000 - 1288834974657) << 22) | ((user_id % 1024) << 12) | (event_id % 4096) AS id
        FROM events)""",
    "vocab": """vocab AS (
        SELECT DISTINCT unnest(
          regexp_extract_all(lower(text), '[a-z]{3,}') || regexp_extract_all(lower(text), '[a-z]+ [a-z]+')
          || regexp_extract_all(lower(text), '[a-z]+ [a-z]+ [a-z]+ [a-z]+')) AS term
        FROM benchmark)""",
    "topics": """topics AS (
        SELECT 't' || (length(term) % 3) AS topic, term AS phrase FROM vocab)""",
    "mentions": r"""mentions AS (
        SELECT doc_id AS status_id, regexp_extract_all(text, '@[\p{L}\p{N}_]+') AS user_mentions
        FROM documents)""",
    "studies": """studies AS (
        SELECT 'NCT' || o_orderkey AS trial_id, 'https://clinicaltrials.gov/show/NCT' || o_orderkey AS study_url,
               CASE WHEN p_name IS NULL OR o_orderkey % 5 = 0 THEN '' ELSE p_name || ', ' || p_brand END
                 AS intervention,
               o_orderstatus AS study_type, CAST(o_custkey AS VARCHAR) AS target_size,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'Official ' ELSE 'Brief ' END || o_orderpriority
                 AS public_title
        FROM orders LEFT JOIN part ON o_custkey = p_partkey
        UNION ALL
        SELECT 'NCX' || o_orderkey, 'https://clinicaltrials.gov/show/NCX' || o_orderkey, '', '', '',
               'Brief ' || o_orderpriority FROM orders)""",
    "all_studies": """all_studies AS (
        SELECT trial_id, study_url, intervention FROM studies
        UNION ALL
        SELECT 'ISRCTN' || o_orderkey, 'https://list/' || o_orderkey, concat_ws(' and ', p_type, p_name)
        FROM orders LEFT JOIN part ON o_custkey = p_partkey WHERE o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0)""",
    "page_parts": r"""page_parts AS (
        SELECT *, lower(raw_scheme) AS scheme, regexp_extract(netloc, '^(.*)@', 1) AS userinfo,
               regexp_replace(netloc, '^.*@', '') AS address
        FROM (SELECT page_id, url,
          regexp_extract(url, '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?', 2) AS raw_scheme,
          regexp_extract(url, '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?', 4) AS netloc,
          regexp_extract(url, '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?', 5) AS path,
          regexp_extract(url, '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?', 7) AS query,
          regexp_extract(url, '^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?', 9) AS fragment
        FROM pages))""",
}


def with_views(names: str, body: str) -> str:
    """Prefix a statement with the named views."""
    return "WITH " + ",\n".join(CTE[n] for n in names.split()) + "\n" + body.strip()


def filled(text: str) -> str:
    """SQL for a text with every sign that is neither a word character nor a blank as ``#``."""
    return rf"'#' || regexp_replace({text}, '[^\p{{L}}\p{{N}}_ ]', '#', 'g') || '#'"


def whole(term: str, text: str) -> str:
    """SQL test for a whole-word occurrence of a term of words and blanks in a ``filled`` text."""
    return "(" + " OR ".join(f"contains({text}, '{a}' || {term} || '{b}')" for a in " #" for b in " #") + ")"


def guard(term: str, text: str) -> str:
    """SQL test for a whole-word occurrence; the plain test first spares most regular expressions."""
    return (
        f"CASE WHEN contains({text}, {term}) THEN "
        f"regexp_matches({text}, '(^|{NON_WORD})' || regexp_escape({term}) || '($|{NON_WORD})') "
        "ELSE FALSE END"
    )
