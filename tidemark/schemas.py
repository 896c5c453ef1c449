"""Fixed schemas and cleaning rules."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, TEXT, FLAG = T.LongType(), T.StringType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# --- fixed values: archive columns and their types ---------------------------------------
STATUS_SCHEMA = _struct(
    contributors=TEXT, coordinates=TEXT, created_at=TEXT, display_text_range=TEXT, entities=TEXT,
    extended_entities=TEXT, favorited=FLAG, favorite_count=LONG, full_text=TEXT, geo=TEXT,
    id=LONG, id_str=TEXT, in_reply_to_screen_name=TEXT, in_reply_to_status_id=LONG,
    in_reply_to_status_id_str=TEXT, in_reply_to_user_id=LONG, in_reply_to_user_id_str=TEXT,
    is_quote_status=FLAG, lang=TEXT, place=TEXT, possibly_sensitive=FLAG, quoted_status=TEXT,
    quoted_status_id=LONG, quoted_status_id_str=TEXT, quoted_status_permalink=TEXT,
    retweet_count=LONG, retweeted=FLAG, retweeted_status=TEXT, scopes=TEXT, source=TEXT,
    truncated=FLAG, user=TEXT, withheld_in_countries=TEXT, followers=TEXT,
)

# Defaults other than null. ``id`` has none and must be present.
STATUS_DEFAULTS = {
    "contributors": "[]",
    "favorite_count": 0,
    "in_reply_to_status_id": 0,
    "in_reply_to_user_id": 0,
    "possibly_sensitive": False,
    "quoted_status_id": 0,
    "retweet_count": 0,
    "withheld_in_countries": "[]",
}
# (column, type, default) for every archive column.
DEFAULT_RULES = [
    (f.name, f.dataType, STATUS_DEFAULTS.get(f.name)) for f in STATUS_SCHEMA.fields
]

# Columns removed on arrival, and how the others are brought to archive form.
DROP_COLUMNS = ["withheld_in_countries"]
COERCE_RULES = {
    "display_text_range": "json",
    "extended_entities": "json",
    "scopes": "json",
    "followers": "json",
    "withheld_in_countries": "json",
    "contributors": "keep",
    "created_at": "string",
    "possibly_sensitive": "bool",
    "quoted_status_id": "id",
    "in_reply_to_status_id": "id",
    "in_reply_to_user_id": "id",
}

# Author fields kept by flattening.
USER_SCHEMA = _struct(
    id=LONG, screen_name=TEXT, created_at=TEXT, followers_count=LONG, friends_count=LONG,
    favourites_count=LONG, utc_offset=TEXT, time_zone=TEXT, verified=FLAG, statuses_count=LONG,
    profile_image_url=TEXT, location=TEXT, name=TEXT, description=TEXT,
)
ENTITIES_SCHEMA = _struct(
    urls=T.ArrayType(_struct(expanded_url=TEXT)),
    hashtags=T.ArrayType(_struct(text=TEXT)),
    user_mentions=T.ArrayType(_struct(id=LONG, name=TEXT, screen_name=TEXT)),
)
# A quoted or shared post, cut down to what flattening keeps.
INNER_STATUS_SCHEMA = _struct(id=LONG, created_at=TEXT, user=_struct(id=LONG))

SCRAPED_SCHEMA = _struct(
    id=TEXT, conversation_id=TEXT, created_at=LONG, user_id=TEXT, username=TEXT, name=TEXT,
    tweet=TEXT, nlikes=LONG, nretweets=LONG, quote_url=TEXT, retweet=FLAG,
    hashtags=T.ArrayType(TEXT),
)

_PROTOCOL = _struct(
    IdentificationModule=_struct(NCTId=TEXT, OfficialTitle=TEXT, BriefTitle=TEXT),
    ArmsInterventionsModule=_struct(ArmGroupList=_struct(ArmGroup=T.ArrayType(_struct(
        ArmGroupInterventionList=_struct(ArmGroupInterventionName=T.ArrayType(TEXT)),
    )))),
    DesignModule=_struct(StudyType=TEXT, EnrollmentInfo=_struct(EnrollmentCount=TEXT)),
)
TRIAL_SCHEMA = _struct(FullStudiesResponse=_struct(
    NStudiesFound=LONG,
    FullStudies=T.ArrayType(_struct(Study=_struct(ProtocolSection=_PROTOCOL))),
))

# Graph labels and their keys.
NODE_KEYS = {"Tweet": "id", "Account": "id", "Url": "full_url"}

TWEET_PROPS = [
    "text", "created_at", "favorite_count", "retweet_count", "job_name", "job_id",
    "hashtags", "type",
    "geo", "ingest_method",
]
ACCOUNT_PROPS = [
    "name", "screen_name", "followers_count", "friends_count", "location",
    "user_profile_image_url", "created_at", "job_name", "job_id",
]
URL_PROPS = [
    "job_name", "job_id", "schema", "netloc", "path", "params", "query", "fragment",
    "username", "password", "hostname", "port",
]
