"""Column builders."""

from .ids import (
    MACHINE_IDS, SNOWFLAKE_EPOCH_MS, expand_snowflake_ids, snowflake_id, snowflake_id_range,
    snowflake_machine, snowflake_sequence, snowflake_time,
)
from .markup import embed_img, link_urls, menu_anchor
from .text import (
    clean_file_name, default_job_name, default_list_job_name, extract_mentions, extract_urls,
    lower_trim, normalize_hashtags, study_url_from_id, wrap_hashtags,
)
from .urls import parse_url_blank, parse_url_parts
from .values import (
    epoch_seconds, millis_to_timestamp, parse_post_time, parse_repr_struct, to_json_string,
)

__all__ = [n for n in dir() if not n.startswith("_")]
