"""Explicit schemas of sources and tables: nothing is inferred."""

from __future__ import annotations

PAGE_XML = (
    "title STRING, ns INT, id LONG, restrictions STRING, "
    "revision ARRAY<STRUCT<id: LONG, timestamp: STRING, "
    "contributor: STRUCT<ip: STRING, username: STRING, id: LONG, _deleted: STRING>, "
    "minor: STRING, comment: STRING, text: STRUCT<_VALUE: STRING, `_xml:space`: STRING, _deleted: STRING>>>, "
    "_corrupt STRING"
)
REVISION_XML = (
    "id LONG, timestamp STRING, contributor STRUCT<ip: STRING, username: STRING, id: LONG, _deleted: STRING>, "
    "minor STRING, comment STRING, text STRUCT<_VALUE: STRING, `_xml:space`: STRING, _deleted: STRING>, _corrupt STRING"
)
LOGITEM_XML = (
    "id LONG, timestamp STRING, contributor STRUCT<username: STRING, id: LONG, _deleted: STRING>, comment STRING, "
    "type STRING, action STRING, logtitle STRING, params STRUCT<_VALUE: STRING, `_xml:space`: STRING>, _corrupt STRING"
)
NAMESPACE_XML = "_key INT, _case STRING, _VALUE STRING"
SUMMARY_CSV = (
    "lang STRING, very_active_wikipedians LONG, active_wikipedians LONG, other_contributors LONG, admins LONG, articles LONG, "
    "redirects LONG, edits_per_month LONG, new_articles LONG, fa_articles LONG, new_fa_articles LONG"
)
IP_RANGE_CSV = "from_ip STRING, to_ip STRING, country STRING"

# The column lists of the SQL dumps read (as in the public MediaWiki manual).
SQL_DUMPS: dict[str, str] = {
    "user_groups": "ug_user LONG, ug_group STRING",
    "iwlinks": "iwl_from LONG, iwl_prefix STRING, iwl_title STRING",
    "templatelinks": "tl_from LONG, tl_namespace INT, tl_title STRING",
    "page_restrictions": "pr_id LONG, pr_page LONG, pr_type STRING, pr_level STRING, pr_cascade INT, pr_expiry STRING",
    "category": "cat_id LONG, cat_title STRING, cat_pages LONG, cat_subcats LONG, cat_files LONG",
    "categorylinks": "cl_from LONG, cl_to STRING, cl_sortkey STRING, cl_timestamp STRING, cl_sortkey_prefix STRING, cl_collation STRING, cl_type STRING",
    "externallinks": "el_from LONG, el_to STRING, el_index STRING",
    "pagelinks": "pl_from LONG, pl_namespace INT, pl_title STRING",
    "imagelinks": "il_from LONG, il_to STRING",
}
TABLES: dict[str, str] = {
    "page": "page_id LONG, page_namespace SHORT, page_title STRING, page_restrictions STRING",
    "revision": "rev_id LONG, rev_page LONG, rev_user LONG, rev_timestamp TIMESTAMP_NTZ, rev_len LONG, rev_parent_id LONG, rev_is_redirect BYTE, rev_minor_edit BYTE, rev_fa BYTE, rev_flist BYTE, rev_ga BYTE, rev_comment STRING",
    "revision_hash": "rev_id LONG, rev_page LONG, rev_user LONG, rev_hash STRING",
    "namespaces": "code SHORT, name STRING",
    "user": "user_id LONG, user_name STRING",
    "revision_ip": "rev_id LONG, ip_text STRING, ip_v4 LONG",
    "revision_user_zero": "rev_id LONG, user_name STRING",
    "logging": "log_id LONG, log_type STRING, log_action STRING, log_timestamp TIMESTAMP_NTZ, log_user LONG, log_username STRING, log_namespace INT, log_title STRING, log_comment STRING, log_params STRING, log_new_flag LONG, log_old_flag LONG",
    "block": "block_id LONG, block_action STRING, block_user LONG, block_timestamp TIMESTAMP_NTZ, block_target STRING, block_ip LONG, block_duration DECIMAL(15,1)",
    "user_new": "user_log_id LONG, user_id LONG, user_name STRING, user_timestamp TIMESTAMP_NTZ, user_action STRING",
    "user_level": "level_log_id LONG, level_granter_id LONG, level_username STRING, level_timestamp TIMESTAMP_NTZ, level_old STRING, level_new STRING",
    "ip_country": "ip LONG, country STRING",
}
