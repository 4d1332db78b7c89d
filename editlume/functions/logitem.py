"""Columns derived from a log entry: namespace, flagged revisions, block target and duration, rights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editlume.functions.ip import IPV4, ipv4_to_long, strip_octet_zeros

NO_TITLE = -1000
UNKNOWN_USER = -1
FOREVER = 86400000000000.0  # seconds: the longest span the tables know
# The actions of each kind of entry, and seconds per unit of a block's duration.
REVIEW_ACTIONS = ("approve", "approve-a", "unapprove", "approve-ia", "approve-i")
BLOCK_ACTIONS = ("block", "unblock", "reblock")
NEWUSER_ACTIONS = ("newusers", "create", "create2", "autocreate", "byemail")
UNIT_SECONDS = {
    "sec": 1.0,
    "min": 60.0,
    "h": 3600.0,
    "d": 86400.0,
    "week": 604800.0,
    "fortnight": 1209600.0,
    "month": 2592000.0,
    "year": 31557600.0,
}
EXPIRY_FORMATS = (
    *[f"{day} {time}".strip() for day in ("yyyy-MM-dd", "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy/M/d") for time in ("HH:mm:ss", "HH:mm", "")],
    *[f"{time} {day}" for day in ("d MMM yyyy", "d MMMM yyyy", "MMMM d yyyy") for time in ("HH:mm:ss", "HH:mm")],
    "yyyyMMddHHmmss", "yyyyMMdd",
)


def plain_label(label: Column) -> Column:
    """Type or action as compared: lower case, no outer blanks, `-` for `_`."""
    return F.translate(F.lower(F.trim(label)), "_", "-")


def is_review(kind: Column, action: Column) -> Column:
    return (plain_label(kind) == "review") & plain_label(action).isin(*REVIEW_ACTIONS)


def is_block(kind: Column, action: Column) -> Column:
    return (plain_label(kind) == "block") & plain_label(action).isin(*BLOCK_ACTIONS)


def is_new_user(kind: Column, action: Column) -> Column:
    return (plain_label(kind) == "newusers") & plain_label(action).isin(*NEWUSER_ACTIONS)


def is_rights(kind: Column, action: Column) -> Column:
    return (plain_label(kind) == "rights") & (plain_label(action) == "rights")


def title_namespace(title: Column, names: dict[str, int]) -> Column:
    """The namespace of a title with exactly one colon and a known prefix; 0 otherwise, -1000 without a title.

    A wiki has a few dozen namespaces, so they become a literal map.
    """
    part = F.split(title, ":")
    known = F.create_map(*[F.lit(x) for name, code in names.items() for x in (name, code)]) if names else F.create_map()
    code = F.when(F.size(part) == 2, F.try_element_at(known, F.get(part, F.lit(0)))) if names else F.lit(None)
    return F.when(F.coalesce(title, F.lit("")) == "", F.lit(NO_TITLE)).otherwise(F.coalesce(code, F.lit(0))).cast("int")


def flagged_ids(review: Column, params: Column) -> tuple[Column, Column]:
    """(new, old) flagged revision of a review entry: one line -> (line, 0), two or three -> both; else 0."""
    line = F.split(params, "\n")
    some = F.coalesce(review & params.isNotNull() & F.size(line).between(1, 3), F.lit(False))
    number = lambda k: F.coalesce(F.get(line, F.lit(k)).try_cast("long"), F.lit(0).cast("long"))
    new = F.when(some, number(0)).otherwise(F.lit(0).cast("long"))
    old = F.when(some & (F.size(line) > 1), number(1)).otherwise(F.lit(0).cast("long"))
    return new, old


def block_target(title: Column) -> tuple[Column, Column]:
    """(user name or '', IPv4 number or NULL) of a block's title; a malformed address gives 0."""
    part = F.split(title, ":")
    target = F.when(F.size(part) == 2, F.get(part, F.lit(1)))
    numeric = target.rlike(IPV4)
    name = F.when(target.isNotNull() & ~numeric, target).otherwise("")
    return name, F.when(numeric, F.coalesce(ipv4_to_long(strip_octet_zeros(target)), F.lit(0).cast("long")))


def expiry_time(text: Column) -> tuple[Column, Column]:
    """(zone-less time, seconds its zone is ahead of UTC) of a written date; NULL if it has none of the forms.

    A weekday, commas, fractions of seconds, GMT, UTC or Z are left out; an offset such as +02:00 is
    the zone. The rest is a day and perhaps a time, in any order and notation of `EXPIRY_FORMATS`.
    """
    bare = F.regexp_replace(text, r"^[A-Za-z]{3,9}day,?\s+|^[A-Za-z]{3},\s*", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(\d)T(\d)", "$1 $2"), r"(:\d{2})\.\d+", "$1")
    offset = r"(?<=\d{2}:\d{2})\s*([+-])(\d{2}):?(\d{2})$"
    part = lambda k: F.coalesce(F.regexp_extract(bare, offset, k).try_cast("int"), F.lit(0))
    sign = F.when(F.regexp_extract(bare, offset, 1) == "-", -1).otherwise(1)
    plain = F.regexp_replace(F.regexp_replace(bare, offset, ""), r"\s*(?:GMT|UTC|Z)$", "")
    plain = F.trim(F.regexp_replace(F.regexp_replace(plain, ",", " "), r"\s+", " "))
    # within a lambda the text is worked out once, and the many forms make no code too long to compile
    forms = F.transform(F.array(plain), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in EXPIRY_FORMATS]))
    return F.get(forms, F.lit(0)).cast("timestamp_ntz"), sign * (part(2) * 3600 + part(3) * 60)


def block_duration(params: Column, logged: Column) -> Column:
    """Seconds from `logged` to the end of a block, DECIMAL(15,1).

    The first line of the parameters is a number and a unit, a word for "without end", or a date of
    expiry; anything else, and NULL, gives 0.
    """
    first = F.lower(F.trim(F.get(F.split(params, "\n"), F.lit(0))))
    amount = F.regexp_extract(first, r"^(\d{1,9})\s*[a-z]", 1).try_cast("double")
    unit = F.regexp_extract(first, r"^\d{1,9}\s*(sec|min|h|d|week|fortnight|month|year)", 1)
    factor = F.try_element_at(F.create_map(*[F.lit(x) for k, v in UNIT_SECONDS.items() for x in (k, v)]), unit)
    expiry, ahead = expiry_time(F.trim(F.get(F.split(params, "\n"), F.lit(0))))
    left = F.timestamp_diff("SECOND", logged, expiry).cast("double") - ahead
    seconds = (
        F.when(first.rlike("^(?:infinite|indefinite|infinity)"), F.lit(FOREVER))
        .when(factor.isNotNull() & amount.isNotNull(), F.least(amount * factor, F.lit(FOREVER)))
        .otherwise(F.coalesce(left, F.lit(0.0)))
    )
    return seconds.cast("decimal(15,1)")


def rights_change(title: Column, params: Column, comment: Column) -> tuple[Column, Column, Column]:
    """(user name, old, new) of a rights entry, the lists as text.

    Two lines: old and new. One line with serialised old and new groups: their quoted names as a
    bracketed list. One other line: the new list. No parameters: the comment, or ''.
    """
    name = F.coalesce(F.get(F.split(title, ":"), F.lit(1)), F.lit(""))
    line = F.split(params, "\n")
    one = F.get(line, F.lit(0))
    serial = one.contains('"4::oldgroups"')
    after = F.substring_index(one, '"4::oldgroups"', -1)
    quoted = lambda c: F.concat(F.lit("["), F.array_join(F.transform(F.regexp_extract_all(c, F.lit('"(.+?)"'), F.lit(1)), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    has = F.coalesce(params, F.lit("")) != ""
    many = F.size(line) > 1
    old = F.when(has & many, one).when(has & serial, quoted(F.substring_index(after, '"5::newgroups"', 1))).otherwise("")
    fresh = F.when(after.contains('"5::newgroups"'), F.substring_index(after, '"5::newgroups"', -1)).otherwise("")
    new = (
        F.when(has & many, F.get(line, F.lit(1)))
        .when(has & serial, quoted(fresh))
        .when(has, one)
        .otherwise(F.coalesce(comment, F.lit("")))
    )
    return name, old, new
