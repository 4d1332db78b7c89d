"""Columns derived from a revision: size, digest, status flags, contributor class, parent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editlume.functions.ip import ipv4_to_long
from editlume.functions.patterns import FEATURED_ARTICLE, FEATURED_LIST, GOOD_ARTICLE, check_wiki

ANONYMOUS, NO_CONTRIBUTOR, NAME_ONLY = 0, -1, -2
PSEUDO_USERS = ((ANONYMOUS, "Anonymous user"), (NO_CONTRIBUTOR, "NA"), (NAME_ONLY, "Missing ID"))


def byte_length(text: Column) -> Column:
    """Length in UTF-8 bytes; 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_digest(text: Column) -> Column:
    """SHA-256 in hexadecimal of the UTF-8 text; of '' for NULL."""
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("tinyint")


def is_redirect(text: Column) -> Column:
    """1 if the first nine characters are #REDIRECT in any letter case."""
    return _flag(F.upper(F.substring(text, 1, 9)) == "#REDIRECT")


def has_template(text: Column, namespace: Column, pattern: str | None) -> Column:
    """1 if the pattern is found in a main-namespace text. A cheap containment test spares most texts the regex."""
    if pattern is None:
        return F.lit(0).cast("tinyint")
    return _flag((namespace == 0) & F.when(F.contains(text, F.lit("{{")), text.rlike("(?d)" + pattern)).otherwise(False))


def status_flags(text: Column, namespace: Column, wiki: str) -> dict[str, Column]:
    """rev_is_redirect, rev_fa, rev_flist and rev_ga for a supported wiki."""
    check_wiki(wiki)
    return {
        "rev_is_redirect": is_redirect(text),
        "rev_fa": has_template(text, namespace, FEATURED_ARTICLE[wiki]),
        "rev_flist": has_template(text, namespace, FEATURED_LIST.get(wiki)),
        "rev_ga": has_template(text, namespace, GOOD_ARTICLE.get(wiki)),
    }


def editor_id(ip: Column, user_id: Column, username: Column) -> Column:
    """The contributor as one signed number: >0 registered, 0 by IP, -1 unknown, -2 name without a usable id."""
    return (
        F.when(ip.isNotNull(), F.lit(ANONYMOUS))
        .when(user_id > 0, user_id)
        .when(username.isNotNull(), F.lit(NAME_ONLY))
        .otherwise(F.lit(NO_CONTRIBUTOR))
        .cast("long")
    )


def minor_edit(minor: Column, compat: bool = False) -> Column:
    """1 if the minor mark is present; `compat` gives the inverted flag of older tables."""
    return (minor.isNull() if compat else minor.isNotNull()).cast("tinyint")


def iso_timestamp(text: Column) -> Column:
    """A zone-less timestamp from 2005-01-25T06:55:26Z; NULL if it has another form."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz")


def with_parents(revisions: Column) -> Column:
    """An array of revision structs in document order, each with parent_id = the id before it (NULL first).

    Works inside the page's own row: no shuffle.
    """
    return F.transform(revisions, lambda r, i: r.withField("parent_id", F.get(revisions, i - 1)["id"]))


def anonymous_ip(ip: Column) -> Column:
    """The address as a number; NULL for IPv6, which keeps its text."""
    return ipv4_to_long(ip)
