"""Addresses: hosts, spam and news sites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts that are spam wherever they appear.
SPAM = ["unknowncheats.me", "bydfi.com", "tinyurl.com", "goo.gl", "cutt.ly", "shorturl.at"]
# News and social sites that are never a company's own.
NEWS = [
    "youtube.com", "linkedin.com", "twitter.com", "x.com", "facebook.com", "instagram.com", "tiktok.com", "reddit.com", "yahoo.com", "yahoo.co.jp", "baidu.com", "google.com", "bbc.com", "bbc.co.uk", "cnn.com", "reuters.com", "bloomberg.com",
    "forbes.com", "techcrunch.com", "webrazzi.com", "hurriyet.com.tr", "milliyet.com.tr", "sozcu.com.tr", "sabah.com.tr", "haberturk.com", "ntv.com.tr", "cnnturk.com", "dha.com.tr", "aa.com.tr", "trthaber.com", "medium.com", "substack.com", "wordpress.com",
]


def host(c: Column) -> Column:
    """The host of an address with or without scheme, in lower case, without port and path."""
    return F.regexp_extract(F.lower(F.trim(c)), "^(?:[a-z][a-z0-9+.-]*://)?([^/:?#]*)", 1)


def bare_host(c: Column) -> Column:
    """The host of an http address without `www.`; empty for anything else."""
    return F.regexp_extract(c, "https?://(?:www\\.)?([^/]+)", 1)


def is_spam(c: Column) -> Column:
    """The host is a spam host or lies under one."""
    return host(c).rlike("^(?:.+\\.)?(?:" + "|".join(s.replace(".", "\\.") for s in SPAM) + ")$")


def is_own_site(c: Column) -> Column:
    """Not an address of a news or social site (these match anywhere in it); missing ones are fine."""
    x = F.lower(F.trim(c))
    return c.isNull() | x.isin("", "unknown") | ~x.rlike("|".join(n.replace(".", "\\.") for n in NEWS))


def slugged(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", ""))
