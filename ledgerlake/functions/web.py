"""URLs: canonical attachment addresses and trust in hosts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What addresses of downloads look like.
FILE_ENDINGS = r"\.(?:xlsx?|csv|pdf|zip)$"
DOWNLOAD_WORDS = ["download", "filedown", "attach", "atchfile", "bbsfile"]
URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host(url: Column) -> Column:
    """Lower-cased host of a URL, without user and port; empty without one."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2), "^.*@", ""), ":[0-9]*$", ""))


def sorted_query(url: Column) -> Column:
    """The URL with the parts of its query sorted, parts without a value dropped, and no fragment."""
    parts = F.array_sort(F.filter(F.split(F.regexp_extract(url, URL, 4), "&"), lambda p: p.rlike("=.")))
    base = F.concat(F.regexp_extract(url, URL, 1), F.lit("://"), F.regexp_extract(url, URL, 2), F.regexp_extract(url, URL, 3))
    return F.when(F.size(parts) > 0, F.concat(base, F.lit("?"), F.array_join(parts, "&"))).otherwise(base)


def attachment_url(url: Column, any_path: bool = False) -> Column:
    """Canonical form of the address of a file, null for what is none (no http host, user in it, scripts, bare routes)."""
    raw = F.trim(F.regexp_replace(F.coalesce(url, F.lit("")), "(?i)&(?:amp|#0*38|#x0*26);", "&"))
    path = F.lower(F.regexp_replace(F.regexp_extract(raw, URL, 3), "/+$", ""))
    site, query = F.regexp_extract(raw, URL, 2), F.regexp_extract(raw, URL, 4)
    looks = path.rlike(FILE_ENDINGS) | reduce(lambda a, b: a | b, (F.contains(path, F.lit(w)) for w in DOWNLOAD_WORDS))
    bad = (
        ~raw.rlike("^(?i:https?)://[^/?#@ ]+(?:[/?#]|$)") | F.contains(raw, F.lit(" ")) | (site == "") | path.rlike(r"\.(?:js|css)$") | path.rlike("/attach$")
        | (path.rlike("/(?:bbsattachdownload|bbsgallerydownload)\\.do$") & ~query.rlike("=."))
    )
    return F.when(~bad & (F.lit(True) if any_path else looks), sorted_query(raw))


def trusted(url: Column, hosts: list[str]) -> Column:
    """Whether the URL's host is one of the hosts or below one of them."""
    h = host(url)
    return reduce(lambda a, b: a | b, ((h == x) | F.endswith(h, F.lit("." + x)) for x in hosts), F.lit(False))
