"""Product codes and URL clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null, col, pick


def product_code(url: Column | str) -> Column:
    """Ten-character code after /dp/; the URL itself where there is none."""
    return F.coalesce(pick(url, r"/dp/([A-Z0-9]{10})", 1), col(url))


def absolute_url(c: Column | str, host: str, unless_http: bool = False) -> Column:
    """Prefix the host to a path.

    Default: only values that start with '/'. ``unless_http``: everything that does not
    already start with 'http'.
    """
    relative = ~col(c).startswith("http") if unless_http else col(c).startswith("/")
    return F.when(relative, F.concat(F.lit(host), col(c))).otherwise(blank_to_null(c))


def normalize_url(c: Column | str, host: str, root: str = "/ip/") -> Column:
    """Clean product URL.

    A tracking redirect is resolved through its ``rd`` parameter, a relative product path gets
    the host, and the query string is cut off product URLs.
    """
    raw = blank_to_null(c)
    cut = lambda x: F.substring_index(x, "?", 1)
    once = F.try_url_decode(pick(raw, r"[?&]rd=([^&#]+)", 1))
    twice = F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))
    target = F.coalesce(twice, once)
    redirect = F.when(
        raw.contains("/sp/track?") & target.contains(root),
        F.concat(F.lit(host + root), cut(F.split_part(target, F.lit(root), F.lit(2)))),
    )
    return F.coalesce(
        redirect,
        F.when(raw.startswith(root), F.concat(F.lit(host), cut(raw))),
        F.when(raw.startswith("http") & raw.contains(root), cut(raw)),
        raw,
    )
