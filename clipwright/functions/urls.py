"""Video addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the 11 characters of a video id stand, in order of precedence.
ID_PATTERNS = (r"(?:youtu\.be|kisa\.example)/([A-Za-z0-9_-]{11})", r"[?&]v=([A-Za-z0-9_-]{11})", r"/shorts/([A-Za-z0-9_-]{11})")
# Hosts of videos with the site each stands for, and those of them whose path is the id.
SITES = {"youtube.com": "youtube.com", "youtu.be": "youtube.com", "video.example": "video.example", "kisa.example": "video.example"}
SHORT_HOSTS = ("youtu.be", "kisa.example")
#: Scheme, host, path and query of an address.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def video_id(url: Column | str) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.coalesce(*(F.nullif(F.regexp_extract(u, p, 1), F.lit("")) for p in ID_PATTERNS))


def normalize_url(url: Column | str) -> Column:
    """One address per video: the watch page for short addresses, the shorts page for shorts, else scheme, host and path.

    The host loses www. and m.; the scheme of any other address and its path stay as they are.
    """
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    part = lambda i: F.regexp_extract(u, _PARTS, i)
    host = F.replace(F.replace(F.lower(part(2)), F.lit("www."), F.lit("")), F.lit("m."), F.lit(""))
    path = F.regexp_replace(part(3), "/+$", "")
    site = F.create_map(*(F.lit(x) for pair in SITES.items() for x in pair))[host]
    named, queried, short = F.regexp_replace(path, "^/+", ""), F.regexp_extract(part(4), "(?:^|&)v=([^&]+)", 1), F.regexp_extract(path, "^/shorts/([^/]+)", 1)
    page = lambda kind, ident: F.concat(F.lit("https://"), site, F.lit(kind), ident)
    return (
        F.when(host.isin(*SHORT_HOSTS) & (named != ""), page("/watch?v=", named))
        .when(site.isNotNull() & (path == "/watch") & (queried != ""), page("/watch?v=", queried))
        .when(site.isNotNull() & (short != ""), page("/shorts/", short))
        .otherwise(F.concat(F.lower(part(1)), F.lit("://"), host, part(3)))
    )
