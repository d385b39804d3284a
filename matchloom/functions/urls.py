"""URL parts, canonical forms and replay addresses.

Parts are taken with the generic-syntax expression of RFC 3986, appendix B:
unlike a strict parser it also splits addresses holding blanks or pipes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GENERIC = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _GENERIC, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, _GENERIC, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _GENERIC, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _GENERIC, 4)


def has_credentials(url: Column) -> Column:
    return F.regexp_extract(authority(url), "^([^@]*)@", 1) != ""


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encode(text: Column) -> Column:
    """Form encoding with ``*`` escaped and ``~`` kept."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_param(url: Column, key: str) -> Column:
    """First non-empty value of a query parameter, decoded; null when absent."""
    raw = F.regexp_extract(query(url), f"(?:^|&){key}=([^&]+)", 1)
    return F.when(raw != "", _decode(raw))


def canonical_url(url: Column) -> Column:
    """One spelling per list page: case, trailing slash, parameter order, no fragment."""
    segments = F.split(F.regexp_replace(path(url), "/+$", ""), "/")
    is_player = (F.size(segments) >= 3) & (F.get(segments, F.lit(1)) == "player")
    spelled = F.array_join(
        F.transform(
            segments,
            lambda s, i: F.when((i == 2) & is_player, F.upper(s)).otherwise(s),
        ),
        "/",
    )
    pairs = F.array_sort(
        F.transform(
            F.filter(F.split(query(url), "&"), lambda p: p != ""),
            lambda p: F.struct(
                _decode(F.substring_index(p, "=", 1)).alias("k"),
                F.when(p.contains("="), _decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)))
                .otherwise(F.lit("")).alias("v"),
            ),
        )
    )
    parameters = F.array_join(
        F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )
    head = F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise(F.lit(""))
    host = F.when(authority(url) != "", F.concat(F.lit("//"), F.lower(authority(url)))).otherwise(F.lit(""))
    tail = F.when(parameters != "", F.concat(F.lit("?"), parameters)).otherwise(F.lit(""))
    return F.concat(head, host, spelled, tail)


def resolve(href: Column, base: str) -> Column:
    """Absolute address of a link found on a page of ``base``."""
    root = base.rstrip("/")
    origin = "/".join(root.split("/")[:3])
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(root.split(":")[0] + ":"), href))
        .when(href.startswith("/"), F.concat(F.lit(origin), href))
        .otherwise(F.concat(F.lit(root + "/"), href))
    )


def same_origin(url: Column, base: str) -> Column:
    root = base.rstrip("/").split("/")
    return (
        (scheme(url) == root[0].rstrip(":").lower())
        & (F.lower(authority(url)) == root[2].lower())
        & ~has_credentials(url)
    )


def source_url(href: Column, base: str) -> Column:
    """Canonical address of a player board on the same site, else null."""
    url = canonical_url(resolve(href, base))
    allowed = scheme(url).isin("http", "https") & same_origin(url, base) & path(url).startswith("/players/")
    return F.when(allowed, url)


def list_url(tag: Column, base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/player/"), tag, F.lit("/battles"))


def replay_url(
    base: str | Column, tag: Column, team_tags: Column, opponent_tags: Column,
    team_crowns: Column, opponent_crowns: Column, referrer: Column,
) -> Column:
    """Replay address; commas are escaped in the tag lists only."""
    def escaped(c: Column) -> Column:
        return F.replace(c, F.lit(","), F.lit("%2C"))

    root = F.lit(base.rstrip("/")) if isinstance(base, str) else F.regexp_replace(base, "/+$", "")
    return F.concat(
        root, F.lit("/data/replay?tag="), tag,
        F.lit("&team_tags="), escaped(team_tags),
        F.lit("&opponent_tags="), escaped(opponent_tags),
        F.lit("&team_crowns="), team_crowns,
        F.lit("&opponent_crowns="), opponent_crowns,
        F.lit("&referrer_path="), referrer,
    )


def player_list_url_allowed(url: Column, tag: Column, base: str) -> Column:
    """The page belongs to ``tag`` on this site: exact path, no credentials."""
    home = F.concat(F.lit("/player/"), tag, F.lit("/battles"))
    return same_origin(url, base) & (
        (path(url) == home) | (path(url) == F.concat(home, F.lit("/history")))
    )
