"""Identity keys and content digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.functions import text as X
from matchloom.functions import urls as U


def player_key(tag: Column, epoch: str | None = None) -> Column:
    key = F.concat(F.lit("player:"), tag)
    return F.concat(key, F.lit(f":refresh:{epoch}")) if epoch else key


def page_key(url: Column, adaptive: bool = True) -> Column:
    return U.canonical_url(url) if adaptive else url


def battle_key(tag: Column) -> Column:
    return F.concat(F.lit("battle:"), tag)


def upgrade_key(tag: Column) -> Column:
    return F.concat(F.lit("authoritative:"), tag)


def source_key(url: Column, generation: Column) -> Column:
    return F.concat(F.lit("source:"), F.sha2(url, 256), F.lit(":"), generation.cast("string"))


def revisit_key(key: Column, generation: Column) -> Column:
    return F.concat(key, F.lit(":revisit:"), generation.cast("string"))


def content_digest(body: Column) -> Column:
    return F.sha2(body, 256)


def fingerprint(tags: Column) -> Column:
    """Digest of a page's distinct battle tags, in order."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(tags)), "\n"), 256)


def url_hash(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 16)


def identity_from_url(url: Column) -> Column:
    tag = F.regexp_extract(url, r"[?&]tag=([^&]+)", 1)
    player = F.regexp_extract(url, r"/player/([^/?]+)", 1)
    return F.when(tag != "", tag).when(player != "", player)


def identity_from_fields(*fields: Column) -> Column:
    """First non-empty identity field, made path-safe."""
    picked = F.coalesce(*[F.when(c != "", c) for c in fields])
    return F.replace(F.translate(picked, "/ ", "__"), F.lit("#"), F.lit(""))


def storage_identity(identity: Column, url: Column) -> Column:
    return X.safe_identifier(F.coalesce(identity, identity_from_url(url), url_hash(url)))


def storage_prefix(identity: Column, url: Column) -> Column:
    """Two-character shard; records known only by their hash share one."""
    name = storage_identity(identity, url)
    return F.when(name == url_hash(url), F.lit("xx")).otherwise(F.lower(F.substring(name, 1, 2)))


def index_key(kind: Column, battle_tag: Column, url: Column) -> Column:
    """Identity of an index record, null when it has none."""
    tag = F.btrim(battle_tag)
    by_url = F.when((url != "") & kind.isin("battle", "authoritative_battle"), F.concat(F.lit("url:"), url))
    ident = F.when(tag != "", tag).otherwise(by_url)
    return F.when(ident.isNotNull(), F.concat(F.coalesce(kind, F.lit("battle")), F.lit("|"), ident))
