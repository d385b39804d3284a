"""Card slugs, player tags, markup attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom import values as V

BLANKS = " \t\n\r\x0b\x0c"


def base_slug(card: Column) -> Column:
    """Lower-case slug without its evolution or hero suffix. Most slugs have no hyphen, so no pattern is tried on them."""
    slug = F.lower(card)
    return F.when(card.contains("-"), F.regexp_replace(slug, r"-(ev[0-9]+|hero)$", "")).otherwise(slug)


def card_form(card: Column) -> Column:
    """``hero``, ``evN`` or ``base``."""
    slug = F.lower(F.btrim(card, F.lit(BLANKS)))
    evolution = F.regexp_extract(slug, r"-(ev[0-9]+)$", 1)
    return (
        F.when(~card.contains("-"), F.lit("base"))
        .when(slug.endswith("-hero"), F.lit("hero"))
        .when(evolution != "", evolution)
        .otherwise(F.lit("base"))
    )


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute in a tag's text, empty when missing."""
    return F.regexp_extract(tag, name + '="([^"]*)"', 1)


def tags(body: Column, name: str = "[A-Za-z][A-Za-z0-9]*") -> Column:
    """Opening tags of a body, as text, in order."""
    return F.regexp_extract_all(body, F.lit(rf"<{name}\b[^>]*>"), F.lit(0))


def elements(body: Column, name: str) -> Column:
    """Elements of a name that do not nest (tables, rows), from opening to closing tag."""
    return F.regexp_extract_all(body, F.lit(rf"(?s)<{name}\b[^>]*>.*?</{name}>"), F.lit(0))


def pieces(body: Column) -> Column:
    """Opening tags, each with the text up to the next tag."""
    return F.regexp_extract_all(body, F.lit("<[A-Za-z][^>]*>[^<]*"), F.lit(0))


def text_behind(piece: Column) -> Column:
    return F.btrim(F.substring_index(piece, ">", -1), F.lit(BLANKS))


def has_class(tag: Column, *names: str) -> Column:
    """The tag's class list holds every name."""
    own = F.split(attribute(tag, "class"), r"\s+")
    return F.size(F.array_intersect(own, F.array(*[F.lit(n) for n in names]))) == len(set(names))


def page_player(link: Column) -> Column:
    """Player of a link to a player's battles, empty when it is none: the path part between the two words."""
    parts = F.split(F.coalesce(link, F.lit("")), "/")
    at = F.array_position(parts, "player").cast("int")
    return F.when((at > 0) & F.get(parts, at + 1).startswith("battles"), F.get(parts, at)).otherwise(F.lit(""))


def strip_tag(tag: Column) -> Column:
    """Upper-cased player tag without blanks and leading ``#``; not validated."""
    return F.upper(F.regexp_replace(F.btrim(tag, F.lit(BLANKS)), "^#+", ""))


def player_tag(tag: Column) -> Column:
    """Normalized player tag, null when it is not one."""
    cleaned = strip_tag(tag)
    return F.when(cleaned.rlike(V.PLAYER_PATTERN), cleaned)


def season_id(value: Column) -> Column:
    return F.when(value.rlike(V.SEASON_PATTERN), value)


def digits_to_int(text: Column) -> Column:
    """BIGINT of an ASCII digit string, else null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def split_tags(text: Column) -> Column:
    """Comma list without empty entries."""
    return F.filter(F.split(text, ","), lambda x: x != "")


def is_url(value: Column) -> Column:
    return value.startswith("http://") | value.startswith("https://")


def safe_identifier(value: Column) -> Column:
    """File-name-safe identifier, at most 100 characters."""
    cleaned = F.substring(F.regexp_replace(value, "[^a-zA-Z0-9_-]", "_"), 1, 100)
    return F.when(F.length(cleaned) > 0, cleaned).otherwise(F.lit("unknown"))
