import pytest
from pyspark.sql import functions as F

from matchloom.functions import coords, keys, text, times, urls


@pytest.mark.parametrize("slug, base, form", [
    ("Knight-ev1", "knight", "ev1"), ("knight-hero", "knight", "hero"), ("knight", "knight", "base"), ("ev1", "ev1", "base"),
])
def test_slugs(one, slug, base, form):
    assert one(text.base_slug(F.col("s")), text.card_form(F.col("s")), s=slug) == (base, form)


@pytest.mark.parametrize("raw, tag", [(" #ab3 ", "AB3"), ("##abc", "ABC"), ("ab", None), ("a b c", None), ("A" * 33, None)])
def test_player_tag(one, raw, tag):
    assert one(text.player_tag(F.col("t")), t=raw) == tag


@pytest.mark.parametrize("x, y, i, expected", [
    (8499, 500, 0, (9501, 31500, None)), (8000, 600, 1, (8000, 600, None)), (1, 1, 2, (None, None, "orientation_invalid")),
    (18001, 0, 1, (18001, 0, "coordinate_out_of_bounds")),
])
def test_orientation(one, x, y, i, expected):
    c = [F.col(n) for n in "xyi"]
    assert one(coords.oriented_x(c[0], c[2]), coords.oriented_y(c[1], c[2]), coords.orientation_error(*c), x=x, y=y, i=i) == expected


def test_rounding_equals_binary_half_even(spark):
    """Every tile and normalized coordinate rounds as the binary quotient does."""
    df = spark.range(0, 18001).select("id", coords.ratio_rounded(F.col("id"), 1000, 1).alias("t"), coords.ratio_rounded(F.col("id"), 18000, 4).alias("n"))
    assert [(r.t, r.n) for r in df.orderBy("id").collect()] == [(round(x / 1000, 1), round(x / 18000, 4)) for x in range(18001)]
    df = spark.range(0, 32001).select("id", coords.ratio_rounded(F.col("id"), 32000, 4).alias("n"), coords.ratio_rounded(F.col("id"), 1000, 1).alias("t"))
    assert [(r.n, r.t) for r in df.orderBy("id").collect()] == [(round(y / 32000, 4), round(y / 1000, 1)) for y in range(32001)]


@pytest.mark.parametrize("raw, seconds", [
    ("1700000000", 1700000000), ("1700000000123", 1700000000), ("0", None), ("1.0", None), ("true", None), ("-5", None), ("9" * 25, None),
])
def test_epoch_seconds(one, raw, seconds):
    assert one(times.epoch_seconds(F.col("r")), r=raw) == seconds


@pytest.mark.parametrize("moment, season", [
    ("2024-07-01 08:59:59", "2024-05"), ("2024-07-01 09:00:00", "2024-06"), ("2024-09-01 12:00:00", "2024-07"), ("2024-09-02 09:00:00", "2024-08"),
    ("2024-01-15 00:00:00", "2023-12"),
])
def test_finished_season(one, moment, season):
    assert one(times.latest_finished_season(F.col("m").cast("timestamp")), m=moment) == season


@pytest.mark.parametrize("text_, epoch", [
    ("2024-01-01T00:00:00Z", 1704067200), ("2024-01-01T02:00:00+02:00", 1704067200), ("2024-01-01T00:00:00", None), ("2024-01-01T00:00:00.5Z", None), ("x", None),
])
def test_iso_epoch(one, text_, epoch):
    assert one(times.iso_epoch(F.col("t")), t=text_) == epoch


@pytest.mark.parametrize("url, low, closed, inside", [
    (None, 100, False, True), ("100", 100, False, True), ("100", 100, True, False), ("junk", 100, False, False), ("junk", None, False, True), ("99", 100, False, False),
])
def test_page_window(one, url, low, closed, inside):
    assert one(times.page_in_window(F.lit(url).cast("string"), low, closed)) is inside


@pytest.mark.parametrize("url, canonical", [
    ("HTTP://Site.Example/player/abc/battles/#x", "http://site.example/player/ABC/battles"),
    ("http://s.example/a?b=2&a=1&a=&c", "http://s.example/a?a=&a=1&b=2&c="),
    ("http://s.example/a?q=a%20b~*", "http://s.example/a?q=a+b~%2A"),
    ("http://s.example", "http://s.example"),
])
def test_canonical_url(one, url, canonical):
    assert one(urls.canonical_url(F.col("u")), u=url) == canonical


def test_query_param_takes_first_value_decoded(one):
    assert one(urls.query_param(F.col("u"), "tag"), u="http://a b/p?x=1&tag=&tag=A%2CB&tag=C#tag=D") == "A,B"
    assert one(urls.query_param(F.col("u"), "none"), u="http://a/p?x=1") is None


def test_player_list_urls(one):
    allowed = lambda u: one(F.coalesce(urls.player_list_url_allowed(F.col("u"), F.lit("ABC"), "http://s.example"), F.lit(False)), u=u)
    assert allowed("http://s.example/player/ABC/battles") and allowed("http://s.example/player/ABC/battles/history?before=1")
    for bad in ("http://s.example/player/XYZ/battles", "https://s.example/player/ABC/battles", "http://u:p@s.example/player/ABC/battles", "http://s.example/player/ABC/battles/x"):
        assert not allowed(bad)


def test_storage_identity(one):
    assert one(keys.storage_prefix(F.lit(None).cast("string"), F.col("u")), u="http://s/none") == "xx"
    assert one(keys.storage_identity(F.lit(None).cast("string"), F.col("u")), u="http://s/r?tag=../B1") == "___B1"
