import pytest
from markup_samples import SITE, block, el
from pyspark.sql import functions as F

from matchloom.plans import jobs


def body(cursor):
    link = "/player/AAA/battles/history" + ("" if cursor is None else f"?before={cursor}")
    return block() + el("a", "item", el("i", "angle right icon"), href=link)


@pytest.mark.parametrize("closed,page,at,cursor,error", [
    (False, 3, 1_800_000_000_000, 1_700_000_000_000, None),
    (False, 4, 1_800_000_000_000, 1_700_000_000_000, "page_ceiling"),
    (False, 3, 1_800_000_000_000, 1_800_000_000_001, "cursor_not_decreasing"),
    (False, 3, 1_800_000_000, 1_800_000_000_001, "cursor_not_decreasing"),  # seconds and milliseconds
    (False, 3, None, 1_800_000_000_001, None),  # the first link is an anchor
    (True, 3, 1_800_000_000_000, 0, "cursor_not_decreasing"),
])
def test_pages_that_are_not_followed_have_a_reason(spark, closed, page, at, cursor, error):
    url = f"{SITE}/player/AAA/battles" + ("" if at is None else f"/history?before={at}")
    pages = spark.createDataFrame([(url, 1, "AAA", page, 0, None, body(cursor), 200, "list", 0)], (
        "url string, seq bigint, owner string, page int, zero_new_chain int, previous_fingerprint string, body string, status int, lane string, fetched_at bigint"))
    battles = jobs.list_etl(pages, SITE)["battles"].withColumn("eligible", F.lit(True))
    known = spark.createDataFrame([], "battle_tag string")
    made = jobs.expand(pages.drop("status", "lane", "fetched_at"), battles, known, SITE, max_pages=4, closed_season=closed)
    row = made["navigation"].first()
    assert row.error == error and not row.cutoff
    assert made["history"].count() == (error is None)
