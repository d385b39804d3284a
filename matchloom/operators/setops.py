"""Set steps of seed refreshes and exclusion imports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_tags(pages: list[DataFrame]) -> DataFrame:
    out = pages[0].select("tag")
    for p in pages[1:]:
        out = out.unionByName(p.select("tag"))
    return out.distinct()


def unseen(tags: DataFrame, seen: DataFrame) -> DataFrame:
    return tags.select("tag").distinct().join(seen.select("tag"), "tag", "left_anti")


def previously_seen(tags: DataFrame, seen: DataFrame) -> DataFrame:
    return tags.select("tag").intersect(seen.select("tag"))


def choose_seeds(tags: DataFrame, seen: DataFrame, minimum_unseen: int) -> DataFrame:
    """Unseen tags when there are enough of them, else all. The switch is a one-row
    aggregate read inside the query, not a driver decision."""
    marked = tags.select("tag").distinct().join(
        seen.select("tag").distinct().withColumn("_seen", F.lit(True)), "tag", "left"
    ).withColumn("is_unseen", F.col("_seen").isNull()).drop("_seen")
    enough = marked.agg((F.count_if("is_unseen") >= minimum_unseen).alias("e")).scalar()
    return marked.filter(F.col("is_unseen") | ~enough).select("tag")


def completed_battles(tasks: DataFrame, decisions: DataFrame) -> DataFrame:
    """Battles an earlier run finished: done details and accepted decisions, nothing pending."""
    done = tasks.filter((F.col("kind") == "detail") & (F.col("status") == "done") & F.col("dedup_key").startswith("battle:")).select(
        F.expr("substring(dedup_key, 8)").alias("battle_tag"))
    accepted = decisions.filter(F.col("status") == "accepted").select("battle_tag")
    return done.unionByName(accepted).distinct()


def seen_players(list_urls: DataFrame) -> DataFrame:
    tag = F.upper(F.regexp_extract("url", "/player/([A-Za-z0-9]{3,})/battles", 1))
    return list_urls.select(tag.alias("tag")).filter("tag != ''").distinct()
