"""Readers of seeds, manifests, indexes, replays and earlier runs. They fail closed:
a malformed manifest stops the job before anything is written."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import schemas as S
from matchloom.functions import text as X
from matchloom.functions.expr import is_true, reasons
from matchloom.operators import select
from matchloom.operators.cohort import EvidenceError, require
from matchloom.session import folders, is_whole

CAMPAIGN_NAME = "[A-Za-z0-9][A-Za-z0-9_-]{0,63}"


def pages_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PAGES).parquet(path)


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """Archived pages, one file each; the file path stands in for the address."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.lit(200).alias("status"), F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("fetched_at"))


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed values with their file; blank lines and ``//`` or ``;`` comments are skipped."""
    line = F.btrim("value", F.lit(X.BLANKS))
    return spark.read.text(path).select(line.alias("value"), F.col("_metadata.file_path").alias("source")).filter(
        (F.col("value") != "") & ~F.col("value").startswith("//") & ~F.col("value").startswith(";"))


def _json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    lines = spark.read.text(path).filter(F.btrim("value") != "")
    parsed = lines.select(F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"), "value")
    return parsed.select("r.*", "value")


def exclusions(spark: SparkSession, path: str, expected_count: int | None = None) -> DataFrame:
    """Excluded battle tags; a missing tag, a repeated one or a wrong count stops the job."""
    rows = _json_lines(spark, path, S.EXCLUSIONS).select(F.btrim("battle_tag").alias("battle_tag"), "_bad", "value")
    missing = F.coalesce(F.col("battle_tag"), F.lit("")) == ""
    require(rows.filter(missing | F.col("_bad").isNotNull()).select("value"), "exclusion row without battle tag")
    require(rows.groupBy("battle_tag").count().filter("count > 1"), "exclusion manifest contains duplicate tags")
    tags = rows.select("battle_tag")
    if expected_count is not None and (found := tags.count()) != expected_count:
        raise EvidenceError(f"expected {expected_count} unique tags, got {found}")
    return tags


def upgrade_manifest(spark: SparkSession, path: str) -> DataFrame:
    rows = _json_lines(spark, path, S.UPGRADE_MANIFEST)
    require(rows.filter(F.col("_bad").isNotNull()).select("value"), "manifest row is not an object")
    return rows.drop("_bad", "value")


def index_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Index records and, apart from them, damaged lines."""
    rows = _json_lines(spark, path, S.INDEX)
    return rows.filter(F.col("_bad").isNull()).drop("_bad", "value"), rows.filter(F.col("_bad").isNotNull()).select("value")


def replay_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Replay documents of any schema version; fields a version lacks are null. A line that is no
    document stops the job that reads it."""
    return spark.read.schema(S.REPLAYS).option("mode", "FAILFAST").json(path).withColumn("source_path", F.col("_metadata.file_path"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of the files of a folder; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(
        "path", F.col("length").alias("size"), F.unix_micros("modificationTime").alias("mtime_us"))


def not_imported(spark: SparkSession, path: str, ledger: DataFrame) -> DataFrame:
    """Files not in the ledger with this very size and modification time."""
    return _files(spark, path).join(ledger.select("path", "size", "mtime_us"), ["path", "size", "mtime_us"], "left_anti")


def import_new(spark: SparkSession, path: str, ledger: str, into: str, parse: Callable[[DataFrame], DataFrame]) -> int:
    """Load the files of a folder that were not imported before, each once, in three steps that a failure may cut anywhere: the files are claimed
    under a number, ``parse`` turns their paths and lines (``path``, ``value``) into rows written under that number, and the claim is recorded in the
    ledger. A claim without its record is done again as claimed, replacing its rows. Returns how many files the ledger gained."""
    claims = f"{ledger}/claims"
    recorded = {int(n.split("=")[1]) for n in folders(spark, f"{ledger}/done") if is_whole(spark, f"{ledger}/done/{n}")}
    claimed = {int(n.split("=")[1]) for n in folders(spark, claims) if is_whole(spark, f"{claims}/{n}")}
    gained = 0
    for number in sorted(claimed - recorded):
        gained += _imported(spark, number, ledger, into, parse)
    known = spark.read.parquet(*[f"{ledger}/done/n={n}" for n in recorded | claimed]) if recorded | claimed else None
    fresh = _files(spark, path) if known is None else not_imported(spark, path, known)
    number = max(claimed | recorded, default=-1) + 1
    fresh.write.mode("overwrite").parquet(f"{claims}/n={number}")
    return gained + _imported(spark, number, ledger, into, parse)


def _imported(spark: SparkSession, number: int, ledger: str, into: str, parse: Callable[[DataFrame], DataFrame]) -> int:
    files = spark.read.parquet(f"{ledger}/claims/n={number}")
    names = [r.path for r in files.select("path").collect()]
    if names:
        lines = spark.read.text(names).select(F.col("_metadata.file_path").alias("path"), "value")
        parse(lines).write.mode("overwrite").parquet(f"{into}/n={number}")
    files.write.mode("overwrite").parquet(f"{ledger}/done/n={number}")
    return len(names)


def frozen_contract(stored: DataFrame, payload: DataFrame, n_tasks: int) -> DataFrame:
    """The campaign's payload row to store; a changed one, or an old queue without one,
    stops the job."""
    wanted = payload.select("name", F.col("payload").alias("wanted"))
    require(stored.join(wanted, "name").filter("payload <> wanted").select("name"),
            "campaign conditions are frozen; use a new campaign name")
    fresh = select.keep_absent(payload, stored, ["name"])
    if n_tasks and fresh.limit(1).count():
        raise EvidenceError("an old queue without a contract cannot become a new campaign")
    return fresh


def one_contract(decisions: DataFrame, contract_sha256: str) -> None:
    """A store holds decisions of one contract only."""
    other = decisions.filter(~F.col("contract_sha256").eqNullSafe(F.lit(contract_sha256)))
    require(other.groupBy("contract_sha256").count(), f"decisions pinned to another contract than {contract_sha256}")


def campaign_faults(name: Column, low: Column, high: Column, has_roster: Column, discover: Column) -> Column:
    """The same rules for a table of campaigns: an array of what is wrong with each."""
    return reasons(
        (~is_true(name.rlike(f"^{CAMPAIGN_NAME}\\z")),"campaign_name_invalid"),
        (is_true(low >= high), "time_bounds_empty"),
        (is_true(has_roster) & (low.isNull() | high.isNull()), "roster_needs_time_bounds"),
        (is_true(has_roster) & is_true(discover), "roster_forbids_discovery"))


def campaign_problems(name: str, low: int | None, high: int | None, has_roster: bool, discover: bool) -> list[str]:
    """Input rules of a campaign."""
    found = []
    if not re.fullmatch(CAMPAIGN_NAME, name):
        found.append("campaign_name_invalid")
    if low is not None and high is not None and low >= high:
        found.append("time_bounds_empty")
    if has_roster and (low is None or high is None):
        found.append("roster_needs_time_bounds")
    if has_roster and discover:
        found.append("roster_forbids_discovery")
    return found
