"""Counts per kind and status kept by signed changes, not by counting again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators import select
from matchloom.session import materialize
from matchloom.streaming.ingest import keep_unknown, run_available
from matchloom.streaming.store import Store


def counted_into(stream: DataFrame, root: str, checkpoint: str, key: str, by: list[str], seq: str = "seq") -> Store:
    """Fold a stream of states (``key``, ``by``, ``seq``) into the current rows and the number of rows per value of ``by``. A row that
    changes takes one from where it stood and adds one where it stands; only buckets of rows that change are read. An older
    state than the stored one changes nothing. Returns the store of the counts (``by``, ``n``)."""
    spark = stream.sparkSession
    rows, totals = Store(spark, f"{root}/rows", [key]), Store(spark, f"{root}/counts", by, buckets=1)

    def fold(batch: DataFrame, batch_id: int) -> None:
        newest = materialize(select.latest_by(batch.select(key, *by, seq), [key], seq), "newest")
        touched = rows.touched(newest)
        held = rows.read(touched, batch_id)
        held = newest.limit(0) if held is None else held
        stood = held.withColumnsRenamed({c: f"_was_{c}" for c in [*by, seq]}).withColumnRenamed(key, "_was_key")
        met = materialize(newest.join(stood, newest[key].eqNullSafe(stood["_was_key"]), "left").filter(
            F.col(f"_was_{seq}").isNull() | (F.col(seq) > F.col(f"_was_{seq}"))), "met")
        plus = met.select(*by, F.lit(1).alias("n"))
        minus = met.filter(F.col(f"_was_{seq}").isNotNull()).select(*[F.col(f"_was_{c}").alias(c) for c in by], F.lit(-1).alias("n"))
        changed = met.select(key, *by, seq)
        before = totals.read(before=batch_id)
        deltas = plus.unionByName(minus)
        summed = (deltas if before is None else deltas.unionByName(before)).groupBy(*by).agg(F.sum("n").cast("bigint").alias("n")).filter("n <> 0")
        totals.commit(batch_id, materialize(summed, "counts"), {0})
        rows.commit(batch_id, materialize(keep_unknown(held, changed, [key]).unionByName(changed), "rows"), touched)

    run_available(stream.writeStream.foreachBatch(fold), checkpoint)
    return totals
