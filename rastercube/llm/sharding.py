"""Proportional stratified interleaving of documents into shards (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.shared import BUCKETS, before, bucket_of, seeded


def interleave(docs: DataFrame, shards: int = 16, seed: int = 7, key: str = "doc_id", stratum: str = "source") -> DataFrame:
    """Assign every row a shard and a slot so that every shard has the corpus' mixture of strata.

    Rows of a stratum are put in the order of a seeded hash of their key; the row of rank r
    of n gets the fractional rank (r + u) / n, where u in [0, 1) is a seeded number of the
    stratum; all rows in the order of the fractional rank are cut into shards whose counts
    differ by one at most (law ``rows``). Any stretch of the order has a stratum's share to
    within one row, and strata of one row are spread over all shards.

    Both global orders are counted in buckets: by leading hash bits inside a stratum, by
    leading bits of the fractional rank over all. A bucket holds about 1/4096 of a stratum or
    of all rows, however many strata there are and whatever their sizes. Only key, stratum,
    size and checksum are shuffled; texts never are, however long.

    Returns key, source, size, text_crc32, law, shard, slot, grown_shard. A null stratum is a
    stratum of its own; a null text has size 1 and the checksum of no bytes; repeated rows
    and null keys keep one slot each; of equal ranks source, hash, key, checksum and size decide; an empty table gives no rows. Other columns are ignored.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(stratum).alias("source"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = rows.withColumn("_h", seeded(seed, F.col("doc_id"))).withColumn("_b", bucket_of(F.col("_h")))
    ties = ["_h", "doc_id", "text_crc32", "size"]
    rows = before(rows, ["source"], "_b", F.lit(1).cast("long"), [F.col(c) for c in ties], "_rank")
    # how many rows a stratum has: from its key column alone
    total = docs.groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("_n"))
    rows = rows.join(total, rows["source"].eqNullSafe(total["_s"])).drop("_s")
    start = seeded(seed + 1, F.col("source")).cast("double") / float(1 << 60)
    rows = rows.withColumn("_frac", (F.col("_rank").cast("double") + start) / F.col("_n").cast("double"))
    rows = rows.withColumn("_f", F.least(F.floor(F.col("_frac") * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    rows = before(rows, [], "_f", F.lit(1).cast("long"), [F.col("_frac"), F.col("source"), *[F.col(c) for c in ties]], "_at")
    rows = rows.withColumn("_all", docs.agg(F.count("*").alias("_all")).scalar())
    # shard i takes positions from ceil(i*N/shards) on
    rows = rows.withColumn("shard", F.expr(f"_at * {shards} div _all").cast("int"))
    first = F.expr(f"(cast(shard as bigint) * _all + {shards - 1}) div {shards}")
    return rows.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_at") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
