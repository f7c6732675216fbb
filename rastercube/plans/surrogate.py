"""The raster model over the test tables: a 16 x 16 grid, 83 months, four integer bands.

Its SQL is in queries.py. Cell-months without line items are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions.scalar import pixel_centre
from rastercube.operators import landcover, partition, sequence, stats, tiles
from rastercube.sources import scratch, sinks

G, MONTHS, FIRST_YEAR = 16, 83, 1995
SIZE, STRIDE, PURITY, LENGTH = 3, 2, 0.90, 12
TEST, VAL = 0.20, 0.15
DYNAMIC, STATIC = ["price", "qty", "disc"], ["tax"]
BANDS = [*DYNAMIC, *STATIC]
#: A pixel is one unit wide; row 0 is the northernmost.
TRANSFORM = (1.0, 0.0, -0.5, 0.0, -1.0, 15.5)
CLASS_OF_PRIORITY = {"1-URGENT": 50, "2-HIGH": 10, "3-MEDIUM": 30, "4-NOT SPECIFIED": 40, "5-LOW": 80}
KNOWN_CLASSES = [10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 100]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """month_idx, row, col and four integer bands of the cell-months that have line items."""
    li = table(spark, sf_dir, "lineitem")
    when = (F.year("l_shipdate") - FIRST_YEAR) * 12 + F.month("l_shipdate") - 1
    whole = lambda c, k=1: F.sum(F.round(F.col(c) * k).cast("long"))
    cells = li.groupBy(when.cast("int").alias("month_idx"), (F.col("l_orderkey") % G).cast("int").alias("row"), (F.col("l_partkey") % G).cast("int").alias("col"))
    return cells.agg(whole("l_extendedprice").alias("price"), whole("l_quantity").alias("qty"), whole("l_discount", 100).alias("disc"), whole("l_tax", 100).alias("tax"))


_written: dict[tuple[str, str], str] = {}


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw() as a stored cube, by month and in tile order: scans of it prune months and skip row groups.

    A cube is data at rest; the first query of a session over some tables writes it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    rows = raw(spark, sf_dir)
    if key not in _written:
        path = scratch.folder(spark, "cube")
        sinks.cube(rows, path, SIZE)
        _written[key] = path
    return spark.read.schema(rows.schema).parquet(_written[key]).select(*rows.columns)


def labels() -> list[str]:
    return [f"{FIRST_YEAR + i // 12}-{i % 12 + 1:02d}" for i in range(MONTHS)]


def months(spark: SparkSession) -> DataFrame:
    return spark.range(MONTHS).select(F.col("id").cast("int").alias("month_idx"))


def region(spark: SparkSession) -> DataFrame:
    """Pixels with x, y, in_region: a disc."""
    x, y = pixel_centre(F.col("row"), F.col("col"), TRANSFORM)
    r, c = 2 * F.col("row") - (G - 1), 2 * F.col("col") - (G - 1)
    return partition.pixels(spark, G, G).withColumn("x", x).withColumn("y", y).withColumn("in_region", r * r + c * c <= 225)


def split(spark: SparkSession, degrees: float = 0.0) -> DataFrame:
    return partition.directional_split(region(spark), TEST, VAL, degrees)


def assigned(spark: SparkSession) -> DataFrame:
    return tiles.assign(tiles.tile_counts(split(spark), G, G, SIZE, STRIDE), SIZE, PURITY)


def patches(spark: SparkSession) -> DataFrame:
    return tiles.patches(assigned(spark), SIZE)


def weights(spark: SparkSession) -> DataFrame:
    return tiles.weights(split(spark), patches(spark), G, G, SIZE, STRIDE)


def terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.temporal_mean(obs(spark, sf_dir).select("row", "col", *STATIC), STATIC)


def terrain_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static bands as exact numbers: the sum over months of each pixel."""
    return obs(spark, sf_dir).groupBy("row", "col").agg(F.sum("tax").alias("tax"))


def band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.train_stats(obs(spark, sf_dir), terrain_sums(spark, sf_dir), weights(spark), DYNAMIC, STATIC, MONTHS)


def samples(spark: SparkSession) -> DataFrame:
    return sequence.samples(patches(spark), labels(), LENGTH)


def fine_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, class on a 48 x 48 grid: of each cell the order with the least key decides."""
    o = table(spark, sf_dir, "orders")
    code = F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in CLASS_OF_PRIORITY.items()])
    first = F.min_by(code, F.col("o_orderkey"))
    return o.groupBy((F.col("o_orderkey") % 48).cast("int").alias("row"), (F.col("o_custkey") % 48).cast("int").alias("col")).agg(first.cast("int").alias("class"))


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landcover.majority(fine_cover(spark, sf_dir), 3)


def study(spark: SparkSession) -> DataFrame:
    return region(spark).filter("in_region").select("row", "col")


def urban(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landcover.urban(land(spark, sf_dir), study(spark))


def ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landcover.ring(urban(spark, sf_dir), 2**0.5, G, G)


def rural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landcover.rural(land(spark, sf_dir), ring(spark, sf_dir), study(spark))


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = region(spark).select("row", "col", F.col("in_region").alias("in_study"))
    return landcover.mask_table(grid, urban(spark, sf_dir), rural(spark, sf_dir))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path of a raster for each month that has line items, and of a file that is none."""
    li = table(spark, sf_dir, "lineitem")
    label = F.date_format("l_shipdate", "yyyy_MM")
    path = F.concat(F.lit("/cube/"), F.substring(label, 1, 4), F.lit("/Area_"), label, F.lit("_18features.tif"))
    return li.select(path.alias("path")).distinct().unionByName(spark.sql("select '/cube/readme_1995_01.txt' as path"))


#: A concave polygon with a hole, as doubled integer coordinates so that no centre meets a corner.
POLYGONS = [[[(1.25, 1.25), (14.25, 2.25), (12.25, 13.25), (7.25, 6.25), (2.25, 14.25)], [(4.25, 3.25), (6.25, 3.25), (6.25, 5.25), (4.25, 5.25)]], [[(10.25, 10.25), (15.25, 10.25), (15.25, 15.25)]]]
