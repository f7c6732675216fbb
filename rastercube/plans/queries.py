"""The operators as queries over the test tables, each beside its SQL twin for another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions import scalar as fx
from rastercube.operators import landcover, metrics, partition, sequence, stats, tiles, verify
from rastercube.operators import samples as rebuild
from rastercube.plans import surrogate as s
from rastercube.sources import catalog, geotiff

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# ---- SQL that the twins share: named sub-queries, each with what it needs ---------------------

_Q_TEST, _Q_VAL = 1 - s.TEST, 1 - s.VAL / (1 - s.TEST)
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "obs": ("""SELECT CAST((year(l_shipdate)-1995)*12+month(l_shipdate)-1 AS INT) AS month_idx, CAST(l_orderkey%16 AS INT) AS "row", CAST(l_partkey%16 AS INT) AS col,
        CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) AS BIGINT) AS price, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS qty,
        CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS BIGINT) AS disc, CAST(sum(CAST(round(l_tax*100) AS BIGINT)) AS BIGINT) AS tax FROM lineitem GROUP BY ALL""", ()),
    "fl": ("""SELECT DISTINCT '/cube/'||strftime(l_shipdate,'%Y')||'/Area_'||strftime(l_shipdate,'%Y_%m')||'_18features.tif' AS path, CAST(year(l_shipdate) AS INT) AS "year", CAST(month(l_shipdate) AS INT) AS "month" FROM lineitem""", ()),
    "px": ("""SELECT CAST(i//16 AS INT) AS "row", CAST(i%16 AS INT) AS col, CAST(i%16 AS DOUBLE) AS x, CAST(15-i//16 AS DOUBLE) AS y, (2*(i//16)-15)*(2*(i//16)-15)+(2*(i%16)-15)*(2*(i%16)-15)<=225 AS in_region FROM range(256) t(i)""", ()),
    "tc": (f"SELECT quantile_cont(y, {_Q_TEST!r}) AS q FROM px WHERE in_region", ("px",)),
    "vc": (f"SELECT quantile_cont(x, {_Q_VAL!r}) AS q FROM px WHERE in_region AND y < (SELECT q FROM tc)", ("px", "tc")),
    "sp": ("SELECT px.*, CAST(CASE WHEN NOT in_region THEN 0 WHEN y>=(SELECT q FROM tc) THEN 3 WHEN x>=(SELECT q FROM vc) THEN 2 ELSE 1 END AS INT) AS split_id FROM px", ("px", "tc", "vc")),
    "st": ("SELECT CAST(i AS INT) AS s FROM range(0,14,2) t(i) UNION ALL SELECT 13", ()),
    "tl": ("""SELECT a.s AS row_off, b.s AS col_off, count(*) FILTER (WHERE split_id=1) AS n_train, count(*) FILTER (WHERE split_id=2) AS n_val, count(*) FILTER (WHERE split_id=3) AS n_test
        FROM st a, st b, sp WHERE sp."row" BETWEEN a.s AND a.s+2 AND sp.col BETWEEN b.s AND b.s+2 GROUP BY ALL""", ("st", "sp")),
    "ag": ("SELECT *, CASE WHEN n_train>=9 THEN 'train' WHEN n_val>=9 THEN 'val' WHEN n_test>=9 THEN 'test' END AS split FROM tl", ("tl",)),
    "pt": ("""SELECT CAST(row_number() OVER (ORDER BY row_off,col_off)-1 AS INT) AS patch_id, split, row_off, col_off, 3 AS height, 3 AS width,
        round_even(CASE split WHEN 'train' THEN n_train WHEN 'val' THEN n_val ELSE n_test END/9.0::DOUBLE, 6) AS purity, n_train, n_val, n_test FROM ag WHERE split IS NOT NULL""", ("ag",)),
    "w": ("""SELECT sp."row", sp.col, count(*) AS w FROM sp, pt WHERE split_id=1 AND split='train' AND sp."row" BETWEEN row_off AND row_off+2 AND sp.col BETWEEN col_off AND col_off+2 GROUP BY ALL""", ("sp", "pt")),
    "tr": ("""SELECT "row", col, CAST(sum(tax) AS BIGINT) AS tax FROM obs GROUP BY ALL""", ("obs",)),
    "lg": ("""SELECT 'price' AS channel, price AS v, w, 83 AS m FROM obs JOIN w USING("row",col) UNION ALL SELECT 'qty', qty, w, 83 FROM obs JOIN w USING("row",col)
        UNION ALL SELECT 'disc', disc, w, 83 FROM obs JOIN w USING("row",col) UNION ALL SELECT 'tax', tax, w, 1 FROM tr JOIN w USING("row",col)""", ("obs", "tr", "w")),
    "su": ("SELECT channel, CAST(sum(w) AS BIGINT) AS n, CAST(sum(v*w) AS DOUBLE) AS total, CAST(sum(v*v*w) AS DOUBLE) AS squares, any_value(m) AS m FROM lg GROUP BY channel", ("lg",)),
    "sd": ("SELECT channel, n, CAST(m*(SELECT sum(w) FROM w) AS BIGINT) AS n_max, total/n AS mean, sqrt(greatest(squares/n-(total/n)*(total/n),0)) AS raw FROM su", ("su", "w")),
    "bs": ("SELECT channel, n, n_max, mean, CASE WHEN raw<=1e-8 THEN 1.0 ELSE raw END AS std, mean AS fill, 1.0::DOUBLE-n/n_max AS gap_fraction, raw<=1e-8 AS degenerate, 1.0::DOUBLE-n/n_max>0.10::DOUBLE AS over_gap FROM sd", ("sd",)),
    "sm": ("""SELECT CAST(patch_id AS BIGINT)*71+i AS sample_id, split, patch_id, row_off, col_off, height, width, CAST(i AS INT) AS seq_start_index,
        list_transform(range(i,i+12), lambda k: CAST(k AS INT)) AS input_month_indices, CAST(i+12 AS INT) AS target_month_index,
        list_transform(range(i,i+12), lambda k: printf('%04d-%02d', 1995+k//12, k%12+1)) AS input_months, printf('%04d-%02d', 1995+(i+12)//12, (i+12)%12+1) AS target_month FROM pt, range(71) t(i)""", ("pt",)),
    "fc": ("""SELECT CAST(o_orderkey%48 AS INT) AS "row", CAST(o_custkey%48 AS INT) AS col, arg_min(CASE o_orderpriority WHEN '1-URGENT' THEN 50 WHEN '2-HIGH' THEN 10 WHEN '3-MEDIUM' THEN 30 WHEN '4-NOT SPECIFIED' THEN 40 ELSE 80 END, o_orderkey) AS class FROM orders GROUP BY ALL""", ()),
    "vt": ("""SELECT CAST("row"//3 AS INT) AS "row", CAST(col//3 AS INT) AS col, class, count(*) AS n FROM fc GROUP BY ALL""", ("fc",)),
    "ld": ("""SELECT "row", col, CAST(class AS INT) AS class FROM (SELECT *, row_number() OVER (PARTITION BY "row",col ORDER BY n DESC, class) AS k FROM vt) WHERE k=1""", ("vt",)),
    "ur": ("""SELECT "row", col FROM ld JOIN px USING("row",col) WHERE class=50 AND in_region""", ("ld", "px")),
    "rg": ("""SELECT "row", col FROM px p WHERE EXISTS (SELECT 1 FROM ur u WHERE (u."row"-p."row")*(u."row"-p."row")+(u.col-p.col)*(u.col-p.col) BETWEEN 1 AND 2) AND NOT EXISTS (SELECT 1 FROM ur u WHERE u."row"=p."row" AND u.col=p.col)""", ("px", "ur")),
    "rl": ("""SELECT "row", col FROM ld JOIN px USING("row",col) JOIN rg USING("row",col) WHERE in_region AND class IN (10,20,30,40,60)""", ("ld", "px", "rg")),
    "mk": ("""SELECT "row", col, in_region AS in_study, EXISTS (SELECT 1 FROM ur u WHERE u."row"=p."row" AND u.col=p.col) AS is_urban, EXISTS (SELECT 1 FROM rl u WHERE u."row"=p."row" AND u.col=p.col) AS is_rural FROM px p""", ("px", "ur", "rl")),
    "mv": ("""SELECT mk.*, CAST(qty AS DOUBLE) AS value FROM mk JOIN obs USING("row",col) WHERE month_idx=40""", ("mk", "obs")),
    "dn": ("""SELECT p."row", p.col, CAST(m.i AS INT) AS month_idx, o.price, o.qty, o.disc, o.tax FROM px p CROSS JOIN range(83) m(i) LEFT JOIN obs o ON o."row"=p."row" AND o.col=p.col AND o.month_idx=m.i""", ("px", "obs")),
}


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in _PARTS[name][1]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(f"{n} AS ({_PARTS[n][0]})" for n in order) + "\n" if order else "") + body


def query(name: str, sql: str | None = None, *needs: str):
    """Register a query and, where another engine can express it, its SQL twin."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = _with(sql, *needs)
        return f

    return put


# ---- M0: the flagship ------------------------------------------------------------------------


@query("q31_train_stats", "SELECT * FROM bs", "bs")
def _(spark, d):
    return s.band_stats(spark, d)


# ---- catalogue -------------------------------------------------------------------------------


@query("q01_month_discovery", 'SELECT path, "year", "month" FROM fl', "fl")
def _(spark, d):
    return catalog.discover(s.files(spark, d))


@query("q02_duplicate_months", 'SELECT "year", "month", count(*) AS files FROM (SELECT * FROM fl UNION ALL SELECT * FROM fl WHERE "month"=3) GROUP BY ALL HAVING count(*)>1', "fl")
def _(spark, d):
    found = catalog.discover(s.files(spark, d))
    return catalog.duplicates(found.unionByName(found.filter("month = 3")))


@query("q03_chronological_ids", """SELECT CAST(row_number() OVER (ORDER BY "year","month")-1 AS INT) AS month_idx, "year", "month", printf('%04d-%02d',"year","month") AS label, path FROM fl""", "fl")
def _(spark, d):
    return catalog.with_index(catalog.discover(s.files(spark, d)))


@query("q04_month_calendar", """SELECT CAST(m//12 AS INT) AS "year", CAST(m%12+1 AS INT) AS "month", printf('%04d-%02d',m//12,m%12+1) AS label FROM (SELECT unnest(range(min("year"*12+"month"-1), max("year"*12+"month"-1)+1)) AS m FROM fl)""", "fl")
def _(spark, d):
    return catalog.calendar(catalog.discover(s.files(spark, d)).filter("month <> 6"))


@query("q28_missing_months", """SELECT printf('%04d-%02d',"year","month") AS label FROM fl WHERE "month"=6 AND "year"*12+"month" BETWEEN (SELECT min("year"*12+"month") FROM fl WHERE "month"<>6) AND (SELECT max("year"*12+"month") FROM fl WHERE "month"<>6)""", "fl")
def _(spark, d):
    return catalog.missing(catalog.discover(s.files(spark, d)).filter("month <> 6"))


def _metadata(spark, d):
    """What the reader says of a small raster for each month; some years' end months are odd ones."""
    import numpy as np
    import pyarrow as pa

    def made(batches):
        for b in batches:
            out = []
            for m in b.column(1).to_pylist():
                names = {10: None, 11: ["b", "a"]}.get(m, ["a", "b"])
                out.append(geotiff.write(np.zeros((2, 3, 4), np.float32), (30.0, 0.0, 757951.0 if m == 12 else 757950.0, 0.0, -30.0, 1458780.0), names, 32643))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["path", "content"])

    found = catalog.discover(s.files(spark, d)).select("path", "month")
    return geotiff.metadata(found.mapInArrow(made, "path string, content binary"))


@query("q05_grid_homogeneity", """SELECT 4 AS width, 3 AS height, 2 AS bands, 'EPSG:32643' AS crs, 'float32' AS dtype, CASE WHEN "month"=12 THEN 757951.0 ELSE 757950.0 END::DOUBLE AS origin,
    CASE "month" WHEN 10 THEN ',' WHEN 11 THEN 'b,a' ELSE 'a,b' END AS names, count(*) AS files FROM fl GROUP BY ALL""", "fl")  # fmt: skip
def _(spark, d):
    names = F.array_join("descriptions", ",", "").alias("names")
    return catalog.grid_groups(_metadata(spark, d)).select("width", "height", F.col("count").alias("bands"), "crs", "dtype", F.col("transform")[2].alias("origin"), names, "files")


@query("q06_band_order", """SELECT CASE "month" WHEN 10 THEN 'unnamed' WHEN 11 THEN 'differs' ELSE 'ok' END AS status, count(*) AS files FROM fl GROUP BY ALL""", "fl")
def _(spark, d):
    return catalog.band_order(_metadata(spark, d), ["a", "b"]).groupBy("status").agg(F.count("*").alias("files"))


@query("q10_legend", """SELECT * FROM (VALUES ('a',10,'Tree cover','V2.0.0','tag'),('a',50,'Built-up','V2.0.0','tag'),('a',80,'Permanent water bodies','V2.0.0','tag'),('b',50,'Built-up','unknown','fallback')) t(raster,class,label,version,source)""")
def _(spark, d):
    import numpy as np

    tags = {"legend": "10 Tree cover\n\n50   Built-up\nnone\n 80 Permanent water bodies ", "product_version": "V2.0.0"}
    rows = [(k, bytearray(geotiff.write(np.zeros((1, 2, 2), np.uint8), tags=t))) for k, t in (("a", tags), ("b", {"legend": "none"}))]
    tag = geotiff.tags(spark.createDataFrame(rows, "path string, content binary"))
    both = [catalog.legend(tag.filter(F.col("path") == k), {50: "Built-up"}).withColumn("raster", F.lit(k)) for k in "ab"]
    return both[0].unionByName(both[1])


# ---- scans -----------------------------------------------------------------------------------


@query("q07_window_scan", 'SELECT * FROM obs WHERE "row" BETWEEN 4 AND 6 AND col BETWEEN 10 AND 12', "obs")
def _(spark, d):
    return rebuild.window_scan(s.obs(spark, d), 4, 10, s.SIZE)


@query("q08_window_scan_bands", 'SELECT month_idx, "row", col, price, qty, disc FROM obs WHERE "row" BETWEEN 4 AND 6 AND col BETWEEN 10 AND 12 AND month_idx=7', "obs")
def _(spark, d):
    return rebuild.window_scan(s.obs(spark, d), 4, 10, s.SIZE, s.DYNAMIC, month=7)


@query("q09_window_scan_target", 'SELECT month_idx, "row", col, price FROM obs WHERE "row" BETWEEN 4 AND 6 AND col BETWEEN 10 AND 12 AND month_idx=19', "obs")
def _(spark, d):
    return rebuild.window_scan(s.obs(spark, d), 4, 10, s.SIZE, ["price"], month=7 + s.LENGTH)


@query("q11_index_scan", "SELECT sample_id, split, patch_id, target_month FROM sm WHERE split='val'", "sm")
def _(spark, d):
    return sequence.of_split(s.samples(spark), "val").select("sample_id", "split", "patch_id", "target_month").orderBy("sample_id")


# ---- scalar expressions ----------------------------------------------------------------------


@query("q12_pixel_centre", 'SELECT "row", col, 757950.0::DOUBLE+(col+0.5::DOUBLE)*30 AS x, 1458780.0::DOUBLE+("row"+0.5::DOUBLE)*-30 AS y FROM px', "px")
def _(spark, d):
    x, y = fx.pixel_centre(F.col("row"), F.col("col"), (30.0, 0.0, 757950.0, 0.0, -30.0, 1458780.0))
    return partition.pixels(spark, s.G, s.G).select("row", "col", x.alias("x"), y.alias("y"))


def _turn(degrees):
    import math

    return math.cos(math.radians(degrees)), math.sin(math.radians(degrees))


@query("q13_rotation", f'SELECT "row", col, x*{_turn(30)[0]!r}::DOUBLE-y*{_turn(30)[1]!r}::DOUBLE AS across, y*{_turn(30)[0]!r}::DOUBLE+x*{_turn(30)[1]!r}::DOUBLE AS along FROM px', "px")
def _(spark, d):
    across, along = fx.rotated(F.col("x"), F.col("y"), 30.0)
    return s.region(spark).select("row", "col", across.alias("across"), along.alias("along"))


@query("q14_previous_month", """SELECT printf('%04d-%02d',"year","month") AS label, strftime(make_date("year","month",1)-INTERVAL 1 MONTH,'%Y-%m') AS previous FROM fl""", "fl")
def _(spark, d):
    rows = catalog.with_index(catalog.discover(s.files(spark, d)))
    return rows.select("label", fx.previous_label(F.col("label")).alias("previous"))


@query("q15_finite", "SELECT CAST(l_linenumber AS INT) AS line, count(*) AS n, count(*) FILTER (WHERE l_discount>=0.03 AND l_discount<=0.07) AS finite FROM lineitem GROUP BY ALL")
def _(spark, d):
    raw = F.when(F.col("l_discount") < 0.03, F.lit(float("nan"))).when(F.col("l_discount") > 0.07, F.lit(float("inf"))).otherwise(F.col("l_discount"))
    rows = s.table(spark, d, "lineitem").select(F.col("l_linenumber").cast("int").alias("line"), fx.finite(raw).alias("v"))
    return rows.groupBy("line").agg(F.count("*").alias("n"), F.count("v").alias("finite"))


_LONG = " UNION ALL ".join(f"""SELECT month_idx, "row", col, '{c}' AS channel, CAST({'r.tax' if c == 'tax' else 'dn.' + c} AS DOUBLE) AS value FROM dn LEFT JOIN tr r USING("row",col)""" for c in s.BANDS)


@query("q16_fill_missing", f"""SELECT month_idx, "row", col, channel, coalesce(value,fill) AS filled FROM ({_LONG}) JOIN bs USING(channel)""", "dn", "tr", "bs")
def _(spark, d):
    return _normalised(spark, d).select("month_idx", "row", "col", "channel", "filled")


@query("q17_zscore", f"""SELECT month_idx, "row", col, channel, (coalesce(value,fill)-mean)/std AS z FROM ({_LONG}) JOIN bs USING(channel)""", "dn", "tr", "bs")
def _(spark, d):
    return _normalised(spark, d).select("month_idx", "row", "col", "channel", "z")


@query("q18_validity_mask", f"""SELECT month_idx, "row", col, channel, value IS NOT NULL AS mask FROM ({_LONG})""", "dn", "tr")
def _(spark, d):
    return _normalised(spark, d).select("month_idx", "row", "col", "channel", F.col("value").isNotNull().alias("mask"))


def _dense(spark, d):
    return rebuild.dense(s.obs(spark, d), s.region(spark), s.months(spark))


def _normalised(spark, d):
    """Every value of every band, static ones from the terrain, filled and normalised."""
    long = rebuild.melt(rebuild.static_override(_dense(spark, d), s.terrain_sums(spark, d), s.STATIC), s.BANDS)
    return rebuild.normalised(long, s.band_stats(spark, d))


@query("q19_std_guard", "SELECT channel, CASE WHEN raw<=1e-8 THEN 1.0 ELSE raw END AS std, raw<=1e-8 AS degenerate FROM (SELECT channel, raw FROM sd UNION ALL SELECT 'constant', 0.0)", "sd")
def _(spark, d):
    const = spark.createDataFrame([("constant", 10, 10, 50.0, 250.0)], "channel string, n long, n_max long, total double, squares double")
    sums = stats.weighted_sums(s.weights(spark), (s.obs(spark, d), s.DYNAMIC, s.MONTHS), (s.terrain_sums(spark, d), s.STATIC, 1)).unionByName(const)
    return stats.band_stats(sums).select("channel", "std", "degenerate")


@query("q20_gap_fraction", "SELECT channel, gap_fraction, over_gap FROM bs", "bs")
def _(spark, d):
    return s.band_stats(spark, d).select("channel", "gap_fraction", "over_gap")


# ---- split -----------------------------------------------------------------------------------


@query("q30_exact_quantile", "SELECT (SELECT q FROM tc) AS test_cut, (SELECT q FROM vc) AS val_cut", "tc", "vc")
def _(spark, d):
    region = s.region(spark).filter("in_region")
    cut = partition.quantile(region, F.col("y"), 1 - s.TEST)
    rest = region.filter(F.col("y") < cut.scalar())
    return cut.select(F.col("q").alias("test_cut"), partition.quantile(rest, F.col("x"), 1 - s.VAL / (1 - s.TEST)).scalar().alias("val_cut"))


@query("q30b_quantile_rotated", f"""SELECT round(quantile_cont(y*{_turn(30)[0]!r}::DOUBLE+x*{_turn(30)[1]!r}::DOUBLE, {_Q_TEST!r}), 9) AS q FROM px WHERE in_region""", "px")
def _(spark, d):
    _, along = fx.rotated(F.col("x"), F.col("y"), 30.0)
    return partition.quantile(s.region(spark).filter("in_region"), along, 1 - s.TEST).select(F.round("q", 9).alias("q"))


@query("q46_directional_split", 'SELECT "row", col, split_id FROM sp', "sp")
def _(spark, d):
    return s.split(spark).select("row", "col", "split_id")


@query("q35_split_counts", "SELECT split, count(split_id) AS pixels, count(split_id)*100.0::DOUBLE/(SELECT count(*) FROM sp WHERE split_id<>0) AS percent, count(split_id)*0.0009::DOUBLE AS area FROM (VALUES ('train',1),('val',2),('test',3)) t(split,id) LEFT JOIN sp ON split_id=id GROUP BY ALL", "sp")
def _(spark, d):
    return partition.split_counts(s.split(spark), 30 * 30 / 1e6)


_EDGES = ",".join(f"({p},{a[0]},{a[1]},{b[0]},{b[1]})" for p, rings in enumerate(s.POLYGONS) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


@query("q21_point_in_polygon", f"""SELECT "row", col, EXISTS (SELECT 1 FROM (SELECT p, count(*) AS k FROM (VALUES {_EDGES}) e(p,x1,y1,x2,y2) WHERE least(y1,y2)<=y AND y<greatest(y1,y2) AND x1::DOUBLE+(y-y1::DOUBLE)*(x2::DOUBLE-x1::DOUBLE)/(y2::DOUBLE-y1::DOUBLE)>x GROUP BY p) WHERE k%2=1) AS inside FROM px""", "px")
def _(spark, d):
    return partition.rasterize(s.region(spark), partition.edges(spark, s.POLYGONS), s.TRANSFORM, s.G).select("row", "col", "inside")


# ---- tiles -----------------------------------------------------------------------------------


@query("q22_tile_cover", 'SELECT a.s AS row_off, b.s AS col_off, "row", col FROM st a, st b, px WHERE "row" BETWEEN a.s AND a.s+2 AND col BETWEEN b.s AND b.s+2', "st", "px")
def _(spark, d):
    return tiles.cover(partition.pixels(spark, s.G, s.G), s.G, s.G, s.SIZE, s.STRIDE).select("row_off", "col_off", "row", "col")


@query("q32_tile_histogram", "SELECT * FROM ag", "ag")
def _(spark, d):
    return s.assigned(spark)


@query("q33_patch_summary", """SELECT count(*) AS candidates, count(split) AS accepted, count(*) FILTER (WHERE split IS NULL) AS rejected, count(*) FILTER (WHERE split IS NULL)/count(*) AS rejected_fraction,
    min(b) FILTER (WHERE split IS NULL)/9.0::DOUBLE AS purity_min, max(b) FILTER (WHERE split IS NULL)/9.0::DOUBLE AS purity_max, CAST(sum(b) FILTER (WHERE split IS NULL) AS DOUBLE)/(count(*) FILTER (WHERE split IS NULL)*9.0::DOUBLE) AS purity_mean FROM (SELECT *, greatest(n_train,n_val,n_test) AS b FROM ag)""", "ag")  # fmt: skip
def _(spark, d):
    return tiles.summary(s.assigned(spark), s.SIZE)


@query("q40_patch_ids", "SELECT * FROM pt", "pt")
def _(spark, d):
    return s.patches(spark)


@query("q36_counts_by_split", "SELECT split, (SELECT count(*) FROM pt WHERE pt.split=t.split) AS patches, (SELECT count(*) FROM pt WHERE pt.split=t.split)*71 AS samples FROM (VALUES ('train'),('val'),('test')) t(split)", "pt")
def _(spark, d):
    return tiles.by_split(s.patches(spark), "patches").withColumn("samples", F.col("patches") * (s.MONTHS - s.LENGTH))


@query("q22b_pixel_weights", 'SELECT * FROM w', "w")
def _(spark, d):
    return s.weights(spark)


# ---- statistics ------------------------------------------------------------------------------


@query("q29_temporal_mean", """SELECT "row", col, avg(tax) AS tax FROM obs GROUP BY ALL""", "obs")
def _(spark, d):
    return s.terrain(spark, d)


@query("q25_static_override", """SELECT month_idx, "row", col, price, CAST(t.tax AS BIGINT) AS tax FROM obs JOIN tr t USING("row",col)""", "obs", "tr")
def _(spark, d):
    cube = s.obs(spark, d)
    return rebuild.static_override(cube, s.terrain_sums(spark, d), s.STATIC).select("month_idx", "row", "col", "price", "tax")


@query("q26_band_join", """SELECT channel, count(*) AS n, count(*) FILTER (WHERE value>mean) AS above FROM (SELECT month_idx, 'price' AS channel, price AS value FROM obs UNION ALL SELECT month_idx, 'qty', qty FROM obs) JOIN bs b USING(channel) GROUP BY channel""", "obs", "bs")
def _(spark, d):
    long = rebuild.melt(s.obs(spark, d), ["price", "qty"])
    rows = rebuild.normalised(long, s.band_stats(spark, d))
    return rows.groupBy("channel").agg(F.count("*").alias("n"), F.count_if(F.col("z") > 0).alias("above"))


# ---- sequences -------------------------------------------------------------------------------


@query("q23_patch_month_cross", "SELECT patch_id, CAST(i AS INT) AS month_idx FROM pt, range(83) t(i)", "pt")
def _(spark, d):
    return s.patches(spark).select("patch_id", F.explode(F.sequence(F.lit(0), F.lit(s.MONTHS - 1))).alias("month_idx"))


@query("q24_sample_month_join", 'SELECT sample_id, t.i AS t, "year", "month" FROM (SELECT sample_id, unnest(range(12)) AS i, unnest(input_months) AS label FROM sm) t JOIN (SELECT DISTINCT "year","month",printf(\'%04d-%02d\',"year","month") AS label FROM fl) USING(label)'.replace("t.i AS t", "CAST(t.i AS INT) AS t"), "sm", "fl")
def _(spark, d):
    names = s.samples(spark).select("sample_id", F.posexplode("input_months").alias("t", "label"))
    month = catalog.with_index(catalog.discover(s.files(spark, d))).select("label", "year", "month")
    return names.join(F.broadcast(month), "label").select("sample_id", "t", "year", "month")


@query("q27_next_month", 'SELECT a.month_idx, a."row", a.col, a.price, b.price AS target FROM obs a LEFT JOIN obs b ON a."row"=b."row" AND a.col=b.col AND b.month_idx=a.month_idx+1', "obs")
def _(spark, d):
    return sequence.next_value(s.obs(spark, d), "price").select("month_idx", "row", "col", "price", "target")


@query("q39_sample_index", "SELECT * FROM sm", "sm")
def _(spark, d):
    return s.samples(spark)


@query("q39b_month_windows", 'SELECT "row", col, month_idx, list("price") OVER (PARTITION BY "row",col ORDER BY month_idx RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS "values" FROM obs', "obs")
def _(spark, d):
    return sequence.windows(s.obs(spark, d), "price", s.LENGTH)


@query("q44_sample_picks", "SELECT split, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sample_id)-1 AS k, count(*) OVER (PARTITION BY split) AS n FROM sm) WHERE k IN (0, n//2, n-1)", "sm")
def _(spark, d):
    return sequence.picks(s.samples(spark)).select("split", "sample_id")


# ---- reconstruction --------------------------------------------------------------------------

_X = """SELECT s.sample_id, CAST(k.i AS INT) AS t, c.ci AS channel_idx, c.channel, p."row"-s.row_off AS i, p.col-s.col_off AS j,
    (coalesce(CAST(CASE c.channel WHEN 'price' THEN o.price WHEN 'qty' THEN o.qty WHEN 'disc' THEN o.disc ELSE r.tax END AS DOUBLE),fill)-mean)/std AS z
    FROM sm s CROSS JOIN range(12) k(i) CROSS JOIN (VALUES (0,'price'),(1,'qty'),(2,'disc'),(3,'tax')) c(ci,channel)
    JOIN px p ON p."row" BETWEEN s.row_off AND s.row_off+2 AND p.col BETWEEN s.col_off AND s.col_off+2
    LEFT JOIN obs o ON o."row"=p."row" AND o.col=p.col AND o.month_idx=s.seq_start_index+k.i LEFT JOIN tr r ON r."row"=p."row" AND r.col=p.col JOIN bs USING(channel)"""


def _x(spark, d, of=rebuild.sample_values, sample=None):
    return of(s.samples(spark) if sample is None else sample, _dense(spark, d), s.terrain_sums(spark, d), s.band_stats(spark, d), s.BANDS, s.STATIC)


@query("q55_sample_values", _X, "sm", "px", "obs", "tr", "bs")
def _(spark, d):
    return _x(spark, d)


@query("q55b_sample_planes", f"""SELECT sample_id, t, channel_idx, list(z ORDER BY i,j) AS "values" FROM ({_X}) GROUP BY ALL""", "sm", "px", "obs", "tr", "bs")
def _(spark, d):
    return rebuild.tensors(_x(spark, d, rebuild.sample_planes))


_Y = """SELECT s.sample_id, s.split, s.patch_id, p."row"-s.row_off AS i, p.col-s.col_off AS j, (coalesce(CAST(o.price AS DOUBLE),fill)-mean)/std AS y, o.price IS NOT NULL AS mask, (CAST(o.price AS DOUBLE)-mean)/std AS expected FROM sm s
    JOIN px p ON p."row" BETWEEN s.row_off AND s.row_off+2 AND p.col BETWEEN s.col_off AND s.col_off+2 LEFT JOIN obs o ON o."row"=p."row" AND o.col=p.col AND o.month_idx=s.target_month_index, (SELECT * FROM bs WHERE channel='price') b"""


@query("q54_sample_targets", f"SELECT sample_id, i, j, y, mask FROM ({_Y})", "sm", "px", "obs", "bs")
def _(spark, d):
    return rebuild.targets(s.samples(spark), s.obs(spark, d), s.band_stats(spark, d), "price")


#: An index with faults: a month too few, a gap, a wrong target, wrong names, a repeated id.
_FAULTY = """SELECT CASE WHEN sample_id%17=0 THEN sample_id+1 ELSE sample_id END AS id, CASE WHEN sample_id%7=0 THEN input_month_indices[1:11] WHEN sample_id%11=0 THEN list_transform(input_month_indices, lambda v, i: CASE WHEN i>6 THEN v+1 ELSE v END) ELSE input_month_indices END AS m,
    CASE WHEN sample_id%13=0 THEN target_month_index+1 ELSE target_month_index END AS t, CASE WHEN sample_id%19=0 THEN list_transform(input_months, lambda x: '1999-01') ELSE input_months END AS names, target_month FROM sm"""


def _faulty(spark):
    at = F.col("sample_id")
    months, names = F.col("input_month_indices"), F.col("input_months")
    moved = F.transform(months, lambda v, i: F.when(i >= 6, v + 1).otherwise(v))
    return s.samples(spark).withColumns({
        "input_month_indices": F.when(at % 7 == 0, F.slice(months, 1, 11)).when(at % 11 == 0, moved).otherwise(months),
        "target_month_index": F.when(at % 13 == 0, F.col("target_month_index") + 1).otherwise(F.col("target_month_index")),
        "input_months": F.when(at % 19 == 0, F.transform(names, lambda _: F.lit("1999-01"))).otherwise(names),
        "sample_id": F.when(at % 17 == 0, at + 1).otherwise(at),
    })


@query("q54b_index_checks", f"""SELECT count(*) AS samples, count(*) FILTER (WHERE len(m)<>12) AS bad_length, count(*) FILTER (WHERE len(list_filter(range(1,len(m)), lambda k: m[k+1]-m[k]<>1))>0) AS gaps, count(*) FILTER (WHERE m[-1]+1<>t) AS bad_target,
    count(*) FILTER (WHERE names[-1]<>strftime(CAST(target_month||'-01' AS DATE)-INTERVAL 1 MONTH,'%Y-%m')) AS bad_last_month, count(*) FILTER (WHERE names<>list_transform(m, lambda k: printf('%04d-%02d', 1995+k//12, k%12+1))) AS bad_labels, count(*)-count(DISTINCT id) AS repeated_ids FROM ({_FAULTY})""", "sm")  # fmt: skip
def _(spark, d):
    return verify.index_report(_faulty(spark), s.LENGTH, s.labels())


#: Samples with faults in what a build would hold: a plane too few, a NaN, a flipped mask, a shifted value.
@query("q55c_verify_samples", f"""SELECT * FROM (WITH pick AS (SELECT sample_id, split, patch_id FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sample_id)-1 AS k, count(*) OVER (PARTITION BY split) AS n FROM sm) WHERE k IN (0, n//4, n//2, 3*n//4, n-1)),
    y AS (SELECT *, CASE WHEN sample_id%5=1 AND i=0 AND j=0 THEN NOT mask ELSE mask END AS m, CASE WHEN sample_id%3=0 AND i=2 AND j=1 THEN y+0.5 ELSE y END AS v FROM ({_Y}) JOIN (SELECT sample_id FROM pick) USING(sample_id)),
    w AS (SELECT sample_id, count(*) FILTER (WHERE m<>mask) AS masks_wrong, count(*) FILTER (WHERE expected IS NOT NULL AND abs(v-expected)>1e-6) AS off, max(abs(v-expected)) AS diff, count(*) FILTER (WHERE m) AS ok, count(*) AS cells FROM y GROUP BY sample_id),
    p AS (SELECT pick.*, masks_wrong, off, diff, ok, cells, sample_id%4=2 AS short, sample_id%2=0 AS has_nan FROM pick JOIN w USING(sample_id))
    SELECT split, count(*) AS samples, count(*) FILTER (WHERE short) AS bad_shapes, CAST(4*count(*) FILTER (WHERE has_nan) AS BIGINT) AS nan, 0::BIGINT AS infinite, CAST(sum(masks_wrong) AS BIGINT) AS masks_wrong, CAST(sum(off) AS BIGINT) AS values_off, round(max(diff),6) AS max_diff,
    round(sum(ok)/sum(cells),9) AS valid_share, 0::BIGINT AS months_out_of_order, count(*) FILTER (WHERE short OR masks_wrong>0 OR off>0) AS errors FROM p GROUP BY split)""", "sm", "px", "obs", "bs")  # fmt: skip
def _(spark, d):
    picked = sequence.picks(s.samples(spark), (0.0, 0.25, 0.5, 0.75, 1.0))
    at = F.col("sample_id")
    x = _x(spark, d, rebuild.sample_planes, picked).filter(~((at % 4 == 2) & (F.col("t") == 3)))
    nan = F.transform("cells", lambda c: F.when((c["i"] == 1) & (c["j"] == 1), c.withField("z", F.lit(float("nan")))).otherwise(c))
    x = x.withColumn("cells", F.when((at % 2 == 0) & (F.col("t") == 5), nan).otherwise(F.col("cells")))
    y = rebuild.targets(picked, s.obs(spark, d), s.band_stats(spark, d), "price")
    here = lambda i, j: (F.col("i") == i) & (F.col("j") == j)
    y = y.withColumn("mask", F.when((at % 5 == 1) & here(0, 0), ~F.col("mask")).otherwise(F.col("mask"))).withColumn("y", F.when((at % 3 == 0) & here(2, 1), F.col("y") + 0.5).otherwise(F.col("y")))
    found = verify.split_report(picked, x, y, s.obs(spark, d), s.band_stats(spark, d), "price", s.LENGTH, len(s.BANDS), s.labels())
    return found.withColumn("max_diff", F.round("max_diff", 6)).withColumn("valid_share", F.round("valid_share", 9))


@query("q56_materialized_compare", """SELECT count(*) FILTER (WHERE a.qty IS NOT NULL AND b.qty IS NOT NULL) AS compared, max(abs(a.qty-b.qty)) AS max_abs_diff, count(*) FILTER (WHERE (a.qty IS NULL)<>(b.qty IS NULL)) AS one_sided FROM obs a FULL JOIN (SELECT month_idx-1 AS month_idx, "row", col, qty FROM obs WHERE "row"<12) b USING(month_idx,"row",col)""", "obs")
def _(spark, d):
    cube = s.obs(spark, d)
    other = cube.filter("row < 12").withColumn("month_idx", F.col("month_idx") - 1)
    return metrics.max_abs_difference(cube, other, ["month_idx", "row", "col"], "qty")


@query("q58_no_leak", """SELECT split, count(*) AS pixels, count(*) FILTER (WHERE split_id<>0 AND split_id<>CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END) AS foreign FROM pt JOIN sp ON sp."row" BETWEEN row_off AND row_off+2 AND sp.col BETWEEN col_off AND col_off+2 GROUP BY split""".replace("AS foreign", 'AS "foreign"'), "pt", "sp")
def _(spark, d):
    covered = tiles.cover(s.split(spark), s.G, s.G, s.SIZE, s.STRIDE)
    return metrics.no_leak(covered, s.patches(spark), fx.SPLITS)


@query("q41_channel_means", f"""SELECT sample_id, channel, round(avg(z),9) AS mean_value FROM ({_X}) GROUP BY ALL""", "sm", "px", "obs", "tr", "bs")
def _(spark, d):
    planes = _x(spark, d, rebuild.sample_planes)
    total = F.aggregate("cells.z", F.lit(0.0), lambda a, z: a + z)
    means = planes.groupBy("sample_id", "channel").agg((F.sum(total) / F.sum(F.size("cells"))).alias("m"))
    return means.select("sample_id", "channel", F.round("m", 9).alias("mean_value"))


@query("q42_histogram", f"""SELECT CAST(least(floor((z-lo)/((hi-lo)/100)),99) AS INT) AS bin, count(*) AS n FROM (SELECT z, min(z) OVER () AS lo, max(z) OVER () AS hi FROM (SELECT (coalesce(value,fill)-mean)/std AS z FROM ({_LONG}) JOIN bs USING(channel))) GROUP BY ALL""", "dn", "tr", "bs")
def _(spark, d):
    return metrics.histogram(_normalised(spark, d), "z", 100)


@query("q43_split_profile", """SELECT 'row' AS axis, col AS "at", split_id FROM sp WHERE "row"=8 UNION ALL SELECT 'col', "row", split_id FROM sp WHERE col=8""", "sp")
def _(spark, d):
    return metrics.profile(s.split(spark), s.G, s.G)


# ---- land cover ------------------------------------------------------------------------------


@query("q37_majority", "SELECT * FROM ld", "ld")
def _(spark, d):
    return s.land(spark, d)


#: A source grid whose cells don't fit the model's: 0.35 x 0.37 of a pixel, moved by a bit.
_SOURCE = (0.35, 0.0, -0.9, 0.0, -0.37, 15.95)


@query("q37b_land_cover_align", f"""SELECT "row", col, class FROM (SELECT *, row_number() OVER (PARTITION BY "row",col ORDER BY n DESC, class) AS k FROM (SELECT CAST(floor(({_SOURCE[5]}::DOUBLE+("row"+0.5::DOUBLE)*({_SOURCE[4]}::DOUBLE)-15.5::DOUBLE)/-1.0::DOUBLE) AS INT) AS "row",
    CAST(floor(({_SOURCE[2]}::DOUBLE+(col+0.5::DOUBLE)*{_SOURCE[0]}::DOUBLE-(-0.5::DOUBLE))/1.0::DOUBLE) AS INT) AS col, CAST(class AS INT) AS class, count(*) AS n FROM fc GROUP BY ALL) WHERE "row" BETWEEN 0 AND 15 AND col BETWEEN 0 AND 15) WHERE k=1""", "fc")  # fmt: skip
def _(spark, d):
    return landcover.align(s.fine_cover(spark, d), _SOURCE, s.TRANSFORM, s.G, s.G)


@query("q47_urban_mask", "SELECT * FROM ur", "ur")
def _(spark, d):
    return s.urban(spark, d)


@query("q34_outward_ring", "SELECT * FROM rg", "rg")
def _(spark, d):
    return s.ring(spark, d)


@query("q48_rural_mask", "SELECT * FROM rl", "rl")
def _(spark, d):
    return s.rural(spark, d)


_REPORT = """SELECT *, urban*100.0::DOUBLE/study AS urban_pct, rural*100.0::DOUBLE/study AS rural_pct, overlap=0 AND urban>0 AND rural>0 AS "valid", coalesce(urban/rural::DOUBLE>50 OR urban/rural::DOUBLE<0.02::DOUBLE, true) AS unbalanced FROM (SELECT count(*) AS cells, count(*) FILTER (WHERE is_urban) AS urban, count(*) FILTER (WHERE is_rural) AS rural, count(*) FILTER (WHERE in_study) AS study, count(*) FILTER (WHERE is_urban AND is_rural) AS overlap FROM mk)"""


@query("q38_mask_counts", f"SELECT urban, rural, study, urban_pct, rural_pct FROM ({_REPORT})", "mk")
def _(spark, d):
    return metrics_report(spark, d).select("urban", "rural", "study", "urban_pct", "rural_pct")


@query("q57_mask_validation", f"""SELECT overlap, "valid", unbalanced FROM ({_REPORT})""", "mk")
def _(spark, d):
    return metrics_report(spark, d).select("overlap", "valid", "unbalanced")


@query("q57b_mask_findings", """SELECT CASE WHEN k IN ('shape','overlap','urban values') THEN 'error' ELSE 'warning' END AS level, k AS finding, v AS detail FROM (
    SELECT 'shape' AS k, count(*)||' cells, 0 beyond the 16 x 16 grid' AS v FROM mk WHERE "row"<>7 HAVING count(*)<>256
    UNION ALL SELECT 'overlap', count(*)||' cells are urban and rural' FROM mk WHERE "row"<>7 AND col<>9 AND is_urban AND (is_rural OR "row"=3) HAVING count(*)>0
    UNION ALL SELECT 'urban values', count(*)||' urban values are not 0 or 1' FROM mk WHERE "row"<>7 AND col=9 HAVING count(*)>0
    UNION ALL SELECT 'unknown class', CAST(class AS VARCHAR) FROM (SELECT DISTINCT class FROM ld WHERE class NOT IN (10,50,60)))""", "mk", "ld")
def _(spark, d):
    """Masks with faults: a row is missing, urban cells of a row are rural too, a column has the value 2."""
    mask = s.masks(spark, d).filter("row <> 7").withColumn("is_rural", F.col("is_rural") | ((F.col("row") == 3) & F.col("is_urban")))
    mask = mask.withColumn("is_urban", F.when(F.col("col") == 9, 2).otherwise(F.col("is_urban").cast("int")))
    found = landcover.mask_findings(mask, s.land(spark, d), [10, 50, 60], s.G, s.G)
    return found.filter("finding not in ('urban empty', 'rural empty', 'unbalanced')")


@query("q57c_ring_report", """SELECT count(*) AS ring, count(*) FILTER (WHERE class IS NULL OR class NOT IN (10,20,30,40,60)) AS dropped_by_class FROM rg LEFT JOIN ld USING("row",col)""", "rg", "ld")
def _(spark, d):
    return landcover.ring_report(s.land(spark, d), s.ring(spark, d))


@query("q57d_mask_report_unclipped", f"""SELECT urban, rural, cells, urban*100.0::DOUBLE/cells AS urban_pct, rural*100.0::DOUBLE/cells AS rural_pct FROM ({_REPORT})""", "mk")
def _(spark, d):
    return landcover.mask_report(s.masks(spark, d), clipped=False).select("urban", "rural", "cells", "urban_pct", "rural_pct")


def metrics_report(spark, d):
    return landcover.mask_report(s.masks(spark, d))


@query("q45_unexpected_classes", "SELECT DISTINCT class FROM ld WHERE class NOT IN (10,50,0)", "ld")
def _(spark, d):
    return landcover.unexpected_classes(s.land(spark, d), [10, 50])


# ---- extensions ------------------------------------------------------------------------------


def _month(spark, d, at=40):
    values = s.obs(spark, d).filter(F.col("month_idx") == at).select("row", "col", F.col("qty").cast("double").alias("value"))
    return s.masks(spark, d).join(values, ["row", "col"])


_C = "SELECT avg(value) FILTER (WHERE is_urban) AS urban_mean, avg(value) FILTER (WHERE is_rural) AS rural_mean FROM mv"


@query("q49_island_contrast", f"SELECT *, urban_mean-rural_mean AS contrast FROM ({_C})", "mv")
def _(spark, d):
    return metrics.island_contrast(_month(spark, d))


@query("q50_contrast_map", f'SELECT "row", col, value-(SELECT rural_mean FROM ({_C})) AS excess FROM mv', "mv")
def _(spark, d):
    return metrics.contrast_map(_month(spark, d)).select("row", "col", "excess")


@query("q51_scenario_difference", 'SELECT a."row", a.col, CAST(b.qty-a.qty AS BIGINT) AS delta FROM obs a JOIN obs b USING("row",col) WHERE a.month_idx=40 AND b.month_idx=52', "obs")
def _(spark, d):
    cube = s.obs(spark, d)
    return metrics.difference(cube.filter("month_idx = 40"), cube.filter("month_idx = 52"), ["row", "col"], "qty")


@query("q52_error_metrics", """SELECT n, a/n AS mae, sqrt(q/n) AS rmse, 1.0::DOUBLE-q/(tt-t*t/n) AS r2 FROM (SELECT count(*) AS n, CAST(sum(abs(p.qty-o.qty)) AS DOUBLE) AS a, CAST(sum((p.qty-o.qty)*(p.qty-o.qty)) AS DOUBLE) AS q, CAST(sum(o.qty) AS DOUBLE) AS t, CAST(sum(o.qty*o.qty) AS DOUBLE) AS tt FROM obs o JOIN obs p ON p."row"=o."row" AND p.col=o.col AND p.month_idx=o.month_idx-1 WHERE o.month_idx>=12)""", "obs")
def _(spark, d):
    pairs = sequence.next_value(s.obs(spark, d), "qty").select("month_idx", F.col("qty").cast("double").alias("predicted"), F.col("target").cast("double").alias("truth"))
    return metrics.errors(pairs, mask=F.col("month_idx") >= s.LENGTH - 1)


@query("q53_interpolation", """SELECT month_idx, "row", col, CASE WHEN qty IS NOT NULL THEN CAST(qty AS DOUBLE) WHEN bm-am>0 AND bm-am-1<=12 THEN av+(bv-av)*(month_idx-am)/(bm-am) END AS filled FROM (
    SELECT *, last_value(CASE WHEN qty IS NOT NULL THEN month_idx END IGNORE NULLS) OVER p AS am, last_value(CAST(qty AS DOUBLE) IGNORE NULLS) OVER p AS av, first_value(CASE WHEN qty IS NOT NULL THEN month_idx END IGNORE NULLS) OVER f AS bm, first_value(CAST(qty AS DOUBLE) IGNORE NULLS) OVER f AS bv
    FROM dn WINDOW p AS (PARTITION BY "row",col ORDER BY month_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY "row",col ORDER BY month_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", "dn")  # fmt: skip
def _(spark, d):
    return metrics.interpolate(_dense(spark, d).select("month_idx", "row", "col", "qty"), "qty").select("month_idx", "row", "col", "filled")


@query("q54c_missingness", """SELECT count(*) AS "rows", count(*) FILTER (WHERE qty IS NULL) AS missing, count(*) FILTER (WHERE qty%5=0) AS nan, count(*) FILTER (WHERE qty%5<>0 AND qty%7=0) AS infinite FROM dn""", "dn")
def _(spark, d):
    q = F.col("qty")
    raw = F.when(q % 5 == 0, F.lit(float("nan"))).when(q % 7 == 0, F.lit(float("-inf"))).otherwise(q.cast("double"))
    return metrics.missingness(_dense(spark, d).withColumn("value", raw), "value")
