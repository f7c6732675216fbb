"""Raster operators against numpy and their SQL twins."""

import itertools
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rastercube.functions import scalar as fx
from rastercube.operators import landcover, metrics, partition, sequence, stats, tiles, verify
from rastercube.operators import samples as rebuild
from rastercube.plans.queries import ORACLE, QUERIES
from rastercube.sources import catalog

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = duck.execute(ORACLE[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(dict(zip(names, x, strict=True))[c]) for c in cols) for x in r.fetchall()), key=repr)
    assert got == want


def cells(df, *cols):
    return {tuple(r) for r in df.select(*(cols or ("row", "col"))).collect()}


def tile_starts(length, size, stride):
    """All starts at which a tile fits: multiples of the stride, and the very last."""
    return [s for s in range(length - size + 1) if s % stride == 0 or s == length - size]


def test_starts_of_the_published_grid(spark):
    for length, n in ((1493, 23), (1608, 25)):
        got = spark.range(length).select(F.explode(fx.covering_starts(F.col("id").cast("int"), length, 128, 64)).alias("s")).distinct()
        assert got.count() == n == len(tile_starts(length, 128, 64))


@pytest.mark.parametrize(("length", "size", "stride"), [(16, 3, 2), (16, 4, 2), (17, 5, 3), (9, 2, 4), (7, 7, 3), (3, 4, 1)])
def test_covering_starts_are_the_tiles_that_cover(spark, length, size, stride):
    got = {r["i"]: sorted(r["s"]) for r in spark.range(length).select(F.col("id").cast("int").alias("i")).select("i", fx.covering_starts(F.col("i"), length, size, stride).alias("s")).collect()}
    for i in range(length):
        assert got[i] == [s for s in tile_starts(length, size, stride) if s <= i < s + size]


def split_by_numpy(h, w, region, test, val, degrees):
    r, c = np.mgrid[0:h, 0:w]
    cos, sin = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    x, y = c + 0.5, -(r + 0.5)
    across, along = x * cos - y * sin, y * cos + x * sin
    out = np.where(region, 1, 0)
    t = np.quantile(along[region], 1 - test)
    rest = region & (along < t)
    v = np.quantile(across[rest], 1 - val / (1 - test))
    out[rest & (across >= v)] = 2
    out[region & (along >= t)] = 3
    return out


@pytest.mark.parametrize("degrees", [0.0, 30.0, 90.0])
def test_split_equals_numpy(spark, degrees):
    region = np.ones((10, 10), bool)
    region[0, :3] = False
    rows = [(r, c, c + 0.5, -(r + 0.5), bool(region[r, c])) for r in range(10) for c in range(10)]
    df = spark.createDataFrame(rows, "row int, col int, x double, y double, in_region boolean")
    got = np.zeros((10, 10), int)
    for r in partition.directional_split(df, 0.2, 0.15, degrees).collect():
        got[r["row"], r["col"]] = r["split_id"]
    assert (got == split_by_numpy(10, 10, region, 0.2, 0.15, degrees)).all()


def test_a_split_with_too_few_pixels_is_refused(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 2)], "row int, col int, split_id int")
    with pytest.raises(partition.SplitError):
        partition.require_pixels(df, 1)


def test_purity_rounds_half_to_even_and_needs_the_ceiling(spark):
    assert fx.needed(0.9, 128) == 14746
    got = spark.range(1).select(fx.purity(F.lit(60.5) * 256, 128).alias("p")).first()["p"]
    assert got == round(60.5 * 256 / (128 * 128), 6) == 0.945312


def test_two_winners_are_an_error(spark):
    t = spark.createDataFrame([(0, 0, 2, 2, 0)], "row_off int, col_off int, n_train long, n_val long, n_test long")
    with pytest.raises(PySparkException):
        tiles.assign(t, 2, 0.5).collect()
    assert tiles.assign(t, 2, 0.75).first()["split"] is None


def test_weighted_statistics_equal_a_loop_over_patches(spark):
    r = np.random.default_rng(1)
    cube = r.normal(size=(4, 8, 8)).round(3)
    cube[r.random(cube.shape) < 0.1] = np.nan
    ids = r.integers(0, 4, (8, 8))
    ids[:4] = 1
    pix = spark.createDataFrame([(i, j, int(ids[i, j])) for i in range(8) for j in range(8)], "row int, col int, split_id int")
    rows = [(m, i, j, None if np.isnan(v := cube[m, i, j]) else float(v), 7.0) for m in range(4) for i in range(8) for j in range(8)]
    df = spark.createDataFrame(rows, "month_idx int, row int, col int, a double, flat double")
    patch = tiles.patches(tiles.assign(tiles.tile_counts(pix, 8, 8, 3, 2), 3, 0.9), 3)
    got = {x["channel"]: x for x in stats.train_stats(df, df.filter("1=0"), tiles.weights(pix, patch, 8, 8, 3, 2), ["a", "flat"], [], 4).collect()}
    vals, n_max = [], 0
    for a, b in itertools.product(tile_starts(8, 3, 2), repeat=2):
        tile = ids[a : a + 3, b : b + 3] == 1
        if tile.sum() >= 9:
            n_max += 4 * tile.sum()
            for m in range(4):
                v = cube[m, a : a + 3, b : b + 3][tile]
                vals += v[np.isfinite(v)].tolist()
    assert (got["a"]["n"], got["a"]["n_max"]) == (len(vals), n_max)
    assert got["a"]["mean"] == pytest.approx(np.mean(vals)) and got["a"]["std"] == pytest.approx(np.std(vals))
    assert got["flat"]["std"] == 1.0 and got["flat"]["degenerate"] and not got["a"]["degenerate"]


def test_large_whole_numbers_are_summed_exactly(spark):
    v = [2**53 // 7, -(2**31) - 1, 3, 10**9 + 7, stats.MAX_ROOT, -stats.MAX_ROOT, stats.MAX_ROOT + 1, -(2**63)]
    small = [x for x in v if abs(x) <= stats.MAX_ROOT]
    rows = [(m, 0, j, x, x % 1000) for m, x in enumerate(v) for j in range(50)]
    df = spark.createDataFrame(rows, "month_idx int, row int, col int, a long, b int").repartition(7)
    weight = spark.createDataFrame([(0, j, 1 + j) for j in range(50)], "row int, col int, w long")
    at = lambda cube: {r["channel"]: r for r in stats.weighted_sums(weight, (cube, ["a", "b"], len(v))).collect()}
    n = sum(range(1, 51))
    got, few = at(df)["a"], at(df.filter(F.col("a").between(-stats.MAX_ROOT, stats.MAX_ROOT)))["a"]
    assert (got["n"], got["total"]) == (n * len(v), float(n * sum(v)))
    assert got["squares"] == pytest.approx(n * sum(x * x for x in v), rel=1e-15)
    assert few["squares"] == float(n * sum(x * x for x in small)) and few["total"] == float(n * sum(small))
    assert at(df)["b"]["squares"] == n * sum((x % 1000) ** 2 for x in v)


@pytest.mark.parametrize("name", ["q31_train_stats", "q55b_sample_planes"])
def test_large_sums_equal_sql(spark, tmp_path, name):
    """Squares whose sum takes more than 64 bits, as tables of 1 GB have them."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"copy (select * replace (l_extendedprice * 3000 as l_extendedprice) from '{SF}/lineitem.parquet') to '{tmp_path}/lineitem.parquet' (format parquet)")
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet'")
    r = con.execute(ORACLE[name])
    cols = [c[0] for c in r.description]
    want = sorted((tuple(map(norm, x)) for x in r.fetchall()), key=repr)
    assert sorted((tuple(map(norm, x)) for x in QUERIES[name](spark, str(tmp_path)).select(*cols).collect()), key=repr) == want


def test_statistics_without_values_are_refused(spark):
    s = spark.createDataFrame([("a", 0, 5, 0.0, 0.0), ("b", 0, 0, None, None)], "channel string, n long, n_max long, total double, squares double")
    with pytest.raises(stats.StatsError):
        stats.require_stats(stats.band_stats(s))


def test_finite(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (None,), (1.5,)], "x double")
    assert [r["y"] for r in df.select(fx.finite(F.col("x")).alias("y")).collect()] == [None, None, None, None, 1.5]


def test_temporal_mean_of_a_pixel_without_values_is_null(spark):
    df = spark.createDataFrame([(0, 0, 0, None), (1, 0, 0, None), (0, 0, 1, 2.0), (1, 0, 1, 4.0)], "month_idx int, row int, col int, e float")
    assert {(r["col"], r["e"]) for r in stats.temporal_mean(df, ["e"]).collect()} == {(0, None), (1, 3.0)}


def test_month_labels(spark):
    df = spark.createDataFrame([("2020-01",), ("2020-12",)], "l string")
    assert [r["p"] for r in df.select(fx.previous_label(F.col("l")).alias("p")).collect()] == ["2019-12", "2020-11"]
    got = spark.range(14).select(fx.label_of_index(F.col("id"), 2019, 11).alias("l")).collect()
    assert (got[0]["l"], got[1]["l"], got[2]["l"], got[13]["l"]) == ("2019-11", "2019-12", "2020-01", "2020-12")


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_catalogue_guards(spark):
    ok = catalog.discover(paths(spark, "/a/2020/X_2020_01_18features.tif", "/a/X_2020_02_18features.tif", "/a/2020_03/other.tif"))
    assert [(r["month_idx"], r["label"]) for r in catalog.require_complete(ok).collect()] == [(0, "2020-01"), (1, "2020-02")]
    for bad in (("/a/X_2020_01_18features.tif", "/b/Y_2020_01_18features.tif"), ("/a/X_2020_01_18features.tif", "/a/X_2020_03_18features.tif"), ("/a/X_18features.tif",), ("/a/none.tif",)):
        with pytest.raises(catalog.CatalogError):
            catalog.require_complete(catalog.discover(paths(spark, *bad)))


def test_files_are_listed_by_name(spark, tmp_path):
    (tmp_path / "2020").mkdir()
    for n in ("2020/A_2020_01_18features.tif", "2020/A_2020_02_18features.tif", "2020/A_2020_02.tif"):
        (tmp_path / n).write_bytes(b"x")
    assert catalog.discover(catalog.list_files(spark, str(tmp_path))).count() == 2


def test_band_order():
    catalog.require_channels(["a", "b"], ["a", "b"])
    for bad in ([None, None], ["b", "a"], ["a"]):
        with pytest.raises(catalog.CatalogError):
            catalog.require_channels(bad, ["a", "b"])


def test_grids_must_agree(spark):
    kind = "width int, height int, count int, crs string, transform array<double>, dtype string, descriptions array<string>"
    one = (2, 3, 1, "c", [0.1, 0.2], "f", ["a"])
    assert catalog.require_one_grid(spark.createDataFrame([one, (*one[:4], [0.1 + 1e-12, 0.2], *one[5:])], kind))["files"] == 2
    with pytest.raises(catalog.CatalogError):
        catalog.require_one_grid(spark.createDataFrame([one, (3, *one[1:])], kind))
    with pytest.raises(catalog.CatalogError):
        catalog.require_one_grid(spark.createDataFrame([], kind))


def test_legend_and_its_fallback(spark):
    lines = spark.createDataFrame([("10 Trees",), ("",), ("x 5",)], "line string")
    assert [tuple(r) for r in catalog.parse_legend(lines, {}).collect()] == [(10, "Trees")]
    assert [tuple(r) for r in catalog.parse_legend(lines.filter("line=''"), {50: "Built"}).collect()] == [(50, "Built")]


@pytest.mark.parametrize("radius", [1.0, 2**0.5, 2.5, 4.0])
def test_ring_equals_distances(spark, radius):
    r = np.random.default_rng(3)
    some = {(int(a), int(b)) for a, b in r.integers(0, 15, (9, 2))} | {(0, 0), (14, 14), (7, 7), (7, 8)}
    df = spark.createDataFrame(sorted(some), "row int, col int")
    want = {(i, j) for i in range(15) for j in range(15) if (i, j) not in some and min((i - a) ** 2 + (j - b) ** 2 for a, b in some) <= radius * radius + 1e-12}
    assert cells(landcover.ring(df, radius, 15, 15)) == want


def test_ring_of_nothing_is_nothing(spark):
    assert landcover.ring(spark.createDataFrame([], "row int, col int"), 2.0, 5, 5).count() == 0


def test_majority_takes_the_lowest_of_a_tie_and_skips_nodata(spark):
    fine = [(0, 0, 10), (0, 1, 10), (1, 0, 50), (0, 2, 50), (0, 3, 10), (0, 4, 0), (1, 5, 0)]
    got = landcover.majority(spark.createDataFrame(fine, "row int, col int, class int"), 2)
    assert cells(got, "row", "col", "class") == {(0, 0, 10), (0, 1, 10)}


def test_mask_guards(spark):
    df = spark.createDataFrame([(True, True, True), (True, False, True)], "is_urban boolean, is_rural boolean, in_study boolean")
    with pytest.raises(landcover.MaskError):
        landcover.require_masks(landcover.mask_report(df))
    with pytest.raises(landcover.MaskError):
        landcover.require_masks(landcover.mask_report(df.filter("not is_rural")))


def inside(polygons, x, y):
    def odd(rings):
        n = 0
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                    n += 1
        return n % 2 == 1

    return any(map(odd, polygons))


@pytest.mark.parametrize(
    "polygons",
    [
        [[[(1.0, 1.0), (8.0, 2.0), (4.0, 9.0)]]],
        [[[(0, 0), (9, 0), (9, 4), (4, 4), (4, 9), (0, 9)]]],
        [[[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (6, 3), (6, 6), (3, 6)]]],
        [[[(0, 0), (5, 0), (5, 5), (0, 5)]], [[(3, 3), (9, 3), (9, 9), (3, 9)]]],
        [[[(0, 0), (9, 9), (9, 0), (0, 9)]]],
    ],
)
def test_rasterize_equals_even_odd(spark, polygons):
    rows = [(i, j, j + 0.5, i + 0.5) for i in range(10) for j in range(10)]
    px = spark.createDataFrame(rows, "row int, col int, x double, y double")
    for step in (1.0, -1.0):  # rows upwards and, as rasters have them, downwards
        flipped = [[[(x, y if step > 0 else 10 - y) for x, y in ring] for ring in rings] for rings in polygons]
        got = cells(partition.rasterize(px, partition.edges(spark, flipped), (1.0, 0.0, 0.0, 0.0, step, 0.0 if step > 0 else 10.0), 10).filter("inside"))
        assert got == {(i, j) for i, j, x, y in rows if inside(polygons, x, y)}


def test_geojson_edges(spark, tmp_path):
    import json

    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square]}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square]]}}]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc))
    got = partition.geojson_edges(spark, str(tmp_path / "b.geojson"))
    assert got.count() == 12 and cells(got.filter("poly=0"), "x1", "y1", "x2", "y2") == {(0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 4.0), (4.0, 4.0, 0.0, 4.0), (0.0, 4.0, 0.0, 0.0)}


def test_geojson_in_degrees_is_projected_and_none_is_refused(spark, tmp_path):
    import json

    from rastercube.functions.projection import utm

    ring = [[77.5, 12.9], [77.6, 12.9], [77.6, 13.0], [77.5, 12.9]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [0, 0]}}]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc))
    east, north = utm(F.lit(77.5), F.lit(12.9), 43)
    want = spark.range(1).select(east.alias("x"), north.alias("y")).first()
    got = partition.geojson_edges(spark, str(tmp_path / "b.geojson"), "EPSG:32643").collect()
    assert len(got) == 3 and sum(r["x1"] == pytest.approx(want["x"], abs=1e-6) and r["y1"] == pytest.approx(want["y"], abs=1e-6) for r in got) == 1
    with pytest.raises(partition.SplitError):
        partition.geojson_edges(spark, str(tmp_path / "b.geojson"), "EPSG:3857")
    doc["crs"] = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32643"}}
    (tmp_path / "b.geojson").write_text(json.dumps(doc))
    assert (77.5, 12.9) in cells(partition.geojson_edges(spark, str(tmp_path / "b.geojson"), "EPSG:32643"), "x1", "y1")
    (tmp_path / "none.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    with pytest.raises(partition.SplitError):
        partition.geojson_edges(spark, str(tmp_path / "none.geojson"))


@pytest.mark.parametrize(("values", "p"), [("normal", 0.8), ("normal", 0.237), ("ties", 0.8), ("one", 0.5), ("normal", 0.0), ("normal", 1.0)])
def test_quantile_equals_numpy(spark, values, p):
    r = np.random.default_rng(4)
    x = {"normal": r.normal(size=3000), "ties": r.integers(0, 4, 501).astype(float), "one": np.array([7.25])}[values]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    for bins in (16, 4096):
        assert partition.quantile(df, F.col("v"), p, bins).first()["q"] == pytest.approx(np.quantile(x, p), rel=1e-12)
    assert partition.quantile(df.filter("1=0"), F.col("v"), p).first()["q"] is None


def test_a_region_without_pixels_is_refused(spark):
    df = spark.createDataFrame([(0, 0, 0.5, 0.5, False)], "row int, col int, x double, y double, in_region boolean")
    with pytest.raises(partition.SplitError):
        partition.require_region(df)
    with pytest.raises(PySparkException, match="no pixels"):
        partition.directional_split(df, 0.2, 0.15).collect()


def test_picks_and_positions(spark):
    patch = spark.createDataFrame([(p, "train" if p % 3 else "val", p, 0, 3, 3) for p in range(7)], "patch_id int, split string, row_off int, col_off int, height int, width int")
    labels = [f"20{m // 12:02d}-{m % 12 + 1:02d}" for m in range(17)]
    sample = sequence.samples(patch, labels, 12)
    ids = {s: sorted(r["sample_id"] for r in sample.filter(F.col("split") == s).collect()) for s in ("train", "val")}
    got = {s: sorted(r["sample_id"] for r in sequence.picks(sample, (0.0, 0.25, 0.5, 0.75, 1.0)).filter(F.col("split") == s).collect()) for s in ids}
    assert got == {s: sorted({x[0], x[len(x) // 4], x[len(x) // 2], x[3 * len(x) // 4], x[-1]}) for s, x in ids.items()}
    at = sequence.at_positions(sample.filter("split = 'val'"), F.array(F.lit(0).cast("long"), F.lit(6).cast("long"), F.lit(99).cast("long")))
    assert sorted((r["position"], r["sample_id"]) for r in at.collect()) == [(0, ids["val"][0]), (6, ids["val"][6])] and sequence.length(sample, "val") == len(ids["val"])


def test_land_cover_is_aligned_by_centres(spark):
    from rastercube.functions.projection import utm

    r = np.random.default_rng(7)
    source, grid = (0.00009, 0.0, 77.5, 0.0, -0.00009, 13.0), (30.0, 0.0, 771200.0, 0.0, -30.0, 1438420.0)
    fine = [(i, j, int(r.choice([0, 10, 30, 50]))) for i in range(40) for j in range(40)]
    df = spark.createDataFrame(fine, "row int, col int, class int")
    lon, lat = F.col("col") * source[0] + source[2] + source[0] / 2, F.col("row") * source[4] + source[5] + source[4] / 2
    x, y = utm(lon, lat, 43)
    at = {(p["row"], p["col"]): (p["x"], p["y"]) for p in df.select("row", "col", x.alias("x"), y.alias("y")).collect()}
    votes = {}
    for i, j, c in fine:
        a, b = math.floor((at[i, j][1] - grid[5]) / -30), math.floor((at[i, j][0] - grid[2]) / 30)
        if c and 0 <= a < 12 and 0 <= b < 12:
            votes.setdefault((a, b), {}).setdefault(c, 0)
            votes[a, b][c] += 1
    want = {(a, b, min(v, key=lambda c: (-v[c], c))) for (a, b), v in votes.items()}
    got = cells(landcover.align(df, source, grid, 12, 12, "EPSG:4326", "EPSG:32643"), "row", "col", "class")
    assert got == want and len(want) > 50
    assert cells(landcover.align(df, (1.0, 0.0, 0.0, 0.0, -1.0, 40.0), (2.0, 0.0, 0.0, 0.0, -2.0, 40.0), 20, 20), "row", "col", "class") == cells(landcover.majority(df, 2), "row", "col", "class")
    with pytest.raises(landcover.MaskError):
        landcover.align(df, source, grid, 12, 12, "EPSG:3857", "EPSG:32643")


def test_mask_findings_name_every_fault(spark):
    grid = [(i, j, i == 0, i == 1, True) for i in range(3) for j in range(3)]
    ok = spark.createDataFrame(grid, "row int, col int, is_urban boolean, is_rural boolean, in_study boolean")
    land = spark.createDataFrame([(0, 0, 50), (1, 0, 77)], "row int, col int, class int")
    found = lambda m, known=(50, 77): {(r["level"], r["finding"]) for r in landcover.mask_findings(m, land, list(known), 3, 3).collect()}
    assert found(ok) == set() and found(ok, (50,)) == {("warning", "unknown class")}
    assert found(ok.withColumn("is_rural", F.lit(True))) == {("error", "overlap")}
    assert found(ok.withColumn("is_urban", F.lit(False))) == {("error", "urban empty")}
    assert found(ok.filter("row < 2")) == {("error", "shape")} == found(ok.withColumn("row", F.when(F.col("row") == 2, 9).otherwise(F.col("row"))))
    assert found(ok.withColumn("is_rural", F.when(F.col("row") == 1, 1).otherwise(7))) == {("error", "rural values")}
    assert landcover.legend_findings({50: "Built-up", **{c: "x" for c in landcover.RURAL}}, (30.0, -30.0)) == []
    assert len(landcover.legend_findings({50: "Water"}, (10.0, -10.0))) == 2 + len(landcover.RURAL)


def test_queries_prune_the_stored_cube(spark):
    """Months and rows of a window reach the scan of the cube that the queries share."""
    for name, month in (("q08_window_scan_bands", "7"), ("q09_window_scan_target", "19")):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "(month_idx" in plan and f"= {month})" in plan and "PushedFilters: [IsNotNull(row)" in plan and "lineitem" not in plan
        assert "tax" not in plan.split("ReadSchema")[1]


def test_sample_windows(spark):
    patch = spark.createDataFrame([(0, "train", 0, 0, 3, 3), (1, "val", 0, 3, 3, 3)], "patch_id int, split string, row_off int, col_off int, height int, width int")
    labels = [f"2020-{m:02d}" for m in range(1, 13)] + ["2021-01"]
    with pytest.raises(sequence.SequenceError):
        sequence.samples(patch, labels[:12], 12)
    got = sequence.samples(patch, labels, 12).orderBy("sample_id").collect()
    assert [(r["sample_id"], r["patch_id"], r["target_month"], r["input_months"][0]) for r in got] == [(0, 0, "2021-01", "2020-01"), (1, 1, "2021-01", "2020-01")]
    with pytest.raises(sequence.SequenceError):
        sequence.of_split(sequence.samples(patch, labels, 12), "other")
    with pytest.raises(sequence.SequenceError):
        sequence.of_split(sequence.samples(patch, labels, 12), "test")
    report = verify.index_report(sequence.samples(patch, labels, 12), 12, labels).first().asDict()
    assert report == {"samples": 2, "bad_length": 0, "gaps": 0, "bad_target": 0, "bad_last_month": 0, "bad_labels": 0, "repeated_ids": 0}
    assert verify.index_report(sequence.samples(patch, labels, 12), 12, [*labels[1:], "x"]).first()["bad_labels"] == 2


def test_interpolation_leaves_long_gaps_and_ends(spark):
    v = [None, 1.0, None, 3.0, *[None] * 13, 9.0, None]
    df = spark.createDataFrame([(0, 0, i, x) for i, x in enumerate(v)], "row int, col int, month_idx int, v double")
    got = [r["filled"] for r in metrics.interpolate(df, "v").orderBy("month_idx").collect()]
    assert got == [None, 1.0, 2.0, 3.0, *[None] * 13, 9.0, None]
    assert [r["filled"] for r in metrics.interpolate(df, "v", 13).orderBy("month_idx").collect()][4] == pytest.approx(3 + 6 / 14)


def test_reconstruction_normalises_and_masks_before_the_fill(spark):
    st = spark.createDataFrame([("a", 2.0, 2.0, 4.0)], "channel string, fill double, mean double, std double")
    df = spark.createDataFrame([("a", None), ("a", 10.0)], "channel string, value double")
    assert sorted((r["value"] is None, r["filled"], r["z"]) for r in rebuild.normalised(df, st).collect()) == [(False, 10.0, 2.0), (True, 2.0, 0.0)]


def test_errors_equal_numpy(spark):
    r = np.random.default_rng(2)
    t, p = r.normal(size=50), r.normal(size=50)
    got = metrics.errors(spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, p, strict=True)] + [(None, 1.0)], "truth double, predicted double")).first()
    assert (got["n"], got["mae"], got["rmse"], got["r2"]) == (50, pytest.approx(np.abs(p - t).mean()), pytest.approx(np.sqrt(((p - t) ** 2).mean())), pytest.approx(1 - ((p - t) ** 2).sum() / ((t - t.mean()) ** 2).sum()))


def test_window_scan_reaches_the_file(spark, tmp_path):
    spark.range(100).select((F.col("id") % 4).cast("int").alias("month_idx"), (F.col("id") % 10).cast("int").alias("row"), F.col("id").cast("int").alias("col"), F.col("id").cast("float").alias("a"), F.col("id").cast("float").alias("b")).write.partitionBy("month_idx").parquet(str(tmp_path / "cube"))
    plan = rebuild.window_scan(spark.read.parquet(str(tmp_path / "cube")), 2, 3, 4, ["a"], month=1)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row,2)" in plan and "isnotnull(month_idx" in plan and "b:float" not in plan
