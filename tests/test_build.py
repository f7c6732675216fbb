"""Configuration, rasters and the whole build on a small grid."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastercube import config as cfg
from rastercube.functions.projection import utm
from rastercube.__main__ import main
from rastercube.operators import landcover, partition, verify
from rastercube.plans import build, masks, surrogate
from rastercube.sources import catalog, geotiff, sinks


def test_config_rules():
    ok = cfg.Config(data=cfg.DataConfig(channel_names=("a", "b"), target_channel="a", static_channels=("b",)))
    assert ok.validate() is ok and ok.dynamic_channels == ["a"] and ok.override(stride=3).data.stride == 3
    bad = [{"sequence_length": 0}, {"patch_size": 0}, {"purity_threshold": 0.0}, {"purity_threshold": 1.1}, {"channel_names": ("a", "a")}, {"target_channel": "z"}, {"static_channels": ("z",)}, {"method": "x"}, {"test_fraction": 1.0}, {"val_fraction": 0.9}, {"nonsense": 1}]
    for x in bad:
        with pytest.raises(cfg.ConfigError):
            ok.override(**x)


def test_config_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    p = tmp_path / "c.yaml"
    p.write_text("data:\n  channel_names: [a, b]\n  target_channel: a\nsplit:\n  rotation_deg: 30\n")
    assert cfg.load(str(p)).split.rotation_deg == 30
    p.write_text("data:\n  chanel_names: [a]\n")
    with pytest.raises(cfg.ConfigError):
        cfg.load(str(p))


def lzw_encode(data):
    """A plain encoder, to test the decoder with."""
    out, table, width, prefix = [(256, 9)], {bytes([i]): i for i in range(256)}, 9, b""
    size = 258
    for x in data:
        y = prefix + bytes([x])
        if y in table:
            prefix = y
            continue
        out.append((table[prefix], width))
        table[y], size, prefix = size, size + 1, bytes([x])
        if size >= (1 << width) and width < 12:
            width += 1
        if size == 4094:
            out.append((256, width))
            table, width, size = {bytes([i]): i for i in range(256)}, 9, 258
    out += [(table[prefix], width)] if prefix else []
    size += bool(prefix)
    out.append((257, width + (size >= (1 << width) and width < 12)))
    bits = "".join(f"{c:0{w}b}" for c, w in out)
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


@pytest.mark.parametrize("n", [0, 1, 500, 40_000])
def test_lzw(n):
    data = bytes(np.random.default_rng(1).integers(0, 7, n, dtype=np.uint8))
    assert geotiff.lzw(lzw_encode(data)) == data


def test_tiff_round_trip():
    x = np.arange(24, dtype=np.float32).reshape(2, 3, 4)
    x[1, 2, 3] = np.nan
    t = geotiff.Tiff(geotiff.write(x, (30.0, 0.0, 100.0, 0.0, -30.0, 200.0), ["a", "b"], 32643, -1.0))
    assert t.grid() == geotiff.Grid(4, 3, 2, "EPSG:32643", (30.0, 0.0, 100.0, 0.0, -30.0, 200.0), "float32", ("a", "b"), -1.0)
    got = {b: v for b, _, _, v in t.blocks()}
    assert np.array_equal(got[0], x[0]) and np.array_equal(got[1], x[1], equal_nan=True) and [b for b, *_ in t.blocks([1])] == [1]
    with pytest.raises(geotiff.RasterError):
        geotiff.Tiff(b"nothing like it")


def test_rasters_become_a_cube(spark, tmp_path):
    r = np.random.default_rng(2)
    want = {}
    for m in (1, 2):
        x = r.normal(size=(2, 3, 5)).astype(np.float32)
        x[0, 1, m] = np.inf
        (tmp_path / f"Z_2020_{m:02d}_18features.tif").write_bytes(geotiff.write(x, names=["a", "b"]))
        want |= {(m - 1, i, j): (None if not np.isfinite(x[0, i, j]) else float(x[0, i, j]), float(x[1, i, j])) for i in range(3) for j in range(5)}
    rasters = geotiff.files(spark, str(tmp_path))
    months = catalog.require_complete(catalog.discover(rasters.select("path")))
    grid = catalog.require_one_grid(geotiff.metadata(rasters))
    catalog.require_channels(grid["descriptions"], ["a", "b"])
    cube = geotiff.cube(months, rasters, ["a", "b"])
    assert {(x["month_idx"], x["row"], x["col"]): (x["a"], x["b"]) for x in cube.collect()} == want
    assert geotiff.cube(months, rasters, ["a", "b"], ["b"]).columns == ["month_idx", "row", "col", "b"]


def test_masks_are_saved_as_rasters(spark, tmp_path):
    import glob

    df = spark.createDataFrame([(0, 1, True, 2.5), (2, 3, False, None)], "row int, col int, m boolean, v double")
    geotiff.save(df.withColumn("m", F.col("m").cast("int")), f"{tmp_path}/m", 3, 4, ["m"], "uint8", epsg=32643, nodata=0)
    geotiff.save(df, f"{tmp_path}/v", 3, 4, ["v"])
    masks, values = (geotiff.Tiff(open(glob.glob(f"{tmp_path}/{k}/part-*")[0], "rb").read()) for k in "mv")
    want = np.zeros((3, 4), np.uint8)
    want[0, 1] = 1
    assert masks.grid().crs == "EPSG:32643" and np.array_equal(next(iter(masks.blocks()))[3], want)
    v = next(iter(values.blocks()))[3]
    assert v[0, 1] == 2.5 and np.isnan(v).sum() == 11


def test_land_cover_raster(spark, tmp_path):
    x = np.array([[[10, 10, 0, 0], [50, 10, 0, 0]]], np.uint8)
    (tmp_path / "lc.tif").write_bytes(geotiff.write(x, nodata=0))
    land = geotiff.land_cover(geotiff.files(spark, str(tmp_path)))
    assert [tuple(r) for r in landcover.majority(land, 2).collect()] == [(0, 0, 10)]


def test_utm_of_known_points(spark):
    df = spark.createDataFrame([(75.0, 0.0), (77.5946, 12.9716), (9.0, 0.0)], "lon double, lat double")
    east, north = utm(F.col("lon"), F.col("lat"), 43)
    rows = df.select(east.alias("e"), north.alias("n")).collect()
    assert rows[0]["e"] == pytest.approx(500000, abs=1e-6) and rows[0]["n"] == pytest.approx(0, abs=1e-6)
    # by the power series of the meridian arc (Snyder), which is independent of Krueger's
    a, f, k, lat, dlon = 6378137.0, 1 / 298.257223563, 0.9996, math.radians(12.9716), math.radians(77.5946 - 75)
    e2 = f * (2 - f)
    ep, n = e2 / (1 - e2), a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
    t, c, A = math.tan(lat) ** 2, ep * math.cos(lat) ** 2, dlon * math.cos(lat)
    arc = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * lat - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * lat) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * lat) - 35 * e2**3 / 3072 * math.sin(6 * lat))
    x = 500000 + k * n * (A + (1 - t + c) * A**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * A**5 / 120)
    y = k * (arc + n * math.tan(lat) * (A * A / 2 + (5 - t + 9 * c + 4 * c * c) * A**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * A**6 / 720))
    assert rows[1]["e"] == pytest.approx(x, abs=0.01) and rows[1]["n"] == pytest.approx(y, abs=0.01)


def test_build_and_samples(spark, tmp_path):
    r = np.random.default_rng(4)
    x = r.normal(size=(15, 16, 16)).round(3)
    x[r.random(x.shape) < 0.05] = np.nan
    rows = [(m, i, j, None if np.isnan(x[m, i, j]) else float(x[m, i, j]), float(i + j + (m % 2))) for m in range(15) for i in range(16) for j in range(16)]
    cube = spark.createDataFrame(rows, "month_idx int, row int, col int, temp double, elev double")
    months = spark.createDataFrame([(m, f"2020-{m + 1:02d}") for m in range(12)] + [(12 + m, f"2021-{m + 1:02d}") for m in range(3)], "month_idx int, label string")
    conf = cfg.Config(cfg.Paths(output_dir=f"{tmp_path}/out"), cfg.DataConfig(patch_size=3, stride=2, channel_names=("temp", "elev"), target_channel="temp", static_channels=("elev",)))
    made = build.build(conf, months, cube, surrogate.region(spark), 16, 16)
    assert made.patch.count() == 21 and made.sample.count() == 21 * 3
    st = {b["channel"]: b for b in made.band_stats.collect()}
    one = made.sample.filter("split='val'").orderBy("sample_id").first()
    got = made.inputs("val", [one["sample_id"]]).collect()
    assert len(got) == 12 * 2 * 9
    for g in got:
        i, j, m = one["row_off"] + g["i"], one["col_off"] + g["j"], one["input_month_indices"][g["t"]]
        raw = x[m, i, j] if g["channel"] == "temp" else np.mean([i + j + k % 2 for k in range(15)])
        b = st[g["channel"]]
        assert g["z"] == pytest.approx(((b["fill"] if np.isnan(raw) else raw) - b["mean"]) / b["std"])
    for t in made.targets("val", [one["sample_id"]]).collect():
        v = x[one["target_month_index"], one["row_off"] + t["i"], one["col_off"] + t["j"]]
        assert t["mask"] == np.isfinite(v) and t["y"] == pytest.approx(((st["temp"]["fill"] if np.isnan(v) else v) - st["temp"]["mean"]) / st["temp"]["std"])
    index = sinks.sample_index(spark, f"{tmp_path}/out/sample_index.jsonl", "test")
    assert [r["sample_id"] for r in index.collect()] == [r["sample_id"] for r in made.sample.filter("split='test'").orderBy("sample_id").collect()]
    meta = sinks.read_json(spark, f"{tmp_path}/out/metadata.json")
    counts = {r["split"]: r["count"] for r in made.sample.groupBy("split").count().collect()}
    assert meta["samples"] == counts and counts["train"] == 45 and sum(counts.values()) == 63 and meta["sample_pct"]["train"] == pytest.approx(100 * 45 / 63) and len(meta["months_used"]) == 15
    norm = sinks.read_json(spark, f"{tmp_path}/out/normalization_stats.json")
    assert norm["channels"] == ["temp", "elev"] and norm["min_std_guard"] == 1e-8 and norm["means"][0] == st["temp"]["mean"]
    assert sum(sinks.read_json(spark, f"{tmp_path}/out/split_config.json")["pixel_pct"].values()) == pytest.approx(100)
    val = sorted(r["sample_id"] for r in made.sample.filter("split='val'").collect())
    assert made.length("val") == len(val) and [r["sample_id"] for r in made.at("val", [0, len(val) - 1, len(val)]).orderBy("position").collect()] == [val[0], val[-1]]
    report = {r["split"]: r.asDict() for r in build.verify_dataset(made).collect()}
    assert all(r["errors"] == r["nan"] == r["months_out_of_order"] == 0 and r["samples"] == 3 for r in report.values()) and len(report) == 3
    assert len(verify.require(build.verify_dataset(made))) == 3
    picked = made.sample.filter("split='test'").orderBy("sample_id").limit(1)
    wrong = made.targets("test").withColumn("mask", ~F.col("mask"))
    with pytest.raises(verify.VerifyError):
        verify.require(build.verify_dataset(made, target=wrong))
    assert verify.target_report(wrong, picked, cube, made.band_stats, "temp").first()["masks_wrong"] == 9
    again = build.open_dataset(spark, conf, cube)
    assert again.labels == made.labels and again.inputs("val", [one["sample_id"]]).count() == 12 * 2 * 9
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        build.build(conf, months, cube, surrogate.region(spark), 16, 16)
    short = build.build(conf.override(test_months=2, output_dir=f"{tmp_path}/short"), months, cube, surrogate.region(spark), 16, 16)
    assert short.sample.count() == 21
    meta = sinks.read_json(spark, f"{tmp_path}/short/metadata.json")
    assert meta["mode"] == "test" and meta["samples"]["train"] == 15 and meta["projected_samples"]["train"] == 45
    effective = cfg.load(next(str(f) for f in (tmp_path / "short/effective_config.yaml").iterdir() if f.name.startswith("part")))
    assert effective == conf.override(test_months=2, output_dir=f"{tmp_path}/short")
    with pytest.raises(partition.SplitError):
        build.build(conf.override(min_pixels_per_split=10**6, output_dir=f"{tmp_path}/few"), months, cube, surrogate.region(spark), 16, 16)


def test_cube_is_written_by_month_in_tile_order(spark, tmp_path):
    df = spark.range(2 * 64).select((F.col("id") % 2).cast("int").alias("month_idx"), (F.col("id") / 16).cast("int").alias("row"), (F.col("id") / 2 % 8).cast("int").alias("col"), F.col("id").alias("v"))
    sinks.cube(df, f"{tmp_path}/cube", tile=4)
    assert sorted(os.listdir(tmp_path / "cube"))[-2:] == ["month_idx=0", "month_idx=1"] or "month_idx=0" in os.listdir(tmp_path / "cube")
    assert spark.read.parquet(f"{tmp_path}/cube").count() == 128


#: A grid in a UTM zone, and a boundary in degrees around most of it.
TRANSFORM = (30.0, 0.0, 771200.0, 0.0, -30.0, 1438420.0)
BOUNDARY = [[77.5005, 12.9960], [77.5040, 12.9960], [77.5043, 12.9999], [77.5008, 12.9998], [77.5005, 12.9960]]


def geojson(path, *rings):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [r]}} for r in rings]}))
    return str(path)


def test_rasters_to_dataset_in_one_call(spark, tmp_path, capsys, monkeypatch):
    r = np.random.default_rng(9)
    (tmp_path / "in").mkdir()
    for m in range(1, 7):
        x = r.normal(size=(2, 16, 16)).astype(np.float32)
        x[0, m, 3:5] = np.nan
        (tmp_path / f"in/Z_2020_{m:02d}_18features.tif").write_bytes(geotiff.write(x, TRANSFORM, ["temp", "elev"], 32643))
    conf = cfg.Config(
        cfg.Paths(f"{tmp_path}/in", f"{tmp_path}/out", geojson(tmp_path / "b.geojson", BOUNDARY)),
        cfg.DataConfig(sequence_length=3, patch_size=2, stride=2, channel_names=("temp", "elev"), target_channel="temp", static_channels=("elev",)),
    )
    made = build.from_rasters(spark, conf)
    inside = made.pixel.filter("in_region").count()
    assert 60 < inside < 256 and made.patch.count() > 0 and made.sample.count() == made.patch.count() * 3
    assert all(x["errors"] == 0 for x in verify.require(build.verify_dataset(made)))
    (tmp_path / "c.yaml").write_text(cfg.as_yaml(conf))
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert main(["verify", "--config", str(tmp_path / "c.yaml")]) == 0
    assert {x["split"] for x in json.loads(capsys.readouterr().out)} == {"train", "val", "test"}
    assert main(["build", "--config", str(tmp_path / "c.yaml"), "--mode", "test", "--test-months", "4", "--overwrite"]) == 0
    assert sinks.read_json(spark, f"{tmp_path}/out/metadata.json")["months_used"] == ["2020-01", "2020-02", "2020-03", "2020-04"]
    with pytest.raises(catalog.CatalogError):
        build.from_rasters(spark, conf.override(channel_names=("elev", "temp"), output_dir=f"{tmp_path}/other"))


def mask_inputs(tmp_path, legend=True):
    r = np.random.default_rng(3)
    land = r.choice([10, 30, 50, 80], size=(1, 48, 48), p=[0.4, 0.3, 0.1, 0.2]).astype(np.uint8)
    land[0, 18:27, 18:27] = 50
    land[0, :3, :3] = 0
    tags = {"legend": "10 Tree cover\n30 Grassland\n50 Built-up\n80 Water & ice", "product_version": "V2.0.0"} if legend else None
    (tmp_path / "land.tif").write_bytes(geotiff.write(land, (10.0, 0.0, 771200.0, 0.0, -10.0, 1438420.0), epsg=32643, nodata=0, tags=tags))
    (tmp_path / "grid.tif").write_bytes(geotiff.write(np.zeros((1, 16, 16), np.float32), TRANSFORM, epsg=32643))
    return land[0], {k: f"{tmp_path}/{k}.tif" for k in ("land", "grid")} | {"boundary": geojson(tmp_path / "b.geojson", BOUNDARY)}


def test_masks_build(spark, tmp_path, capsys, monkeypatch):
    import glob

    land, paths = mask_inputs(tmp_path)
    conf = masks.MaskConfig(paths["land"], paths["boundary"], paths["grid"], f"{tmp_path}/out", buffer_metres=75.0)
    made = masks.build(spark, conf)
    grid = np.zeros((16, 16), int)
    for i in range(16):
        for j in range(16):
            c, n = np.unique(b := land[3 * i : 3 * i + 3, 3 * j : 3 * j + 3][land[3 * i : 3 * i + 3, 3 * j : 3 * j + 3] > 0], return_counts=True)
            grid[i, j] = c[n == n.max()].min() if b.size else 0
    study = np.zeros((16, 16), bool)
    for x in made.masks.collect():
        study[x["row"], x["col"]] = x["in_study"]
    urban = (grid == 50) & study
    near = np.zeros((16, 16), bool)
    for i in range(16):
        for j in range(16):
            near[i, j] = any(0 < 900 * ((i - a) ** 2 + (j - b) ** 2) <= 75.0**2 for a, b in zip(*np.nonzero(urban), strict=True))
    near &= ~urban
    rural = near & np.isin(grid, landcover.RURAL) & study
    m = made.metadata
    assert (m["urban_pixel_count"], m["rural_pixel_count"], m["study_pixel_count"]) == (urban.sum(), rural.sum(), study.sum()) and 0 < rural.sum()
    assert (m["rural_ring_pixel_count_before_class_filter"], m["rural_ring_pixels_dropped_by_class_filter"]) == (near.sum(), (near & ~np.isin(grid, landcover.RURAL)).sum())
    assert m["urban_pct_of_study"] == pytest.approx(100 * urban.sum() / study.sum()) and m["worldcover_version"] == "V2.0.0" and m["worldcover_legend_source"] == "tag"
    assert made.errors == [] and {w for w in made.warnings} == {f"class {c} is not in the legend" for c in (20, 40, 60)}
    assert sinks.read_json(spark, f"{tmp_path}/out/mask_metadata.json") == json.loads(json.dumps(m, default=str))
    for kind, want in (("urban", urban), ("rural", rural)):
        t = geotiff.Tiff(open(glob.glob(f"{tmp_path}/out/{kind}_mask/part-*")[0], "rb").read())
        assert np.array_equal(next(iter(t.blocks()))[3], want.astype(np.uint8)) and t.grid().nodata == 0 and t.items()["worldcover_version"] == "V2.0.0"
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        masks.build(spark, conf)
    monkeypatch.setattr(spark, "stop", lambda: None)
    args = ["masks", "--land-cover", paths["land"], "--study-boundary", paths["boundary"], "--reference-grid", paths["grid"], "--output-dir", f"{tmp_path}/two", "--rural-buffer-km", "0.075", "--no-clip-to-boundary"]
    assert main(args) == 0
    found = json.loads(capsys.readouterr().out)
    assert found["percentage_denominator_pixels"] == 256 and found["urban_pixel_count"] == (grid == 50).sum()
    assert main([*args[:-5], "--output-dir", f"{tmp_path}/three", "--rural-buffer-km", "0.001"]) == 1


def test_masks_build_refuses_what_it_cannot_place(spark, tmp_path):
    _, paths = mask_inputs(tmp_path, legend=False)
    conf = masks.MaskConfig(paths["land"], paths["boundary"], paths["grid"], f"{tmp_path}/out", buffer_metres=75.0)
    made = masks.build(spark, conf)
    assert made.metadata["worldcover_legend_source"] == "fallback" and "the land cover has no legend that can be read" in made.warnings
    (tmp_path / "bare.tif").write_bytes(geotiff.write(np.zeros((1, 4, 4), np.float32), TRANSFORM))
    with pytest.raises(geotiff.RasterError):
        masks.build(spark, masks.MaskConfig(paths["land"], paths["boundary"], f"{tmp_path}/bare.tif", f"{tmp_path}/no"))
    with pytest.raises(landcover.MaskError):
        masks.build(spark, masks.MaskConfig(paths["land"], paths["boundary"], paths["grid"], f"{tmp_path}/none", urban_class=95))


def test_tags_of_a_raster(spark):
    tags = {"legend": "1 a < b\n2 c & d", "note": "x"}
    data = geotiff.write(np.zeros((1, 2, 2), np.uint8), names=["a & b"], tags=tags)
    t = geotiff.Tiff(data)
    assert t.items() == tags and t.grid().descriptions == ("a & b",)
    rows = spark.createDataFrame([("p", bytearray(data)), ("q", bytearray(geotiff.write(np.zeros((1, 2, 2), np.uint8))))], "path string, content binary")
    assert {tuple(r) for r in geotiff.tags(rows).collect()} == {("p", k, v) for k, v in tags.items()}
