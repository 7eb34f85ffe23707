import colorsys

import pytest

from quillwork.functions.fixed import PALETTE
from quillwork.operators import colourspace

# Published LAB values of the primaries (D65, 2 degrees).
KNOWN_LAB = {
    (255, 255, 255): (100.0, 0.0, 0.0), (0, 0, 0): (0.0, 0.0, 0.0),
    (255, 0, 0): (53.24, 80.09, 67.20), (0, 255, 0): (87.73, -86.18, 83.18),
    (0, 0, 255): (32.30, 79.19, -107.86),
}


def rgb(spark, rows):
    return spark.createDataFrame(list(rows), "R int, G int, B int")


def test_lab_of_known_colours(spark):
    for r in colourspace.converted(rgb(spark, KNOWN_LAB), "lab").collect():
        assert (r.labL, r.labA, r.labB) == pytest.approx(KNOWN_LAB[(r.R, r.G, r.B)], abs=0.03)


def test_hsv_matches_colorsys_with_ties_and_grey(spark):
    rows = [(a, b, c) for a in (0, 90, 255) for b in (0, 90, 255) for c in (0, 90, 255)]
    for r in colourspace.converted(rgb(spark, rows), "hsv").collect():
        wanted = colorsys.rgb_to_hsv(r.R / 255, r.G / 255, r.B / 255)
        assert (r.H, r.S, r.V) == pytest.approx(wanted, abs=1e-12)


def test_lab_round_trip_and_other_columns(spark):
    df = rgb(spark, [(10, 200, 30), (255, 187, 187), (1, 2, 3)]).selectExpr("*", "'keep' tag")
    back = colourspace.lab_to_rgb(
        colourspace.converted(df, "lab"), {"red": "r2", "green": "g2", "blue": "b2"})
    for r in back.collect():
        assert (r.r2, r.g2, r.b2) == pytest.approx((r.R, r.G, r.B), abs=0.2)
        assert r.tag == "keep"


def test_unit_input(spark):
    df = rgb(spark, [(255, 0, 51)])
    unit = df.selectExpr("R / 255 R", "G / 255 G", "B / 255 B")
    a, b = colourspace.converted(df, "lab").first(), colourspace.converted(unit, "lab", full=1.0).first()
    assert (a.labL, a.labA, a.labB) == pytest.approx((b.labL, b.labA, b.labB))


def test_grid(spark):
    grid = colourspace.lab_grid(spark, 70.0, 5)
    rows = grid.collect()
    assert len(rows) == 25
    assert {r.labA for r in rows} == {r.labB for r in rows} == {-100.0, -50.0, 0.0, 50.0, 100.0}
    assert all(0 <= v <= 255 for r in rows for v in (r.R, r.G, r.B))
    middle = next(r for r in rows if r.labA == r.labB == 0.0)
    assert middle.R == pytest.approx(middle.G, abs=0.2) and middle.R == pytest.approx(middle.B, abs=0.2)


def test_palette_words(spark):
    df = rgb(spark, [p[1:] for p in PALETTE])
    words = {(r.R, r.G, r.B): r.word for r in colourspace.nearest_word(df).collect()}
    assert words == {p[1:]: p[0] for p in PALETTE}
    shown = colourspace.with_palette(spark.createDataFrame([("pink",), ("teal",)], "word string"))
    assert {r.word: r.showG for r in shown.collect()} == {"pink": 187, "teal": None}
