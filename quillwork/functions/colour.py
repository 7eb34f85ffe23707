"""Colour-space conversion: forward as steps of SQL, so that tables and model stages share them; back as
column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.functions.fixed import (
    LAB_CUT,
    LAB_OFFSET,
    LAB_SLOPE,
    RGB_TO_XYZ,
    SRGB_CUT,
    SRGB_GAMMA,
    SRGB_OFFSET,
    SRGB_SCALE,
    SRGB_SLOPE,
    WHITE_XYZ,
)

Steps = dict[str, str]  # names and what they stand for; a step may use the ones before it


def unit_steps(channels: list[str], full: float) -> Steps:
    """The channels on the 0-1 scale as ``_unit0``, ``_unit1`` and ``_unit2``."""
    return {f"_unit{i}": f"CAST(`{c}` AS DOUBLE) / {full!r}D" for i, c in enumerate(channels)}


def light_steps() -> Steps:
    """Linear light of the unit channels: the sRGB transfer curve undone."""
    return {
        f"_light{i}": f"CASE WHEN _unit{i} > {SRGB_CUT}D "
                      f"THEN power((_unit{i} + {SRGB_OFFSET}D) / {SRGB_SCALE}D, {SRGB_GAMMA}D) "
                      f"ELSE _unit{i} / {SRGB_SLOPE}D END"
        for i in range(3)
    }


def response_steps() -> Steps:
    """XYZ over the white point, through the cube root with its straight part near black."""
    out = {}
    for i, (row, white) in enumerate(zip(RGB_TO_XYZ, WHITE_XYZ)):
        weighted = " + ".join(f"_light{j} * {w}D" for j, w in enumerate(row))
        out[f"_ratio{i}"] = f"({weighted}) / {white}D"
        out[f"_curve{i}"] = (f"CASE WHEN _ratio{i} > {LAB_CUT}D THEN power(_ratio{i}, 1D / 3D) "
                             f"ELSE _ratio{i} * {LAB_SLOPE}D + 16D / 116D END")
    return out


def lab_steps(channels: list[str], full: float, lightness: str, a: str, b: str) -> Steps:
    return {
        **unit_steps(channels, full), **light_steps(), **response_steps(),
        lightness: "_curve1 * 116D - 16D",
        a: "(_curve0 - _curve1) * 500D",
        b: "(_curve1 - _curve2) * 200D",
    }


def hsv_steps(channels: list[str], full: float, hue: str, saturation: str, value: str) -> Steps:
    """Hue on the 0-1 circle; grey has hue and saturation 0."""
    return {
        **unit_steps(channels, full),
        "_top": "greatest(_unit0, _unit1, _unit2)",
        "_spread": "_top - least(_unit0, _unit1, _unit2)",
        "_sixths": "CASE WHEN _spread = 0 THEN 0D WHEN _unit0 = _top THEN (_unit1 - _unit2) / _spread "
                   "WHEN _unit1 = _top THEN (_unit2 - _unit0) / _spread + 2D "
                   "ELSE (_unit0 - _unit1) / _spread + 4D END",
        hue: "pmod(_sixths, 6D) / 6D",
        saturation: "CASE WHEN _spread = 0 THEN 0D ELSE _spread / _top END",
        value: "_top",
    }


def lab_curve_inverse(response: Column) -> Column:
    """The ratio to white that a LAB response stands for."""
    cube = response * response * response
    return F.when(cube > LAB_CUT, cube).otherwise((response - LAB_OFFSET) / LAB_SLOPE)


def companded(channel: Column) -> Column:
    """Linear light back to the sRGB curve."""
    bent = F.pow(channel, F.lit(1.0 / SRGB_GAMMA)) * SRGB_SCALE - SRGB_OFFSET
    return F.when(channel > SRGB_CUT / SRGB_SLOPE, bent).otherwise(channel * SRGB_SLOPE)
