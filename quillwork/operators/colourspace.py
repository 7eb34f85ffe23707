"""RGB, HSV and LAB tables, and the colour-word palette."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.functions import colour as C
from quillwork.functions.fixed import PALETTE, RGB_TO_XYZ, WHITE_XYZ

# The columns of each space, unless a conversion is given other names for some of them.
RGB = {"red": "R", "green": "G", "blue": "B"}
SPACES = {
    "lab": ({"lightness": "labL", "a": "labA", "b": "labB"}, C.lab_steps),
    "hsv": ({"hue": "H", "saturation": "S", "value": "V"}, C.hsv_steps),
}


def conversion(space: str, kept: list[str], names: Mapping[str, str] = {}, full: float = 255.0,
               source: str = "__THIS__") -> str:
    """The conversion from RGB as one SQL statement, e.g. for an ``SQLTransformer`` inside a model.

    It selects the columns ``kept`` and those of the space; ``names`` renames any of red, green, blue and
    the space's own; ``full`` is the value of a full channel.  Each step is written, and computed, once.
    """
    out, steps = SPACES[space]
    called = {**RGB, **out, **names}
    found = steps([called[c] for c in RGB], full, *[called[c] for c in out])
    listed = ", ".join(f"{formula} AS `{name}`" for name, formula in found.items())
    columns = ", ".join(f"`{c}`" for c in [*kept, *[called[c] for c in out]])
    return f"SELECT {columns} FROM (SELECT *, {listed} FROM {source})"


def converted(df: DataFrame, space: str, names: Mapping[str, str] = {}, full: float = 255.0) -> DataFrame:
    """``df`` with the columns of ``lab`` or ``hsv`` added."""
    return df.sparkSession.sql(conversion(space, df.columns, names, full, "{df}"), df=df)


def _inverse(matrix: list[list[float]]) -> list[list[float]]:
    import numpy as np

    return np.linalg.inv(np.array(matrix)).tolist()


def lab_to_rgb(df: DataFrame, names: Mapping[str, str] = {}) -> DataFrame:
    """Add RGB columns on the 0-255 scale, clipped to displayable colours; ``names`` as above."""
    called = {**RGB, **SPACES["lab"][0], **names}
    fy = (F.col(called["lightness"]) + 16.0) / 116.0
    responses = [F.col(called["a"]) / 500.0 + fy, fy, fy - F.col(called["b"]) / 200.0]
    # Blue beyond what exists has no negative response.
    responses[2] = F.greatest(responses[2], F.lit(0.0))
    xyz = [C.lab_curve_inverse(f) * white for f, white in zip(responses, WHITE_XYZ)]
    staged = df.select("*", F.struct(*[v.alias(n) for v, n in zip(xyz, "xyz")]).alias("_xyz"))
    channels = []
    for row, name in zip(_inverse(RGB_TO_XYZ), [called[c] for c in RGB]):
        linear = sum(F.col(f"_xyz.{n}") * weight for n, weight in zip("xyz", row))
        shown = F.least(F.greatest(C.companded(linear), F.lit(0.0)), F.lit(1.0))
        channels.append((shown * 255.0).alias(name))
    return staged.select(*df.columns, *channels)


def lab_grid(spark: SparkSession, lightness: float = 70.0, resolution: int = 256,
             partitions: int | None = None) -> DataFrame:
    """A square slice of LAB space at one lightness, a and b from -100 to 100, with its RGB."""
    step = 200.0 / (resolution - 1)
    cell = spark.range(0, resolution * resolution, 1, partitions)
    points = cell.select(
        F.lit(float(lightness)).alias("labL"),
        (F.col("id") % resolution * step - 100.0).alias("labA"),
        (F.floor(F.col("id") / resolution) * step - 100.0).alias("labB"),
    )
    return lab_to_rgb(points)


def palette(spark: SparkSession) -> DataFrame:
    """The colour words with their representative colour."""
    return spark.createDataFrame(PALETTE, "word string, R int, G int, B int")


def nearest_word(df: DataFrame, out: str = "word", names: Mapping[str, str] = {}) -> DataFrame:
    """Label each colour with the closest palette word (ties: alphabetical), row by row."""
    r, g, b = ({**RGB, **names}[c] for c in RGB)
    choices = F.array_min(F.array(*[
        F.struct(
            (F.pow(F.col(r) - R, 2.0) + F.pow(F.col(g) - G, 2.0) + F.pow(F.col(b) - B, 2.0))
            .alias("d"),
            F.lit(word).alias("w"),
        )
        for word, R, G, B in PALETTE
    ]))
    return df.withColumn(out, choices["w"])


def with_palette(df: DataFrame, word: str = "word",
                 out: tuple[str, str, str] = ("showR", "showG", "showB")) -> DataFrame:
    """Add the representative colour of a word; unknown words get NULL."""
    pairs = [
        cell for name, *rgb in PALETTE
        for cell in (F.lit(name), F.array(*[F.lit(channel) for channel in rgb]))
    ]
    shown = F.try_element_at(F.create_map(*pairs), F.col(word))
    return df.withColumns({name: F.get(shown, F.lit(i)) for i, name in enumerate(out)})
