"""Augmentation: drawn photometric parameters and a drawn affine map that moves the line boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draws as D
from ..functions import geometry as G


def parameters(seed: Column, enabled: bool) -> Column:
    """The metadata struct; optional parameters are null where their coin says no."""
    u = lambda low, high, name: F.bround(D.uniform(low, high, seed, name), 4)
    coin = lambda p, name: D.unit(seed, "coin", name) < p
    if not enabled:
        none = lambda kind: F.lit(None).cast(kind)
        return F.struct(F.lit(False).alias("enabled"), *[none("double").alias(n) for n in ("brightness", "contrast", "blur_radius", "gaussian_noise_sigma")], none("bigint").alias("jpeg_quality"), *[none("double").alias(n) for n in ("angle", "scale", "tx", "ty")])
    sigma = u(0.0, 7.5, "sigma")
    return F.struct(
        F.lit(True).alias("enabled"), u(0.82, 1.18, "brightness").alias("brightness"), u(0.86, 1.22, "contrast").alias("contrast"),
        F.when(coin(0.35, "blur"), u(0.25, 0.9, "blur")).alias("blur_radius"), F.when(sigma > 1, sigma).alias("gaussian_noise_sigma"), F.when(coin(0.45, "jpeg"), D.between(68, 94, seed, "jpeg")).alias("jpeg_quality"),
        u(-2.0, 2.0, "angle").alias("angle"), u(0.985, 1.02, "scale").alias("scale"), u(-8.0, 8.0, "tx").alias("tx"), u(-8.0, 8.0, "ty").alias("ty"),
    )


def apply(lines: DataFrame, enabled: bool) -> DataFrame:
    """lines with aug (parameters and the map's six numbers) and moved boxes; without enabled, boxes are untouched."""
    out = lines.withColumn("aug", parameters(F.col("seed"), enabled))
    if not enabled:
        return out.withColumn("aug", F.col("aug").withField("matrix", F.lit(None).cast("array<double>")))
    a = F.col("aug")
    matrix = G.affine(a["angle"], a["scale"], a["tx"], a["ty"], F.col("width"), F.col("height"))
    kept = F.array(*[F.bround(x, 6) for x in matrix])
    return out.withColumns({"b": G.clamp(G.transformed(F.col("b"), matrix), F.col("width"), F.col("height")), "aug": a.withField("matrix", kept)})
