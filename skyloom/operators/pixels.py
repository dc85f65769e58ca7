"""Images as pixel tables (image_id, x, y, v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyloom.functions.common import num
from skyloom.functions.weights import centroid
from skyloom.operators.quantiles import aggregate_with_quantiles
from skyloom.operators.skew import by_shuffle, pick_first
from skyloom.session import stored


def stack(pixels: DataFrame) -> DataFrame:
    """Mean, median and inverse-variance mean (variance = |v|) of aligned images per pixel."""
    weight = 1.0 / F.greatest(F.abs("v"), num(1e-9))
    out = aggregate_with_quantiles(
        pixels, ["x", "y"], [F.count("*").alias("n"), F.avg("v").alias("mean"), centroid("v", weight).alias("weighted_mean")], {"_q": ("v", [0.5])}
    )
    return out.select("x", "y", "n", "mean", F.col("_q")[0].alias("median"), "weighted_mean")


def moments(pixels: DataFrame, keys: list[str], weight: str = "v") -> DataFrame:
    """Centroid, widths and their root mean square of an image of weights."""
    first = pixels.groupBy(*keys).agg(
        centroid("x", weight).alias("mu_x"), centroid("y", weight).alias("mu_y"),
        centroid(F.col("x") * F.col("x"), weight).alias("_xx"), centroid(F.col("y") * F.col("y"), weight).alias("_yy"),
    )
    vx, vy = F.col("_xx") - F.col("mu_x") * F.col("mu_x"), F.col("_yy") - F.col("mu_y") * F.col("mu_y")
    return first.select(
        *keys, "mu_x", "mu_y", F.sqrt(F.greatest(vx, num(0.0))).alias("sigma_x"), F.sqrt(F.greatest(vy, num(0.0))).alias("sigma_y"),
        F.sqrt(F.greatest(0.5 * (vx + vy), num(0.0))).alias("sigma_rms"),
    )


def with_reference(pixels: DataFrame, reference: DataFrame, name: str = "ref") -> DataFrame:
    """Value of the reference image at every pixel. The reference is one image, so this side is small."""
    return pixels.join(reference.select("x", "y", F.col("v").alias(name)), ["x", "y"])


def correlation(pixels: DataFrame, reference: DataFrame) -> DataFrame:
    """Correlation of each image with the reference, 0 if one of them is flat."""
    both = with_reference(pixels, reference)
    return both.groupBy("image_id").agg(F.coalesce(F.corr("v", "ref"), num(0.0)).alias("correlation"))


def outlier_mask(pixels: DataFrame, reference: DataFrame, factor: float) -> DataFrame:
    """Pixels that differ from the scaled reference by more than ``factor`` deviations in any image.

    The scale of each image is a line fit on the positive pixels of the reference.
    """
    both = with_reference(pixels, reference)
    fit = both.where("ref > 0").groupBy("image_id").agg(F.regr_slope("v", "ref").alias("_a"), F.regr_intercept("v", "ref").alias("_b"))
    diff = both.join(fit, "image_id").withColumn("_d", F.col("ref") * F.col("_a") + F.col("_b") - F.col("v"))
    spread = diff.groupBy("image_id").agg(F.stddev_pop("_d").alias("_s"))
    flagged = diff.join(spread, "image_id").withColumn("_out", F.abs("_d") > factor * F.col("_s"))
    return flagged.groupBy("x", "y").agg(F.count_if("_out").alias("n_outliers"), F.bool_or("_out").alias("masked"))


def crop(pixels: DataFrame, x0, y0, width: int, height: int, nx: int, ny: int) -> DataFrame:
    """Box of the given size around a centre, clipped to the image, in its own pixel origin."""
    x0, y0 = (c if isinstance(c, Column) else F.lit(c) for c in (x0, y0))
    left, right = F.greatest(x0 - width // 2, F.lit(0)), F.least(x0 + width // 2, F.lit(nx))
    low, high = F.greatest(y0 - height // 2, F.lit(0)), F.least(y0 + height // 2, F.lit(ny))
    inside = (F.col("x") >= left) & (F.col("x") < right) & (F.col("y") >= low) & (F.col("y") < high)
    return pixels.where(inside).withColumn("x", (F.col("x") - left).cast("int")).withColumn("y", (F.col("y") - low).cast("int"))


def stamp_statistics(pixels: DataFrame, images: DataFrame, n_stamps: int, stamp: Column, std_limit: float) -> DataFrame:
    """Median and deviation per image and stamp; a missing stamp gets −99 and ten times the limit."""
    found = aggregate_with_quantiles(
        pixels.withColumn("stamp_id", stamp), ["image_id", "stamp_id"], [F.stddev_pop("v").alias("std")], {"_q": ("v", [0.5])}
    )
    grid = images.select("image_id", F.explode(F.sequence(F.lit(0), F.lit(n_stamps - 1))).alias("stamp_id"))
    out = grid.join(found, ["image_id", "stamp_id"], "left")
    return out.select(
        "image_id", "stamp_id", F.coalesce(F.col("_q")[0], num(-99.0)).alias("median"), F.coalesce("std", num(10 * std_limit)).alias("std")
    )


def saturated_blocks(pixels: DataFrame, block: int, saturation: float) -> DataFrame:
    """Saturated pixels per block and their fraction; ``best`` marks the block with the fewest per image."""
    blocks = pixels.groupBy("image_id", F.floor(F.col("x") / block).alias("bx"), F.floor(F.col("y") / block).alias("by")).agg(
        F.count_if(F.col("v") >= saturation).alias("n_saturated"), F.avg(F.when(F.col("v") >= saturation, 1.0).otherwise(0.0)).alias("fraction")
    )
    best = pick_first(blocks, ["image_id"], [F.col("n_saturated"), F.col("bx"), F.col("by")], ["bx", "by"])
    return blocks.join(best.withColumn("_best", F.lit(True)), ["image_id", "bx", "by"], "left").select(
        *blocks.columns, F.coalesce("_best", F.lit(False)).alias("best")
    )


def mask_radius(pixels: DataFrame, keys: list[str], radius: str, value: str, saturation: float, threshold: float) -> DataFrame:
    """Smallest radius at which an unsaturated pixel is below the threshold."""
    return pixels.where((F.col(value) < saturation) & (F.col(value) < threshold)).groupBy(*keys).agg(F.min(radius).alias("mask_radius"))


def connected_pixels(pixels: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Clusters of touching pixels (8 neighbours) per image with their pixel ranges.

    Each round every cluster takes the smallest label next to any of its pixels as its parent, and
    parents are followed eight steps, so clusters merge many at a time and the number of rounds
    grows with the logarithm of a cluster's length. A round is one shuffled equi-join on pixel positions;
    labels are written out between rounds and the loop ends when no cluster has a new parent.
    """
    steps = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (dx, dy) != (0, 0)]
    at = ["image_id", "x", "y"]
    labels = stored(pixels.select(*at).distinct().withColumn("label", F.struct("y", "x")))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in steps])
    for _ in range(max_rounds):
        # every pixel sends its label to the eight positions around it
        sent = labels.select("image_id", "label", "x", "y", F.explode(offsets).alias("o")).select(
            "image_id", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"), F.col("label").alias("near")
        )
        lowest = sent.groupBy(*at).agg(F.min("near").alias("near"))
        parents = stored(
            labels.join(by_shuffle(lowest), at, "left").groupBy("image_id", "label")
            .agg(F.min(F.least("label", F.coalesce("near", "label"))).alias("up")).where("up != label")
        )
        if parents.isEmpty():
            break
        for _ in range(3):
            further = parents.select("image_id", F.col("label").alias("up"), F.col("up").alias("upper"))
            parents = parents.join(by_shuffle(further), ["image_id", "up"], "left").select("image_id", "label", F.coalesce("upper", "up").alias("up"))
        labels = stored(
            labels.join(by_shuffle(parents), ["image_id", "label"], "left").select(*at, F.coalesce("up", "label").alias("label"))
        )
    else:
        raise RuntimeError("labels did not settle; raise max_rounds")
    return labels.groupBy("image_id", "label").agg(
        F.count("*").alias("n_pixels"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max")
    ).select("image_id", F.col("label.y").alias("label_y"), F.col("label.x").alias("label_x"), "n_pixels", "x_min", "x_max", "y_min", "y_max")
