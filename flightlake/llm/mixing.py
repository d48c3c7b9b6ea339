"""Mixing sources to target weights: weighted sampling without replacement, epoch by epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import WORD, free_name, stored, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
# How much likelier a document labelled good or bad is drawn than one without a label.
QUALITY = {1: 2.0, 0: 0.5}
BUCKETS = 4096
# So many sources (a name and some numbers each) are sent to every executor; more are shuffled.
MOST_BROADCAST = 100_000


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, quality_weight; of several labels of a document the best counts."""
    best = (
        labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"))
    )
    weight = F.when(F.col("q") >= 1, QUALITY[1]).when(F.col("q") <= 0, QUALITY[0]).otherwise(1.0)
    return best.select("doc_id", weight.alias("quality_weight"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Targets from one row per source (no_source, source, source_size).

    Shares are filled like water: the level is raised until the targets add up, and a source
    stops at `most` times its size. In order of that limit per weight, the first source the
    level of the rest does not lift above its limit sets the level. The windows hold one row
    per source.
    """
    by_name = Window.orderBy("no_source", "source")
    by_limit = Window.orderBy("limit_ratio", "place")
    below = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    above = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("limit_ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everywhere) * F.lit(float(share)))
    )
    levels = ranked.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("limit").over(below), F.lit(0)))
        / F.sum("weight").over(above),
    )
    settled = F.when(F.col("level") <= F.col("limit_ratio"), F.struct("limit_ratio", "place", "level"))
    return (
        levels.withColumn("settled", F.min(settled).over(everywhere))
        .withColumn(
            "target",
            F.least(
                F.col("limit").cast("double"),
                F.coalesce(F.col("settled.level") * F.col("weight"), F.col("limit").cast("double")),
            ),
        )
        .select("no_source", "source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The documents with size, source_size, target, copies and taken (= copies * size).

    Size is the number of words. A source's target is met by whole epochs over all its
    documents, then by a fraction of one: documents in order of an exponential key, drawn from a
    hash of the id and divided by the quality weight, until the running sum of sizes passes what
    is left; the document in which it ends is taken if its middle lies before the end.

    The running sum is two-level: sums of whole key ranges (`buckets` a source), and inside the
    one range in which a source's sum ends a window over its documents. So a source of any size
    is added up by all tasks. What comes back to the documents is a row per source with the last
    key taken.

    Null text has size 0 and is taken 0 times its words; a null id draws as empty text; rows
    without source form one source, the last. Rows that repeat an id are documents of their own
    with equal keys, ordered by size; those alike in both are taken or left together. An empty
    table gives no rows. Input columns named like an output column are replaced.
    """
    own = docs.drop(*[c for c in docs.columns if c.lower() in OUT])
    sized, name = _keyed(own, quality, buckets)
    slim = sized.select(
        F.col(name["nosrc"]).alias("no_source"),
        F.col(name["src"]).alias("source"),
        F.col(name["bucket"]).alias("bucket"),
        F.struct(F.col(name["key"]).alias("key"), F.col("doc_id").alias("id"), "size").alias("at"),
        "size",
    )
    ranges = slim.groupBy("no_source", "source", "bucket").agg(F.sum("size").alias("range_size"))
    sizes = ranges.groupBy("no_source", "source").agg(F.sum("range_size").alias("source_size"))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    targets = (
        source_targets(sizes, weights, share, most)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    before = (
        Window.partitionBy("no_source", "source")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    based = ranges.withColumn("base", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    # The range in which the sum ends: the last one that begins before the end.
    reached = (
        based.join(targets, ["no_source", "source"])
        .filter(F.col("base") < F.col("left"))
        .groupBy("no_source", "source")
        .agg(F.max(F.struct("bucket", "base", "left")).alias("end"))
    )
    inside = Window.partitionBy("no_source", "source").orderBy("at")
    last = (
        slim.join(reached, ["no_source", "source"])
        .filter(F.col("bucket") == F.col("end.bucket"))
        .withColumn("run", F.sum("size").over(inside))
        .filter(F.col("end.base") + F.col("run") - F.col("size") / 2 < F.col("end.left"))
        .groupBy("no_source", "source")
        .agg(F.max("at").alias("last"))
    )
    sources = stored(
        targets.join(reached, ["no_source", "source"], "left")
        .join(last, ["no_source", "source"], "left")
        .select(
            F.col("no_source").alias("plan_no_source"),
            F.col("source").alias("plan_source"),
            F.col("end.bucket").alias("plan_bucket"),
            F.col("last").alias("plan_last"),
            F.col("epochs").alias("plan_epochs"),
            "source_size",
            "target",
        )
    )
    few = sources.count() <= MOST_BROADCAST
    joined = sized.join(
        F.broadcast(sources) if few else sources,
        (sized[name["nosrc"]] == sources["plan_no_source"])
        & (sized[name["src"]] == sources["plan_source"]),
    )
    at = F.struct(F.col(name["key"]).alias("key"), F.col("doc_id").alias("id"), "size")
    drawn = F.coalesce(
        (F.col(name["bucket"]) < F.col("plan_bucket"))
        | (F.col(name["bucket"]) == F.col("plan_bucket")) & (at <= F.col("plan_last")),
        F.lit(False),
    )
    return (
        joined.withColumn("copies", F.col("plan_epochs") + drawn.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*[f"`{c}`" for c in own.columns], *OUT)
    )


def _keyed(
    own: DataFrame, quality: DataFrame | None, buckets: int
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with size, key, key range and source, and the names of these columns."""
    name = {k: free_name(own, f"mix_{k}") for k in ("key", "bucket", "nosrc", "src", "weight")}
    sized = own.withColumn("size", F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long"))
    if quality is None:
        sized = sized.withColumn(name["weight"], F.lit(1.0))
    else:
        known = quality.select(
            F.col("doc_id").alias("mix_doc"), F.col("quality_weight").alias("mix_weight")
        )
        sized = sized.join(known, sized["doc_id"] == known["mix_doc"], "left")
        sized = sized.withColumn(name["weight"], F.coalesce(known["mix_weight"], F.lit(1.0)))
    digits = F.substring(F.md5(text_or_empty("doc_id").cast("binary")), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    ranged = F.floor((1 - F.exp(-F.col(name["key"]))) * buckets).cast("int")
    return (
        sized.withColumn(name["key"], -F.log(uniform) / F.col(name["weight"]))
        .withColumn(name["bucket"], F.least(ranged, F.lit(buckets - 1)))
        .withColumn(name["nosrc"], F.col("source").isNull())
        .withColumn(name["src"], text_or_empty("source")),
        name,
    )


OUT = ("size", "source_size", "target", "copies", "taken")
