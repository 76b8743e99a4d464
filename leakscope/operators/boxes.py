"""Forest scores as a range join against leaf boxes, in the JVM throughout.

Every leaf of an isolation tree is a box: for each feature an interval
[lo, hi), open where no cut lies. The boxes of a tree cover the space without
overlap, so a row lies in one box of each tree, and its mean path length is the
mean over its boxes.

A range join has no equality that Spark can hash, so one feature, that with the
most cuts, is put into buckets: a box enters every bucket that it touches, a
row the one that it lies in, and the join is an equi-join on the bucket with
the intervals as its remaining condition. The bucketed boxes are counted; up
to ``max_broadcast`` rows they are broadcast and the rows stay where they are,
beyond it both sides are shuffled by (bucket, tree group) with the rows copied
once a group, so that no bucket is a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leakscope.operators.forest import ForestModel, c_factor
from leakscope.operators.lineage import as_table

BUCKETS = 32
MAX_BROADCAST = 200_000  # bucketed boxes, of at most some 200 bytes each
GROUPS = 16


def leaf_boxes(model: ForestModel) -> DataFrame:
    """(tree, lo, hi, path): a row a leaf; lo and hi are arrays over the
    model's columns, null where a side is open."""
    nodes = as_table(model.nodes, "forest-nodes")
    open_side = F.array(*[F.lit(None).cast("double")] * len(model.cols))
    children = (nodes.where("feature >= 0").groupBy("tree").agg(F.collect_set("left").alias("l"), F.collect_set("right").alias("r"))
                .select(F.col("tree").alias("_t"), F.concat("l", "r").alias("_below")))
    at = (nodes.join(children, nodes["tree"] == F.col("_t"), "left")
          .where(F.col("_below").isNull() | ~F.array_contains("_below", F.col("node"))).drop("_t", "_below")
          .withColumn("lo", open_side).withColumn("hi", open_side))
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    leaves = None
    for _ in range(depth + 1):
        done = at.where("feature < 0").select("tree", "lo", "hi", "path")
        leaves = done if leaves is None else leaves.unionByName(done)
        inner, f, cut = at.where("feature >= 0"), F.col("feature"), F.col("threshold")
        lo = F.transform("lo", lambda v, i: F.when(i == f, F.greatest(v, cut)).otherwise(v))
        hi = F.transform("hi", lambda v, i: F.when(i == f, F.least(v, cut)).otherwise(v))
        below = inner.select(F.col("tree").alias("_t"), F.col("left").alias("_n"), "lo", hi.alias("hi")).unionByName(
            inner.select(F.col("tree").alias("_t"), F.col("right").alias("_n"), lo.alias("lo"), "hi"))
        at = as_table(nodes.join(below, (nodes["tree"] == F.col("_t")) & (nodes["node"] == F.col("_n"))).drop("_t", "_n"), "boxes")
    return as_table(leaves, "leaf-boxes")


def score_boxes(df: DataFrame, boxes: DataFrame, cols: list[str], psi: int, buckets: int = BUCKETS,
                max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``df`` with ``_raw`` = -2 ** (-mean path / c(psi)), one row for each of
    its rows (rows that are equal are told apart by number)."""
    k = len(cols)
    cuts = boxes.agg(*[F.approx_count_distinct(F.array("lo", "hi")[j][i]).alias(f"n{i}_{j}") for i in range(k) for j in (0, 1)],
                     *[F.min(F.least(F.col("lo")[i], F.col("hi")[i])).alias(f"min{i}") for i in range(k)],
                     *[F.max(F.greatest(F.col("lo")[i], F.col("hi")[i])).alias(f"max{i}") for i in range(k)]).first()
    b = max(range(k), key=lambda i: (cuts[f"n{i}_0"] + cuts[f"n{i}_1"], -i))
    least, most = cuts[f"min{b}"], cuts[f"max{b}"]

    def bucket(x):  # grows with x, so a box's buckets are those from its lower to its upper end
        if least is None or not most > least:
            return F.when(x.isNotNull(), F.lit(0))
        at = F.floor((x - F.lit(least)) / F.lit((most - least) / buckets)) + 1
        return F.when(x.isNotNull(), F.least(F.greatest(at, F.lit(0)), F.lit(buckets + 1)).cast("int"))
    spread = boxes.select("tree", "path", "lo", "hi", F.explode(F.sequence(
        F.coalesce(bucket(F.col("lo")[b]), F.lit(0)), F.coalesce(bucket(F.col("hi")[b]), F.lit(buckets + 1)))).alias("_bucket"))
    flat = [F.col(e)[i].alias(f"_{e}{i}") for i in range(k) for e in ("lo", "hi")]
    spread = as_table(spread.select(F.pmod("tree", F.lit(GROUPS)).alias("_group"), F.col("path").alias("_path"), "_bucket", *flat), "bucketed-boxes")
    rows = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_rb", bucket(F.col(cols[b])))
    inside = F.col("_rb") == F.col("_bucket")
    for i, c in enumerate(cols):
        inside = inside & (F.col(f"_lo{i}").isNull() | (F.col(c) >= F.col(f"_lo{i}"))) & (
            F.col(f"_hi{i}").isNull() | (F.col(c) < F.col(f"_hi{i}")))
    if spread.count() <= max_broadcast:
        met = rows.join(F.broadcast(spread), inside)
    else:
        copies = as_table(rows, "rows").withColumn("_rg", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
        met = copies.join(spread, inside & (F.col("_rg") == F.col("_group")))
    mean = F.sum("_path") / F.count("_path")
    # texts are keys beside the row's number, which tells rows apart: as values they would make Spark sort all rows
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    kept = [F.any_value(c).alias(c) for c in df.columns if c not in texts]
    return (met.groupBy("_row", *texts).agg(*kept, mean.alias("_mean")).select("_row", *df.columns, "_mean")
            .withColumn("_raw", -F.pow(F.lit(2.0), -F.col("_mean") / F.lit(float(c_factor(psi)) or 1.0))).drop("_row", "_mean"))
