"""J8 (re-aimed), J6: sequence classifier on trailing windows and the
dual-model decision.

The reference trains a recurrent network on one machine. Here the same input
(the 20 readings before a row, min-max scaled, label of the row itself) is
flattened to an 80-dimensional vector and a multilayer perceptron is trained
with MLlib (distributed gradient aggregation). Probability >= 0.5 flags the
row. The min-max scaler is fitted once and stored with the model (it is not
re-fitted on the scored data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, \
    MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.functions.severity import (combined_severity_expr, detection_source_expr,
                                          dual_message_expr)
from leakscope.functions.timeutil import ts_lit
from leakscope.operators.features import fit_minmax, minmax_scale, sequences
from leakscope.operators.lineage import as_table
from leakscope.operators.windowing import DEFAULT_BUCKET_SECONDS, TARGET_ROWS, bucket_counts, plan_buckets, with_bucket
from leakscope.schemas import DUAL_GOLD_COLUMNS, EVENT_ID, EVENT_TS, SEGMENT, SEQUENCE_FEATURES


@dataclass
class SequenceModel:
    mlp: MultilayerPerceptronClassificationModel
    scaler: dict
    cols: list
    n: int
    threshold: float = 0.5


def positional_split(df: DataFrame, frac: float = 0.8, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                     target_rows: int = TARGET_ROWS) -> DataFrame:
    """Adds ``split``: the first floor(frac * n) rows in (segment, time,
    event_id) order are 'train', the rest 'test'. Exact without a global
    window: bucket counts (small) locate the boundary bucket, and only that
    bucket is ranked."""
    x = with_bucket(df, SEGMENT, EVENT_TS, EVENT_ID, bucket_seconds, target_rows)
    return with_split(x, train_border(x, frac))


@dataclass
class Border:
    """The last train row: its segment, bucket, time and id (None where all
    rows are on one side), and the number of train rows."""
    train_rows: int
    segment: object = None
    bucket: list | None = None
    ts: object = None
    key: object = None


def train_border(x: DataFrame, frac: float, skip: int = 0) -> Border:
    """Where the first floor(frac * n) rows of ``x`` (with ``_b``) end. A
    segment's first ``skip`` rows do not count: the border is that of the
    rows after them."""
    skipped = F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(skip) - F.col("_off")))
    # two scalars and one row are read from it
    counts = as_table(bucket_counts(x.select(SEGMENT, "_b"), SEGMENT)
                      .select(SEGMENT, "_b", skipped.alias("_skipped"), (F.col("_n") - skipped).alias("_n")), "split-counts")
    # a running total over the (segments x buckets) count table only
    w = Window.orderBy(SEGMENT, "_b").rowsBetween(Window.unboundedPreceding, -1)
    cum = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    k = int(frac * total)
    boundary = cum.where((F.col("_before") < k) & (F.col("_before") + F.col("_n") >= k)).first()
    if boundary is None:
        return Border(k)
    # null segments come first in the order, but are never train
    no_segment = counts.where(F.col(SEGMENT).isNull()).agg(F.sum("_n")).first()[0] or 0
    at = F.array(*[F.lit(i) for i in boundary["_b"]]).cast("array<bigint>")
    edge = (x.where((F.col(SEGMENT) == F.lit(boundary[SEGMENT])) & (F.col("_b") == at)).select(EVENT_ID, EVENT_TS)
            .withColumn("_r", F.row_number().over(Window.orderBy(EVENT_TS, EVENT_ID)))
            .where(F.col("_r") == k - boundary["_before"] + boundary["_skipped"]).first())
    return Border(k - no_segment, boundary[SEGMENT], boundary["_b"], edge[EVENT_TS], edge[EVENT_ID])


def with_split(x: DataFrame, border: Border) -> DataFrame:
    """``x`` without ``_b``, with ``split``."""
    if border.bucket is None:
        return x.withColumn("split", F.lit("test" if border.train_rows == 0 else "train")).drop("_b")
    seg = F.lit(border.segment)
    b = F.array(*[F.lit(i) for i in border.bucket]).cast("array<bigint>")
    in_b = (F.col(SEGMENT) == seg) & (F.col("_b") == b)
    earlier = (F.col(SEGMENT) < seg) | ((F.col(SEGMENT) == seg) & (F.col("_b") < b))
    e_lit = ts_lit(x, EVENT_TS, border.ts)
    upto_edge = (F.col(EVENT_TS) < e_lit) | ((F.col(EVENT_TS) == e_lit) &
                                             (F.col(EVENT_ID) <= F.lit(border.key)))
    in_train = earlier | (in_b & upto_edge)
    return x.withColumn("split", F.when(in_train, "train").otherwise("test")).drop("_b")


def sequence_frame(df: DataFrame, scaler: dict, cols=SEQUENCE_FEATURES, n: int = 20,
                   label: str | None = "label", keep_all: bool = False, plan: list[DataFrame] | None = None) -> DataFrame:
    """Trailing sequences of min-max scaled readings with an MLlib ``features``
    vector (zeros where the history is short) and ``_full``."""
    cols = list(cols)
    sc = [f"__s_{c}" for c in cols]
    tmp = minmax_scale(df, scaler, cols, prefix="__s_")
    if keep_all:
        seq = sequences(tmp, sc, n, label=None, keep_all=True, plan=plan).drop(*sc)
    else:
        seq = sequences(tmp, sc, n, label=label, plan=plan)
    full = F.size("seq") == n
    vec = F.when(full, F.flatten("seq")).otherwise(F.array_repeat(F.lit(0.0), n * len(cols)))
    return seq.withColumn("features", array_to_vector(vec)).withColumn("_full", full)


def fit_sequence_model(df: DataFrame, label: str = "label", cols=SEQUENCE_FEATURES, n: int = 20,
                       hidden: int = 16, max_iter: int = 100, seed: int = 42,
                       threshold: float = 0.5,
                       max_fit_rows: int | None = None) -> tuple[SequenceModel, DataFrame]:
    """Fit the scaler, build sequences, split positionally 80/20, train the MLP
    on all train rows. Only a caller that sets ``max_fit_rows`` gets a fit on
    about so many of them; no query does.
    Returns (model, test rows with predictions)."""
    # read by the scaler and, for rows and halos, by the window plan
    df = as_table(df.select(*dict.fromkeys([EVENT_ID, SEGMENT, EVENT_TS, label, *cols])), "labelled")
    scaler = fit_minmax(df, list(cols))
    # the border needs keys only, so vectors are made for the rows that the fit or the test takes
    plan = plan_buckets(df, SEGMENT, EVENT_TS, EVENT_ID)
    border = train_border(with_bucket(df.select(SEGMENT, EVENT_TS, EVENT_ID), SEGMENT, EVENT_TS, EVENT_ID, plan=plan), 0.8, skip=n)

    def rows_of(split: str, segments: Column, keep: Column) -> DataFrame:
        """Sequences of one side; its segments' rows alone are windowed."""
        seq = sequence_frame(df.where(segments), scaler, cols, n, label, plan=plan)
        seq = with_split(with_bucket(seq, SEGMENT, EVENT_TS, EVENT_ID, plan=plan), border)
        return seq.where((F.col("split") == split) & keep).drop("seq")
    before, upto, taken = F.lit(False), F.lit(True), F.lit(True)
    if border.bucket is not None:
        before, upto = (F.coalesce(c, F.lit(False)) for c in (F.col(SEGMENT) < F.lit(border.segment), F.col(SEGMENT) <= F.lit(border.segment)))
    if max_fit_rows is not None and border.train_rows > max_fit_rows:  # the caller's bound; the rows of smallest hash, of both classes alike
        taken = F.pmod(F.xxhash64(EVENT_ID), F.lit(1 << 20)) < F.lit(int(max_fit_rows / border.train_rows * (1 << 20)))
    train = as_table(rows_of("train", upto, taken), "sequences")  # scanned by the fit
    mlp = MultilayerPerceptronClassifier(layers=[n * len(cols), hidden, 2], maxIter=max_iter,
                                         seed=seed, labelCol=label, featuresCol="features")
    model = SequenceModel(mlp.fit(train), scaler, list(cols), n, threshold)
    test = predict(rows_of("test", ~before, F.lit(True)), model)
    return model, test


def predict(seq: DataFrame, model: SequenceModel, out: str = "lstm_anomaly") -> DataFrame:
    """Probability of class 1 >= threshold -> 1; rows without a full history -> 0."""
    scored = model.mlp.transform(seq)
    p1 = vector_to_array("probability")[1]
    flag = F.when(F.col("_full") & (p1 >= F.lit(model.threshold)), 1).otherwise(0).cast("int")
    return scored.withColumn(out, flag).drop("rawPrediction", "probability", "prediction")


def dual_gold(scored: DataFrame, model: SequenceModel) -> DataFrame:
    """Forest flag and sequence flag as columns of one frame (no join):
    severity, detection source and message (H3-H5), dual Gold projection."""
    # the window plan reads its input for rows and for halos: score once, before it
    scored = as_table(scored, "scored")
    seq = sequence_frame(scored, model.scaler, model.cols, model.n, label=None, keep_all=True)
    flagged = predict(seq, model).withColumn(
        "if_anomaly", F.when(F.col("anomaly_prediction") == -1, 1).otherwise(0).cast("int"))
    out = (flagged.withColumnRenamed("anomaly_score", "if_score")
           .withColumn("severity", combined_severity_expr())
           .withColumn("detection_source", detection_source_expr())
           .withColumn("alert_message", dual_message_expr()))
    return out.select(*DUAL_GOLD_COLUMNS)
