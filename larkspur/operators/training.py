"""Training sets: what goes in, what is held out, how it is ordered and fitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.scoring import default_thresholds, gate_accept, manifest_scores
from larkspur.functions.text import defect_of
from larkspur.plans.order_stats import mark_hashed
from larkspur.plans.shared import attach, cut, scratch_path

HOLDOUT_SHARE = 0.3
ITEM = ["uri", "label", "origin", "run_id", "score"]


def collect_training_items(real: DataFrame, manifest: DataFrame, scores: DataFrame,
                           accepted_only: bool = True, threshold: float | None = None,
                           use_synthetic: bool = True) -> DataFrame:
    """(uri, label, origin, run_id, score): real rows plus accepted rows of all runs.

    Every run is gated at its own median in one grouped pass; a control set is
    built with `use_synthetic=False`.
    """
    base = real.select("uri", "label", "origin",
                       F.lit(None).cast("string").alias("run_id"),
                       F.lit(None).cast("double").alias("score"))
    if not use_synthetic:
        return base
    scored = manifest_scores(manifest, scores)
    if accepted_only:
        if threshold is None:
            scored = gate_accept(scored, ["run_id"], bars=default_thresholds(scores))
        else:
            scored = gate_accept(scored, threshold=F.lit(threshold))
        scored = scored.where("accepted")
    made = scored.select(
        F.col("output_filename").alias("uri"), defect_of(F.col("anomaly_type")).alias("label"),
        F.lit("synthetic").alias("origin"), "run_id", F.col("nn_score").alias("score"))
    return base.unionByName(made)


def training_set_parents(parts: dict[str, DataFrame]) -> DataFrame:
    """Union of named parts, each row with the dataset it came from."""
    tagged = [df.withColumn("parent_dataset", F.lit(name)) for name, df in parts.items()]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows


def stratified_split(items: DataFrame, share: float = HOLDOUT_SHARE, seed: int = 0,
                     uri: str = "uri", label: str = "label") -> DataFrame:
    """Add `split`: a fixed share of each class of *real* rows is the holdout.

    Order is md5(seed:uri), so the split survives repartitioning and does not
    move when synthetic rows join. A class of one real row stays in train.
    """
    real = items.where(F.col("origin") == "real").withColumn(
        "_uid", F.concat(F.lit(f"{seed}:"), F.col(uri)))
    n = real.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    quotas = n.select(label, F.when(F.col("n") >= 2, F.round(F.col("n") * share))
                      .otherwise(0).cast("bigint").alias("quota"))
    marked = mark_hashed(real, [label], quotas, "quota", "_uid", "_held").drop("_uid")
    split = F.when(F.col("_held"), "holdout").otherwise("train")
    rest = items.where(~F.coalesce(F.col("origin") == "real", F.lit(False)))
    return (marked.withColumn("split", split).drop("_held")
            .unionByName(rest.withColumn("split", F.lit("train"))))


def leakage_check(items: DataFrame, uri: str = "uri", content: str = "content_hash") -> DataFrame:
    """(kind, key, train_rows, holdout_rows) for keys present on both sides.

    An aggregate instead of a join: a key copied a billion times shrinks to
    one partial row per task.
    """
    both = F.array(F.struct(F.lit("uri").alias("kind"), F.col(uri).alias("key")),
                   F.struct(F.lit("content").alias("kind"), F.col(content).alias("key")))
    return (items.select("split", F.explode(both).alias("k"))
            .where(F.col("k.key").isNotNull())
            .groupBy("k.kind", "k.key").agg(
                F.count_if(F.col("split") == "train").alias("train_rows"),
                F.count_if(F.col("split") == "holdout").alias("holdout_rows"))
            .where((F.col("train_rows") > 0) & (F.col("holdout_rows") > 0)))


def class_weights(items: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight): 'balanced' weights, total / (classes x class size)."""
    n = items.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0))
    return n.select(label, "n", (F.sum("n").over(w) / (
        F.count(F.lit(1)).over(w) * F.col("n"))).alias("weight"))


def origin_mix(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, real_rows, synthetic_rows, total_rows)."""
    return items.groupBy(*keys).agg(
        F.count_if(F.col("origin") == "real").alias("real_rows"),
        F.count_if(F.col("origin") == "synthetic").alias("synthetic_rows"),
        F.count(F.lit(1)).alias("total_rows"))


def step_plan(sizes: DataFrame, epochs: Column | float, batch: Column | int,
              accumulate: Column | int, rows: str = "rows") -> DataFrame:
    """Add `steps`: optimizer steps for a dataset of `rows` rows."""
    def col(c):
        return c if isinstance(c, Column) else F.lit(c)

    per_epoch = F.ceil(F.col(rows) / (col(batch) * col(accumulate)))
    return sizes.withColumn("steps", F.ceil(per_epoch * col(epochs)).cast("bigint"))


def render_chat(turns: DataFrame, keys: Sequence[str], turn: str = "turn",
                message: str = "<|{role}|>\n{text}\n", generation_prompt: str = "") -> DataFrame:
    """(keys, text): the messages of one conversation as one string, in turn order.

    The row that comes out is the whole conversation, so its size is bounded by
    what a trainer can take, not by this aggregate.
    """
    parts = F.replace(F.replace(F.lit(message), F.lit("{role}"), F.col("m.role")),
                      F.lit("{text}"), F.col("m.text"))
    rows = turns.select(*keys, F.struct(F.col(turn).alias("turn"), "role", "text").alias("m"))
    rendered = rows.select(*keys, F.col("m.turn").alias("turn"), parts.alias("part"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "part")))
    text = F.array_join(F.transform(ordered, lambda s: s["part"]), "")
    return rendered.groupBy(*keys).agg(F.concat(text, F.lit(generation_prompt)).alias("text"))


def truncate_tokens(texts: DataFrame, max_tokens: int, text: str = "text") -> DataFrame:
    """Cut to the first `max_tokens` whitespace-separated tokens and say so; the kept text is left as it is.

    Approximates a model tokenizer; the unit is words.
    """
    n = F.regexp_count(F.col(text), F.lit(r"\S+"))
    head = F.regexp_extract(F.col(text), r"^\s*+(?:\S++\s++){%d}+\S++" % (max_tokens - 1), 0)
    return texts.withColumn("_n", n).withColumns({
        "n_tokens": F.col("_n").cast("bigint"),
        "truncated": F.col("_n") > max_tokens,
        text: F.when(F.col("_n") > max_tokens, head).otherwise(F.col(text)),
    }).drop("_n")


def repeat_examples(texts: DataFrame, times: int) -> DataFrame:
    return texts.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(times))))


def label_index(items: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_id): alphabetical, 0-based. Works on the distinct labels."""
    w = Window.partitionBy(F.lit(0)).orderBy(label)
    return items.select(label).distinct().select(
        label, (F.row_number().over(w) - 1).cast("bigint").alias("label_id"))


def shard_of(uri: Column, epoch: int, shards: int) -> Column:
    """A shard per (epoch, uri), the same wherever and whenever it runs."""
    h = F.md5(F.concat(F.lit(f"{epoch}:"), uri))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(shards))


def shuffle_shards(items: DataFrame, epoch: int, shards: int, uri: str = "uri") -> DataFrame:
    """A new random order per epoch, as `shards` ordered partitions.

    No global row number: the shard comes from a hash and each partition is
    sorted on its own.
    """
    order = F.md5(F.concat(F.lit(f"{epoch}:"), F.col(uri)))
    return (items.withColumns({"shard": shard_of(F.col(uri), epoch, shards), "_o": order})
            .repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "_o").drop("_o"))


def train_probe(items: DataFrame, vector: str = "vector", label: str = "label",
                max_iter: int = 2000, inverse_regularisation: float = 1.0,
                keep: Sequence[str] = (), clean: str = "clean") -> DataFrame:
    """(keep, label, pred, p_clean): holdout predictions of a balanced probe.

    items carry `split`. Spark minimises mean loss + regParam/2 |w|^2, so a
    penalty of C on summed loss is regParam = 1 / (C x rows).
    """
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.feature import IndexToString, StringIndexer
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = items.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    train = rows.where(F.col("split") == "train")
    weighted = attach(train, cut(class_weights(train, label).drop("n")), [label]).select(
        "_x", label, "weight")
    n = weighted.count()
    if n == 0:
        raise ValueError("no training rows")
    indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(weighted)
    names = indexer.labels
    fit = LogisticRegression(
        featuresCol="_x", labelCol="_y", weightCol="weight", maxIter=max_iter,
        regParam=1.0 / (inverse_regularisation * n), standardization=False)
    path = scratch_path(items.sparkSession, "probe")
    fit.fit(indexer.transform(weighted)).write().save(path)
    # read back, the model has no training summary, which would hold on to the session
    model = LogisticRegressionModel.load(path)
    if len(names) > 1 and model.numClasses != len(names):
        raise ValueError(f"fitted {model.numClasses} classes for {len(names)} labels")
    back = IndexToString(inputCol="prediction", outputCol="pred", labels=names)
    scored = back.transform(model.transform(rows.where(F.col("split") == "holdout")))
    p = (F.get(vector_to_array("probability"), F.lit(names.index(clean)))
         if clean in names else F.lit(None).cast("double"))
    return scored.select(*keep, label, "pred", p.alias("p_clean"))
