"""What is missing, how a budget is split over it, and what came back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions.text import readable_class
from larkspur.plans.shared import attach

# Sampling parameters of the search grid.
DRAW_GRID = [(4.0, 1.5), (10.0, 3.0)]
DEFAULT_CLASS = "solder_bridge"


def gap_report(counts: DataFrame, target: int | Column = schemas.TARGET_PER_CLASS,
               keys: Sequence[str] = (), catalog: DataFrame | None = None) -> DataFrame:
    """(keys, label, have, target, short, at_target) from (keys, label, have).

    A class with no rows at all has no count and therefore no gap, unless
    `catalog` (keys, label) lists it, in which case it appears with have = 0.
    """
    if catalog is not None:
        on = [*keys, "label"]
        counts = catalog.select(*on).distinct().join(counts, on, "full").withColumn(
            "have", F.coalesce("have", F.lit(0)))
    have, target = F.col("have").cast("bigint"), F.lit(target)
    return (counts.where(~F.col("label").isin(schemas.HOUSEKEEPING))
            .select(*keys, "label", have.alias("have"),
                    target.cast("bigint").alias("target"),
                    F.greatest(target - have, F.lit(0)).cast("bigint").alias("short"),
                    (have >= target).alias("at_target")))


def thinnest_class(gap: DataFrame, keys: Sequence[str] = (),
                   default: str = DEFAULT_CLASS) -> DataFrame:
    """The class with the largest shortfall; first by name on a tie."""
    short = gap.where(F.col("short") > 0)
    best = short.groupBy(*keys).agg(
        F.min(F.struct((-F.col("short")).alias("neg"), "label")).alias("_b"))
    groups = gap.select(*keys).distinct() if keys else None
    if keys:
        best = attach(groups, best, list(keys), "left")
    return best.select(
        *keys, F.coalesce("_b.label", F.lit(default)).alias("label"),
        F.coalesce(-F.col("_b.neg"), F.lit(0)).cast("bigint").alias("short"))


def allocate_budget(gap: DataFrame, types: DataFrame, budget: Column | int,
                    keys: Sequence[str] = ()) -> DataFrame:
    """(keys, defect_type, label, short, asked): largest-remainder split of a budget.

    gap: (keys, label, short); types: (keys, defect_type). A label shared by
    several types splits its shortfall between them. Every needy type gets one
    before the rest is split in proportion; a budget smaller than the number of
    needy types goes to the neediest. Windows run over class-level rows, one
    partition per dataset, so any number of datasets is split in parallel.
    """
    keys = list(keys)
    budget = F.lit(budget) if isinstance(budget, int) else budget
    per_label = Window.partitionBy(*keys, "label")
    listed = (types.select(*keys, "defect_type").distinct()
              .withColumn("label", F.substring_index("defect_type", "+", -1))
              .withColumn("_share", F.count(F.lit(1)).over(per_label)))
    needy = gap.where(F.col("short") > 0)
    weighted = (listed.join(needy, [*keys, "label"])
                .withColumn("_w", F.col("short") / F.col("_share").cast("double")))
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    ranked = weighted.withColumns({
        "_budget": budget.cast("bigint"),
        "_n": F.count(F.lit(1)).over(group),
        # The weights of one label add up to its shortfall, so the total is a
        # sum of whole numbers, independent of the order of addition.
        "_total": F.round(F.sum("_w").over(group)),
        "_rank": F.row_number().over(group.orderBy(F.desc("_w"), "defect_type"))})
    rest = F.col("_budget") - F.col("_n")
    exact = ranked.withColumn("_exact", F.when(
        rest > 0, rest * F.col("_w") / F.col("_total")).otherwise(F.lit(0.0)))
    floored = exact.withColumns({
        "_floor": F.floor("_exact"), "_frac": F.col("_exact") - F.floor("_exact")})
    placed = floored.withColumns({
        "_left": rest - F.sum("_floor").over(group),
        "_order": F.row_number().over(group.orderBy(F.desc("_frac"), "defect_type"))})
    asked = F.when(
        F.col("_budget") <= F.col("_n"),
        F.when(F.col("_rank") <= F.col("_budget"), 1).otherwise(0)
    ).otherwise(1 + F.col("_floor") + F.when(F.col("_order") <= F.col("_left"), 1).otherwise(0))
    return placed.select(*keys, "defect_type", "label", F.col("short").cast("bigint").alias("short"),
                         asked.cast("bigint").alias("asked"))


def asked_vs_got(allocation: DataFrame, manifest: DataFrame,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Per type: shortfall, asked, delivered manifest rows and whether it fell short."""
    on = [*keys, "defect_type"]
    got = manifest.groupBy(*on).agg(F.count(F.lit(1)).alias("got"))
    return (allocation.join(got, on, "left")
            .withColumn("got", F.coalesce("got", F.lit(0)).cast("bigint"))
            .withColumn("is_short", F.col("got") < F.col("asked"))
            .select(*on, "short", "asked", "got", "is_short"))


def before_after(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, label, before, after, delta) over the union of labels."""
    on = [*keys, "label"]
    b = before.select(*on, F.col("have").alias("before"))
    a = after.select(*on, F.col("have").alias("after"))
    zero = F.lit(0)
    return (b.join(a, on, "full").select(
        *on, F.coalesce("before", zero).cast("bigint").alias("before"),
        F.coalesce("after", zero).cast("bigint").alias("after"))
        .withColumn("delta", F.col("after") - F.col("before")))


def budget_map(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """`label:count,...` text -> rows; an unreadable count stays as a null `count`.

    A label given twice keeps its last count, as a dictionary would.
    """
    parts = F.filter(F.transform(F.split(column, ","), lambda p: F.trim(p)), lambda p: p != "")
    split = F.transform(parts, lambda p: F.struct(
        F.trim(F.substring_index(p, ":", 1)).alias("label"),
        F.trim(F.regexp_replace(p, "^[^:]*:?", "")).alias("text")))
    rows = df.select(*keys, F.posexplode(split).alias("pos", "e"))
    return (rows.groupBy(*keys, F.col("e.label").alias("label"))
            .agg(F.max_by("e.text", "pos").alias("text"))
            .select(*keys, "label", F.col("text").try_cast("bigint").alias("count"), "text"))


def work_orders(allocation: DataFrame, prompt: str, seed: int = 0,
                keys: Sequence[str] = (), chunk: int = 1000) -> DataFrame:
    """One row per requested item: class, ordinal, seed and prompt.

    Items come out of two explodes with a repartition between them, so that one
    class with most of the budget is still written by many tasks.
    """
    asked = allocation.where(F.col("asked") > 0)
    last = F.col("asked") - 1
    chunks = asked.withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(asked - 1) div {chunk}"))))
    spread = chunks.repartition(*keys, "defect_type", "_c")
    first = F.col("_c") * chunk
    rows = spread.withColumn(
        "ordinal", F.explode(F.sequence(first, F.least(first + (chunk - 1), last))))
    text = F.replace(F.lit(prompt), F.lit("{label}"), readable_class(F.col("label")))
    return rows.select(*keys, "defect_type", "label", "ordinal",
                       (F.col("ordinal") + seed).alias("seed"), text.alias("prompt"))


def draw_grid(samples: DataFrame, round_column: str,
              grid: Sequence[tuple[float, float]] = DRAW_GRID) -> DataFrame:
    """Add each round's (guidance, crop_ratio); the grid is cycled from round 1."""
    pairs = F.array(*[F.struct(F.lit(g).alias("guidance"), F.lit(c).alias("crop_ratio"))
                      for g, c in grid])
    draw = F.get(pairs, F.pmod(F.col(round_column) - 1, F.lit(len(grid))).cast("int"))
    return samples.withColumns({"guidance": draw["guidance"], "crop_ratio": draw["crop_ratio"]})


def hpo_grid(studies: DataFrame, space: dict[str, Sequence], max_trials: Column | int) -> DataFrame:
    """The first `max_trials` points of each study's parameter grid.

    A trial number is read as a mixed-radix number whose digits index the
    value lists, last parameter fastest; points past the cap never exist.
    """
    total = 1
    for values in space.values():
        total *= len(values)
    cap = F.lit(max_trials) if isinstance(max_trials, int) else max_trials
    n = F.least(cap.cast("int"), F.lit(total))
    trials = studies.where(n > 0).withColumn("trial", F.explode(F.sequence(F.lit(0), n - 1)))
    stride, columns = total, {}
    for name, values in space.items():
        stride //= len(values)
        digit = F.expr(f"(trial div {stride}) % {len(values)}").cast("int")
        columns[name] = F.get(F.array(*[F.lit(v) for v in values]), digit)
    return trials.withColumns(columns)
