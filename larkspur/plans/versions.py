"""An immutable, parented version store on plain Parquet, for several writers.

Layout below `root`: content/version_id=X/add=N/ is written once per batch of
frames, stats/<id>/ holds a version's counts, and log/ has one entry for every
draft, publish and abort. A version is what its last entry says. The entry goes
last, so a failed publish leaves an invisible folder.

Writers need not know of each other. A version that was built on a parent which
is no longer the newest is moved on top of the newest when it is published: its
frames stay as they are, only lineage and counts are derived again, so nothing is
lost and versions have one order. It is refused if the other writer published
runs that it holds too, or took its name.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.functions.text import basename
from larkspur.operators.frames import frame_meta, make_frames, version_stats
from larkspur.plans.commit_log import CommitLog, Conflict, put_if_absent
from larkspur.plans.shared import cut
from larkspur.sources.trees import list_labeled_tree


class PublishError(RuntimeError):
    """A publish that must not become visible."""


# ---- pure functions over a versions table ----------------------------------

def find_dataset(versions: DataFrame, name: str) -> DataFrame:
    """Exact-name lookup; creates nothing."""
    return versions.where(F.col("dataset") == name).select("dataset_id", "dataset").distinct()


def latest_published(versions: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """The newest published version per dataset by (created, name)."""
    row = F.max(F.struct("created", "name", "version_id")).alias("_v")
    return versions.where("published").groupBy(*keys).agg(row).select(
        *keys, "_v.version_id", "_v.name", "_v.created")


def next_version_name(versions: DataFrame, keys: Sequence[str] = ("dataset_id",),
                      prefix: str = "v") -> DataFrame:
    """The next free number after all names like v<N>..., drafts included."""
    n = F.nullif(F.regexp_extract("name", r"^v(\d+)", 1), F.lit("")).try_cast("bigint")
    out = versions.groupBy(*keys).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("_n"))
    return out.select(*keys, F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("next_name"))


def ancestry(versions: DataFrame) -> DataFrame:
    """(version_id, ancestor, depth) following parent_id, the version itself at 0.

    Each pass doubles the distance covered, so a chain of n versions takes
    log2(n) joins over the versions table and has no recursion limit.
    """
    known = versions.select(F.col("version_id").alias("via"))
    own = versions.select("version_id", F.col("version_id").alias("ancestor"),
                          F.lit(0).alias("depth"))
    jump = (versions.where(F.col("parent_id").isNotNull())
            .select("version_id", F.col("parent_id").alias("via"))
            .join(known, "via"))
    covered, jump, distance = cut(own), cut(jump.select("version_id", "via")), 1
    most = versions.count()
    while not jump.isEmpty():
        if distance > most:
            raise ValueError("the parents of some versions form a cycle")
        hop = covered.withColumnRenamed("version_id", "via")
        further = jump.join(hop, "via").select(
            "version_id", "ancestor", (F.col("depth") + distance).alias("depth"))
        covered = cut(covered.unionByName(further))
        onward = jump.select(F.col("version_id").alias("via"), F.col("via").alias("_next"))
        jump = cut(jump.join(onward, "via").select("version_id", F.col("_next").alias("via")))
        distance *= 2
    return covered


def with_lineage(versions: DataFrame) -> DataFrame:
    """Versions with `lineage` rebuilt from parents, for tables without it."""
    chains = ancestry(versions).groupBy("version_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "ancestor"))).alias("_c"))
    chains = chains.select("version_id", F.transform(
        "_c", lambda s: s["ancestor"]).alias("lineage"))
    return versions.drop("lineage").join(chains, "version_id", "left")


def effective_frames(frames: DataFrame, versions: DataFrame) -> DataFrame:
    """Every version's own and inherited frames; `seen_from` names the version.

    The stored lineage is exploded, so no recursion happens at read time.
    """
    seen = versions.select(F.col("version_id").alias("seen_from"),
                           F.explode("lineage").alias("version_id"))
    return frames.join(seen, "version_id")


def skip_published_runs(frames: DataFrame, parent_frames: DataFrame,
                        run_id: str = "run_id") -> DataFrame:
    """Rows of runs that the parent version does not hold yet."""
    have = parent_frames.select(run_id).distinct()
    return frames.join(have, run_id, "left_anti")


def label_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(label, change): labels added to or removed from a version."""
    b, a = before.select("label").distinct(), after.select("label").distinct()
    return (a.exceptAll(b).withColumn("change", F.lit("added"))
            .unionByName(b.exceptAll(a).withColumn("change", F.lit("removed"))))


# ---- the store --------------------------------------------------------------

_ENTRY = ("action string, version_id string, dataset_id string, dataset string, name string, parent_id string, "
          "comment string, created_us bigint, lineage array<string>, stats string")
#: rows of a version's counts that its own frames add; the others are the parent's
_STATS = ["dimension", "name", "count"]


class Draft:
    """A version that nobody reads yet. Frames may be added in several batches; it ends by `publish` or `abort`."""

    def __init__(self, store: VersionStore, row: dict, framed: bool):
        self.store, self.row, self.framed = store, row, framed
        self.version_id, self.rows, self._adds, self._open = row["version_id"], 0, 0, True

    def add(self, rows: DataFrame) -> int:
        """Write one batch; returns its number of rows, counted while they are written."""
        self._still_open()
        seen = Observation()
        target = f"{self.store.root}/content/version_id={self.version_id}/add={self._adds}"
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
        written = self.store.spark.read.parquet(target).count()  # from the files' footers
        if written != seen.get["rows"]:
            raise PublishError(f"{self.row['name']}: wrote another number of rows than were given")
        self._adds += 1
        self.rows += written
        return written

    def publish(self, name: Callable[[], str] | None = None) -> str:
        """Make it visible, on top of the dataset's newest version if it has a parent; returns its id."""
        self._still_open()
        own = self.store._own_stats(self.version_id, self.framed and self.rows > 0, self.rows)
        stats: dict[str | None, str] = {}

        def decide(_: int) -> dict:
            row = dict(self.row)
            if row["parent_id"] is not None:
                parent = self.store.latest(row["dataset"])
                if parent["version_id"] != row["parent_id"]:
                    self.store._refuse_common_runs(own, row["parent_id"], parent)
                    row["parent_id"] = parent["version_id"]
                row["lineage"] = [self.version_id, *parent["lineage"]]
            if name is not None:
                row["name"] = name()
            self.store._refuse_taken_name(row["dataset"], row["name"], self.version_id)
            if row["parent_id"] not in stats:
                stats[row["parent_id"]] = self.store._write_stats(own, row["parent_id"])
            return {**row, "action": "publish", "created_us": self.store._next_time(), "stats": stats[row["parent_id"]]}

        self.row = self.store.log.append(decide)
        self._open = False
        return self.version_id

    def abort(self) -> None:
        """Give it up: its name is free again and its files go."""
        self._still_open()
        self._open = False
        self.store.log.append(lambda _: {**self.row, "action": "abort", "created_us": self.store._next_time(), "stats": None})
        self.store._delete(f"{self.store.root}/content/version_id={self.version_id}")

    def _still_open(self) -> None:
        if not self._open:
            raise PublishError(f"{self.row['name']} has been published or aborted")


class VersionStore:
    """Reads and writes one store; every method with a write runs jobs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log", _ENTRY)
        self._mkdirs(f"{self.root}/models")

    # files
    def _path(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _mkdirs(self, path: str) -> None:
        fs, at = self._path(path)
        fs.mkdirs(at)

    def _delete(self, path: str) -> None:
        fs, at = self._path(path)
        fs.delete(at, True)

    # reading
    def _state(self) -> DataFrame:
        """The last entry of every version that was not aborted."""
        entries = self.log.entries()
        last = entries.groupBy("version_id").agg(
            F.max_by(F.struct(*[c for c in entries.columns if c != "version_id"]), "entry").alias("e"))
        return last.select("version_id", "e.*").where("action <> 'abort'")

    def versions(self) -> DataFrame:
        """Published versions and drafts, in the columns of schemas.VERSION."""
        return self._state().select(
            "version_id", "dataset_id", "dataset", "name", "parent_id", "comment",
            F.timestamp_micros("created_us").alias("created"), (F.col("action") == "publish").alias("published"), "lineage")

    def models(self) -> DataFrame:
        return self.spark.read.schema(schemas.MODEL).json(f"{self.root}/models")

    def latest(self, dataset: str):
        """The newest published version row of a dataset, or None."""
        rows = self.versions().where((F.col("dataset") == dataset) & F.col("published"))
        found = rows.orderBy(F.desc("created"), F.desc("name")).limit(1).collect()
        return found[0] if found else None

    def known(self, dataset: str) -> bool:
        """Whether the dataset has any version, draft or published: tells `latest` None for "nothing yet" from "never heard of"."""
        return not find_dataset(self.versions(), dataset).isEmpty()

    def named(self, dataset: str, name: str):
        found = self.versions().where(
            (F.col("dataset") == dataset) & (F.col("name") == name) & F.col("published")
        ).limit(1).collect()
        return found[0] if found else None

    def next_name(self, dataset: str, prefix: str = "v") -> str:
        rows = next_version_name(self.versions().where(F.col("dataset") == dataset), [], prefix)
        return rows.collect()[0]["next_name"]

    def own(self, version_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/content/version_id={version_id}").drop("add").withColumn(
            "version_id", F.lit(version_id))

    def effective(self, version) -> DataFrame:
        """Own and inherited rows: only the folders of the lineage are listed."""
        paths = [f"{self.root}/content/version_id={v}" for v in version["lineage"]]
        return self.spark.read.option("basePath", f"{self.root}/content").parquet(*paths).drop("add")

    def _all_stats(self, version_id: str) -> DataFrame:
        at = self._state().where(F.col("version_id") == version_id).select("stats").collect()
        return self.spark.read.schema("dimension string, name string, count bigint").parquet(f"{self.root}/stats/{at[0][0]}")

    def stats(self, version_id: str) -> DataFrame:
        """Counts of frames, labels and content types, inherited ones included."""
        return self._all_stats(version_id).where("dimension <> 'runs'").withColumn("version_id", F.lit(version_id))

    def runs(self, version_id: str) -> DataFrame:
        """(run_id): runs that the version holds, its ancestors' included; from its stats, no frame is read."""
        return self._all_stats(version_id).where("dimension = 'runs'").select(F.col("name").alias("run_id"))

    def label_counts(self, version_id: str) -> DataFrame:
        """(label, have) from the stats written at commit: no frame is read."""
        return self.stats(version_id).where(F.col("dimension") == "labels").select(
            F.col("name").alias("label"), F.col("count").alias("have"))

    # writing
    def _next_time(self) -> int:
        """Microseconds now, and later than any entry's: the order of `created` is that of the log."""
        last = self.log.entries().agg(F.max("created_us")).collect()[0][0] or 0
        return max(int(time.time() * 1e6), last + 1)

    def _refuse_taken_name(self, dataset: str, name: str, version_id: str) -> None:
        if not self.versions().where((F.col("dataset") == dataset) & (F.col("name") == name)
                                     & (F.col("version_id") != version_id)).isEmpty():
            raise PublishError(f"{dataset} already has a version named {name}")

    def _own_stats(self, version_id: str, framed: bool, rows: int) -> DataFrame:
        total = self.spark.range(1).select(F.lit("frames").alias("dimension"), F.lit("total").alias("name"),
                                           F.lit(rows).cast("bigint").alias("count"))
        if not framed:
            return total
        own = self.own(version_id)
        runs = own.where("run_id IS NOT NULL").groupBy(F.lit("runs").alias("dimension"), F.col("run_id").alias("name")).agg(
            F.count(F.lit(1)).alias("count"))
        return cut(version_stats(own).select(*_STATS).unionByName(runs))

    def _write_stats(self, own: DataFrame, parent_id: str | None) -> str:
        """The parent's counts plus the version's own, so a commit costs what it adds, not what the dataset holds."""
        every = own if parent_id is None else own.unionByName(self._all_stats(parent_id).select(*_STATS))
        name = uuid.uuid4().hex
        every.groupBy("dimension", "name").agg(F.sum("count").alias("count")).write.parquet(f"{self.root}/stats/{name}")
        return name

    def _refuse_common_runs(self, own: DataFrame, base_id: str, parent) -> None:
        """Raises if versions published since `base_id` hold a run of `own`."""
        runs = own.where("dimension = 'runs'").select(F.col("name").alias("run_id"))
        fresh = self.runs(parent["version_id"]).join(self.runs(base_id), "run_id", "left_anti")
        common = [r[0] for r in runs.join(fresh, "run_id").limit(3).collect()]
        if common:
            raise Conflict(f"another writer has published {', '.join(common)}")

    def draft(self, dataset: str, name: str, parent=None, comment: str = "", framed: bool = True) -> Draft:
        """Start a version: the name is taken from now on, and readers do not see it."""
        version_id = uuid.uuid4().hex
        row = {"version_id": version_id, "dataset_id": uuid.uuid5(uuid.NAMESPACE_URL, dataset).hex, "dataset": dataset,
               "name": name, "parent_id": parent["version_id"] if parent is not None else None, "comment": comment,
               "lineage": [version_id, *(parent["lineage"] if parent is not None else [])]}

        def decide(_: int) -> dict:
            self._refuse_taken_name(dataset, name, version_id)
            return {**row, "action": "draft", "created_us": self._next_time(), "stats": None}

        self.log.append(decide)
        return Draft(self, row, framed)

    def publish(self, dataset: str, name: str, rows: DataFrame, parent=None,
                comment: str = "", published: bool = True, framed: bool = True,
                skip_empty: bool = False) -> str | None:
        """Write a version and make it visible; returns its id.

        `rows` is evaluated once. With `skip_empty`, no rows means no version
        and None. Without `published` it stays a draft.
        """
        draft = self.draft(dataset, name, parent, comment, framed)
        try:
            if draft.add(rows) == 0 and skip_empty:
                draft.abort()
                return None
            return draft.publish() if published else draft.version_id
        except Exception:
            if draft._open:
                draft.abort()
            raise

    def register_model(self, name: str, version_id: str, training_rows: int,
                       synthetic_rows: int, threshold: float | None, accuracy: float | None,
                       tags: Sequence[str] = (), task_id: str | None = None) -> str:
        """Append a model row that carries its version and that version's counts."""
        model_id = uuid.uuid4().hex
        counts = self.label_counts(version_id).agg(F.map_from_entries(
            F.collect_list(F.struct("label", "have"))).alias("label_counts"))

        def lit(value, kind: str) -> Column:
            return F.lit(value).cast(kind)

        row = counts.select(
            F.lit(model_id).alias("model_id"), F.lit(name).alias("name"),
            F.array(*[F.lit(t) for t in tags]).cast("array<string>").alias("tags"),
            F.current_timestamp().alias("created"), lit(task_id, "string").alias("task_id"),
            F.lit(version_id).alias("version_id"), "label_counts",
            lit(training_rows, "bigint").alias("training_rows"),
            lit(synthetic_rows, "bigint").alias("synthetic_rows"),
            lit(threshold, "double").alias("threshold"), lit(accuracy, "double").alias("accuracy"))
        line = row.select(F.to_json(F.struct(*row.columns))).collect()[0][0]
        put_if_absent(self.spark, f"{self.root}/models/{model_id}.json", f"{line}\n".encode())
        return model_id

    def register_real(self, dataset: str, name: str, root: str) -> tuple[str, DataFrame]:
        """Publish a labelled file tree once; a second call, or a writer that comes second, gets what is there."""
        found = self.named(dataset, name)
        if found is None:
            tree = list_labeled_tree(self.spark, root)
            rows = tree.select(
                F.col("path").alias("uri"), F.array("label").alias("labels"),
                F.lit("real").alias("origin"), "texture", "defect", "kind",
                F.lit(True).alias("verified"), F.lit(None).cast("string").alias("run_id"))
            try:
                version_id = self.publish(dataset, name, make_frames(frame_meta(rows)))
            except PublishError:
                found = self.named(dataset, name)
                if found is None:
                    raise
        if found is not None:
            version_id = found["version_id"]
        return version_id, self.label_counts(version_id)

    def publish_run(self, dataset: str, rows: DataFrame, suffix: str,
                    extras: Sequence[str] = (), comment: str = "", attempts: int = 5) -> str | None:
        """Publish gated rows as the next version; None when nothing is new.

        rows: (uri, label, origin, texture, defect, kind, generator, verified,
        run_id, *extras). Runs the parent already holds are left out; when
        another writer publishes some of them meanwhile, that is done again.
        """
        for turn in range(attempts):
            parent = self.latest(dataset)
            if parent is None:
                raise PublishError("no published version to build on: register real data first")
            # the runs come from the parent's stats, a table of known size, so rows are not shuffled by run
            fresh = skip_published_runs(rows, self.runs(parent["version_id"]))
            framed = make_frames(frame_meta(
                fresh.withColumns({"labels": F.array("label"),
                                   "parent_version": F.lit(parent["version_id"])}), extras))
            draft = self.draft(dataset, f"draft-{uuid.uuid4().hex}", parent, comment)
            try:
                if draft.add(framed) == 0:
                    draft.abort()
                    return None
                return draft.publish(lambda: f"{self.next_name(dataset)}-{suffix}")
            except Exception as e:
                if draft._open:
                    draft.abort()
                if not isinstance(e, Conflict) or turn + 1 == attempts:
                    raise


def frame_rows(frames: DataFrame) -> DataFrame:
    """Stored frames as flat (version_id, uri, basename, label, origin, verified, run_id)."""
    uri = F.col("sources")[0]["uri"]
    return frames.select(
        "version_id", uri.alias("uri"), basename(uri).alias("basename"),
        F.get(F.get("rois", F.lit(0))["label"], F.lit(0)).alias("label"),
        F.col("meta.origin").alias("origin"), F.col("meta.verified").alias("verified"), "run_id")
