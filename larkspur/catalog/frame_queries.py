"""Frames, versions, sources and scores over `documents` and `labels`."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import schemas
from larkspur.catalog.base import (
    FRAMES, PAIRS, SCORED, frames, manifest, pairs, query, r6, scores, table, write_files)
from larkspur.functions.text import (
    basename, first_url, path_segment, run_id_of, truthy, version_of)
from larkspur.operators import checks, gap, scoring, training
from larkspur.operators import frames as ops
from larkspur.plans import versions as vs
from larkspur.plans.score_store import ScoreStore
from larkspur.plans.shared import scratch_path
from larkspur.sources import configs, manifests, trees
from larkspur.sources import pairs as pair_io

# ---- sources ----------------------------------------------------------------


@query("load_pairs_csv", f"WITH {PAIRS} SELECT trim(instruction, E' \\t\\n') AS instruction, "
       "trim(response, E' \\t\\n') AS response FROM pairs")
def _load_pairs_csv(spark, sf):
    path = scratch_path(spark, "pairs-csv")
    (pairs(spark, sf).select("instruction", "response").write.options(
        header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))
    return pair_io.load_pairs_csv(spark, path)


@query("write_pairs_jsonl", f"WITH {PAIRS} SELECT conv_id, instruction, response FROM pairs")
def _write_pairs_jsonl(spark, sf):
    path = scratch_path(spark, "pairs-jsonl")
    rows = pairs(spark, sf).withColumn("dataset", F.concat(F.lit("d"), F.col("conv_id") % 4))
    pair_io.write_pairs_jsonl(
        rows.select("dataset", "response", F.to_json(F.struct("conv_id", "instruction")).alias("instruction")), path)
    back = spark.read.schema("dataset string, instruction string, response string").json(path)
    got = F.from_json("instruction", "conv_id bigint, instruction string")
    return back.select(got["conv_id"].alias("conv_id"), got["instruction"].alias("instruction"), "response")


@query("read_pairs_jsonl", f"WITH {PAIRS} SELECT instruction, response FROM pairs")
def _read_pairs_jsonl(spark, sf):
    path = scratch_path(spark, "pairs-strict")
    pair_io.pairs_as_json(pairs(spark, sf)).write.text(path)
    return pair_io.read_pairs_jsonl(spark, path)


@query("read_jsonl_lenient", """
SELECT event_id AS seq, event_type AS iter FROM events WHERE event_type <> 'error'""")
def _read_jsonl_lenient(spark, sf):
    path = scratch_path(spark, "lenient")
    good = F.to_json(F.struct(F.col("event_id").alias("seq"), F.col("event_type").alias("iter")))
    table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", F.substring(good, 1, 9)).otherwise(good)).write.text(path)
    rows = pair_io.read_jsonl_lenient(spark, path, "seq bigint, iter string", keep_rejects=True)
    return rows.where(F.col("_corrupt_record").isNull()).select("seq", "iter")


TREE = """
files AS (
  SELECT doc_id, source || '/' || CASE lang WHEN 'en' THEN 'anomaly_image' WHEN 'fr' THEN 'clean_image'
      WHEN 'de' THEN 'mask' ELSE 'cad' END || CASE WHEN lang = 'fr' THEN '' ELSE '/' || lang || (n_chars % 3) END
      || '/' || doc_id || CASE n_chars % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.JPEG' ELSE '.txt' END AS rel,
    source, lang, n_chars FROM documents),
tree AS (
  SELECT '/tree/' || rel AS path, CASE lang WHEN 'en' THEN 'anomaly' WHEN 'fr' THEN 'clean' ELSE 'mask' END AS kind,
    source AS texture, CASE WHEN lang <> 'fr' THEN lang || (n_chars % 3) END AS defect,
    CASE WHEN lang = 'en' THEN lang || (n_chars % 3) WHEN lang = 'fr' THEN 'clean' ELSE 'mask' END AS label
  FROM files WHERE lang IN ('en', 'fr', 'de') AND n_chars % 4 IN (0, 1))"""


def tree_files(spark, sf):
    """A file listing whose paths come from the documents."""
    lang, n = F.col("lang"), F.col("n_chars")
    folder = (F.when(lang == "en", "anomaly_image").when(lang == "fr", "clean_image")
              .when(lang == "de", "mask").otherwise("cad"))
    sub = F.when(lang == "fr", "").otherwise(F.concat(F.lit("/"), lang, (n % 3).cast("string")))
    suffix = (F.when(n % 4 == 0, ".png").when(n % 4 == 1, ".jpg").when(n % 4 == 2, ".JPEG").otherwise(".txt"))
    rel = F.concat(F.col("source"), F.lit("/"), folder, sub, F.lit("/"), F.col("doc_id").cast("string"), suffix)
    return table(spark, sf, "documents").select(
        F.concat(F.lit("/tree/"), rel).alias("path"), n.alias("length"),
        F.timestamp_seconds(F.col("doc_id")).alias("modificationTime"), F.split(rel, "/").alias("parts"))


def tree_root(spark, sf):
    """The files of the listing, written to the shared folder by the executors; each holds its own name."""
    root = scratch_path(spark, "tree")
    files = tree_files(spark, sf).select(F.array_join("parts", "/").alias("rel"))
    return root, write_files(files, root)


def listed_tree(spark, sf):
    root, _ = tree_root(spark, sf)
    rows = trees.list_tree(spark, root)
    return rows.withColumn("path", F.concat(F.lit("/tree/"), F.array_join("parts", "/")))


@query("list_labeled_tree", f"WITH {TREE} SELECT path, kind, texture, defect, label FROM tree")
def _list_labeled_tree(spark, sf):
    return trees.labeled_tree(listed_tree(spark, sf)).select("path", "kind", "texture", "defect", "label")


@query("list_training_tree", f"""WITH {TREE}
SELECT '/tree/' || rel AS uri, CASE lang WHEN 'en' THEN lang || (n_chars % 3) ELSE 'clean' END AS label, 'real' AS origin
FROM files WHERE lang IN ('en', 'fr') AND n_chars % 4 <> 3""")
def _list_training_tree(spark, sf):
    return trees.training_tree(listed_tree(spark, sf))


@query("count_masks", f"""WITH {TREE}
SELECT texture, defect, count(*) AS masks FROM tree WHERE kind = 'mask' GROUP BY ROLLUP (texture, defect)""")
def _count_masks(spark, sf):
    return trees.mask_counts(trees.labeled_tree(listed_tree(spark, sf)))


@query("register_real", f"""WITH {TREE} SELECT label, count(*) AS have, 1 AS versions FROM tree GROUP BY label""")
def _register_real(spark, sf):
    """A labelled tree of files becomes the first version; registering it again finds that version."""
    root, _ = tree_root(spark, sf)
    store = vs.VersionStore(spark, scratch_path(spark, "real-store"))
    first, _ = store.register_real("documents", "v1-real", root)
    again, counts = store.register_real("documents", "v1-real", root)
    versions = store.versions().where(F.col("version_id").isin(first, again)).agg(F.count(F.lit(1)).cast("int"))
    return counts.select("label", "have", versions.scalar().alias("versions"))


@query("list_runs", "SELECT source AS run_id, max(doc_id) AS last_modified FROM documents GROUP BY 1")
def _list_runs(spark, sf):
    return trees.runs(tree_files(spark, sf)).withColumn(
        "last_modified", F.unix_seconds("last_modified"))


@query("latest_run", "SELECT arg_max(source, doc_id) AS run_id FROM documents")
def _latest_run(spark, sf):
    return trees.latest_run(tree_files(spark, sf))


@query("read_manifest", f"""WITH {SCORED}
SELECT run_id, uri AS output_filename, anomaly_type, CASE WHEN vno % 2 = 0 THEN guardrail_pass ELSE '1' END AS guardrail_pass
FROM scored WHERE doc_id IN (SELECT doc_id FROM labels)""")
def _read_manifest(spark, sf):
    """Manifests of runs, written with two different headers and read by each file's own; rows whose file is listed stay."""
    root = scratch_path(spark, "manifests")
    rows = manifest(spark, sf).select("run_id", "vno", "output_filename", "anomaly_type", "guardrail_pass")
    wide = [F.lit(None).cast("string").alias(f"x{i}") for i in range(70)]
    written = {"even": rows.where("vno % 2 = 0").select("run_id", *wide, "guardrail_pass", "anomaly_type", "output_filename"),
               "odd": rows.where("vno % 2 = 1").select("run_id", "output_filename", "anomaly_type")}
    for name, part in written.items():
        part.write.partitionBy("run_id").option("header", True).csv(f"{root}/{name}")
    back = manifests.read_manifest(spark, f"{root}/*/*").withColumn("run_id", F.replace("run_id", F.lit("run_id="), F.lit("")))
    listed = scores(spark, sf).select(F.array("run_id", "base").alias("parts"), F.col("base").alias("path"))
    return trees.existing(back, "output_filename", listed).select("run_id", "output_filename", "anomaly_type", "guardrail_pass")


@query("read_scores", """
SELECT event_type AS run_id, user_id AS key, arg_max(value, event_id) AS nn_score FROM events WHERE event_id % 7 <> 0 GROUP BY 1, 2""")
def _read_scores(spark, sf):
    """Score files, one a run, written with many columns before the score, unusable scores among them; the last of a key counts."""
    root = scratch_path(spark, "scores")
    value = F.when(F.col("event_id") % 7 == 0, "nan").otherwise(F.col("value").cast("string"))
    few = table(spark, sf, "events").select("event_type", "event_id", "user_id", "value").repartition("event_type")
    rows = few.sortWithinPartitions("event_type", "event_id").select(  # the wide rows are made once they are in order
        "event_type", *[F.lit("-").alias(f"x{i}") for i in range(66)],
        F.concat(F.lit("/out/"), "event_type", F.lit("/"), F.col("event_id").cast("string")).alias("path"),
        F.col("user_id").alias("sample_index"), value.alias("nn_score"))
    rows.write.partitionBy("event_type").option("header", True).csv(root)
    found = manifests.read_scores(spark, f"{root}/*")
    return found.withColumn("run_id", F.replace("run_id", F.lit("event_type="), F.lit("")))


@query("read_catalog", "SELECT DISTINCT source || '+' || lang AS defect_type FROM documents")
def _read_catalog(spark, sf):
    """Specifications as JSON lines, broken ones among them, back as distinct types."""
    root = scratch_path(spark, "catalog")
    spec = F.to_json(F.struct(F.col("anomaly_type").alias("defect_type"), "doc_id"))
    rows = frames(spark, sf).select(F.explode(F.array(spec, F.substring(spec, 1, 12), F.lit('{"other": 1}'))).alias("value"))
    rows.write.text(root)
    return manifests.read_catalog(spark, root).select("defect_type")


@query("config_instances", "SELECT conv_id, CAST(turn AS BIGINT) AS position, role, length(text) AS chars FROM conversations")
def _config_instances(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", F.col("turn").alias("position"),
        F.struct("turn", "role", F.char_length("text").alias("chars")).alias("instance"))
    nested = configs.nest_instances(rows, ["conv_id"])
    return configs.config_instances(nested).select(
        "conv_id", F.col("position").cast("bigint").alias("position"), "instance.role",
        F.col("instance.chars").cast("bigint").alias("chars"))


@query("resolve_paths", f"""WITH {FRAMES}, listed AS (
  SELECT base, min(uri) AS resolved_path FROM frames WHERE origin = 'real' GROUP BY base)
SELECT doc_id, resolved_path FROM frames LEFT JOIN listed USING (base)""")
def _resolve_paths(spark, sf):
    rows = frames(spark, sf)
    listed = rows.where(F.col("origin") == "real").select(F.col("uri").alias("path"))
    return trees.resolve_paths(rows.select("doc_id", "uri"), "uri", listed).select("doc_id", "resolved_path")


# ---- frames -----------------------------------------------------------------


def stored_frames(spark, sf):
    """Documents as nested frames with their version."""
    rows = frames(spark, sf).withColumns({
        "labels": F.array("label"), "texture": F.col("run_id"), "defect": F.col("label"),
        "kind": F.lit("anomaly"), "verified": F.col("origin") == "real"})
    framed = ops.make_frames(ops.frame_meta(rows, ["n_chars"]))
    return framed.withColumn("version_id", version_of(F.col("sources")[0]["uri"]))


@query("make_frames", f"""WITH {FRAMES}
SELECT substr(md5(uri), 1, 16) AS frame_id, uri, 'image/png' AS content_type, label, origin, run_id,
  CAST(n_chars AS VARCHAR) AS n_chars FROM frames""")
def _make_frames(spark, sf):
    f = stored_frames(spark, sf)
    return f.select(
        "frame_id", F.col("sources")[0]["uri"].alias("uri"),
        F.col("sources")[0]["content_type"].alias("content_type"),
        F.col("rois")[0]["label"][0].alias("label"), F.col("meta.origin").alias("origin"), "run_id",
        F.col("extra")["n_chars"].alias("n_chars"))


@query("frame_meta", f"""WITH {SCORED}
SELECT doc_id, origin, run_id AS texture, label AS defect, quality = 1 AS verified,
  (CASE WHEN nn_score IS NULL THEN 0 ELSE 1 END) + (CASE WHEN toxic IS NULL THEN 0 ELSE 1 END) AS extras,
  CAST(toxic AS VARCHAR) AS toxic FROM scored""")
def _frame_meta(spark, sf):
    rows = manifest(spark, sf).withColumns({
        "texture": F.col("run_id"), "defect": F.col("label"), "verified": F.col("quality") == 1,
        "nn_score": F.when(F.col("quality").isNotNull(), F.col("n_chars").cast("double"))})
    m = ops.frame_meta(rows, ["nn_score", "toxic"])
    return m.select("doc_id", "meta.origin", "meta.texture", "meta.defect", "meta.verified",
                    F.size("extra").alias("extras"), F.col("extra")["toxic"].alias("toxic"))


@query("split_defect_type", f"WITH {FRAMES} SELECT doc_id, run_id AS texture, label AS defect FROM frames")
def _split_defect_type(spark, sf):
    return ops.split_defect_type(frames(spark, sf)).select("doc_id", "texture", "defect")


@query("guardrail_filter", f"WITH {SCORED} SELECT doc_id, guardrail_pass FROM scored WHERE guardrail_pass IN ('1', 'True', 'true')")
def _guardrail_filter(spark, sf):
    return ops.guardrail_filter(manifest(spark, sf)).select("doc_id", "guardrail_pass")


@query("guardrail_counts", f"""WITH {SCORED}
SELECT run_id, count(*) FILTER (guardrail_pass <> '0') AS passed, count(*) FILTER (guardrail_pass = '0') AS skipped
FROM scored GROUP BY run_id""")
def _guardrail_counts(spark, sf):
    return ops.guardrail_counts(manifest(spark, sf), ["run_id"])


@query("run_id_from_uri", f"""WITH {FRAMES}
SELECT doc_id, run_id, version_id, label || '+' || doc_id || '.txt' AS file FROM frames""")
def _run_id_from_uri(spark, sf):
    uri = F.col("uri")
    return frames(spark, sf).select("doc_id", run_id_of(uri).alias("run_id"),
                                    version_of(uri).alias("version_id"), path_segment(uri, 1).alias("file"))


@query("basename", f"WITH {FRAMES} SELECT doc_id, base FROM frames")
def _basename(spark, sf):
    return frames(spark, sf).select("doc_id", basename(F.col("uri")).alias("base"))


@query("endpoint_from_json", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN url || '#' ELSE NULL END AS endpoint FROM pages""")
def _endpoint_from_json(spark, sf):
    p = table(spark, sf, "pages")
    shape = F.col("page_id") % 3
    named = F.to_json(F.struct(F.lit("http://other").alias("zzz"), F.lit("no url").alias("endpoint"), "url"))
    nested = F.to_json(F.struct(F.lit(1).alias("http://key/1"), F.struct(F.array(F.concat("url", F.lit("#"))).alias("links")).alias("info")))
    text = F.when(shape == 0, named).when(shape == 1, nested).otherwise(F.to_json(F.struct("page_id")))
    return p.select("page_id", first_url(text).alias("endpoint"))


@query("truthy_text", """
SELECT event_id, lower(CASE event_type WHEN 'click' THEN ' TRUE' WHEN 'view' THEN 'yes ' WHEN 'error' THEN 'off'
  WHEN 'signup' THEN '1' ELSE 'n' END) IN (' true', 'yes ', '1') AS enabled FROM events""")
def _truthy_text(spark, sf):
    e = F.col("event_type")
    text = (F.when(e == "click", " TRUE").when(e == "view", "yes ").when(e == "error", "off")
            .when(e == "signup", "1").otherwise("n"))
    return table(spark, sf, "events").select("event_id", truthy(text).alias("enabled"))


# ---- counts and gaps --------------------------------------------------------

LINEAGE = FRAMES + """,
lineage AS (
  SELECT a.version_id, b.version_id AS ancestor, b.vno AS bno, a.vno FROM
    (SELECT DISTINCT version_id, vno FROM frames) a JOIN (SELECT DISTINCT version_id, vno FROM frames) b ON b.vno <= a.vno)"""


def version_table(spark, sf):
    """One version per source; each builds on the one numbered before it."""
    rows = frames(spark, sf).groupBy("version_id", "vno").agg(F.count(F.lit(1)).alias("own_frames"))
    number = F.col("vno").cast("string")
    return rows.select(
        "version_id", F.lit("d1").alias("dataset_id"), F.lit("documents").alias("dataset"),
        F.concat(F.lit("v"), number, F.when(F.col("vno") < 10, "-real").otherwise("-made")).alias("name"),
        F.when(F.col("vno") > 0, F.concat(F.lit("v"), (F.col("vno") - 1).cast("string"))).alias("parent_id"),
        F.timestamp_seconds(F.col("vno") * 86400).alias("created"),
        (F.col("vno") < 19).alias("published"), "vno", "own_frames",
        F.transform(F.sequence("vno", F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")),
                    lambda n: F.concat(F.lit("v"), n.cast("string"))).alias("lineage"))


@query("version_stats", f"""WITH {FRAMES}
SELECT version_id, 'labels' AS dimension, label AS name, count(*) AS count FROM frames GROUP BY 1, 2, 3
UNION ALL SELECT version_id, 'frames', 'total', count(*) FROM frames GROUP BY 1
UNION ALL SELECT version_id, 'content_types', 'image/png', count(*) FROM frames GROUP BY 1""")
def _version_stats(spark, sf):
    return ops.version_stats(stored_frames(spark, sf))


@query("label_count_any", "SELECT count(*) AS frames FROM documents WHERE lang IN ('fr', 'de')")
def _label_count_any(spark, sf):
    return ops.label_count_any(stored_frames(spark, sf), ["fr", "de"])


GAP_SQL = f"""WITH {FRAMES}
SELECT version_id, label, count(*) AS have, CAST(10 AS BIGINT) AS target,
  CAST(greatest(10 - count(*), 0) AS BIGINT) AS short, count(*) >= 10 AS at_target
FROM frames GROUP BY version_id, label"""


@query("gap_report", GAP_SQL)
def gap_by_version(spark, sf):
    counts = ops.version_stats(stored_frames(spark, sf)).where(F.col("dimension") == "labels")
    counts = counts.select("version_id", F.col("name").alias("label"), F.col("count").alias("have"))
    return gap.gap_report(counts, 10, ["version_id"])


@query("gap_report_catalog", f"""WITH {FRAMES},
cat AS (SELECT DISTINCT f.version_id, c.label FROM frames f, (SELECT DISTINCT label FROM frames UNION SELECT 'none') c),
have AS (SELECT version_id, label, count(*) AS have FROM frames GROUP BY 1, 2)
SELECT version_id, label, coalesce(have, 0) AS have, CAST(10 AS BIGINT) AS target,
  CAST(greatest(10 - coalesce(have, 0), 0) AS BIGINT) AS short, coalesce(have, 0) >= 10 AS at_target
FROM cat LEFT JOIN have USING (version_id, label)""")
def _gap_report_catalog(spark, sf):
    f = frames(spark, sf)
    counts = f.groupBy("version_id", "label").agg(F.count(F.lit(1)).alias("have"))
    known = f.select("label").distinct().unionByName(spark.range(1).select(F.lit("none").alias("label")))
    listed = f.select("version_id").distinct().withColumn(
        "label", F.explode(known.agg(F.collect_list("label").alias("l")).scalar()))
    return gap.gap_report(counts, 10, ["version_id"], listed)


@query("thinnest_class", f"""WITH g AS ({GAP_SQL})
SELECT version_id, coalesce(min(label) FILTER (short = top AND short > 0), 'solder_bridge') AS label, max(short) AS short
FROM (SELECT *, max(short) OVER (PARTITION BY version_id) AS top FROM g) GROUP BY version_id""")
def _thinnest_class(spark, sf):
    return gap.thinnest_class(gap_by_version(spark, sf), ["version_id"])


@query("before_after", f"""WITH {LINEAGE},
cum AS (SELECT l.vno, f.label, count(*) AS have FROM lineage l JOIN frames f ON f.version_id = l.ancestor GROUP BY 1, 2)
SELECT coalesce(a.vno, b.vno + 1) AS vno, coalesce(a.label, b.label) AS label, coalesce(b.have, 0) AS before, coalesce(a.have, 0) AS after,
  coalesce(a.have, 0) - coalesce(b.have, 0) AS delta
FROM (SELECT * FROM cum WHERE vno > 0) a FULL JOIN (SELECT * FROM cum WHERE vno < (SELECT max(vno) FROM cum)) b
  ON a.vno = b.vno + 1 AND a.label = b.label""")
def _before_after(spark, sf):
    f = frames(spark, sf)
    v = version_table(spark, sf)
    own = f.groupBy("version_id", "label").agg(F.count(F.lit(1)).alias("n"))
    cum = (vs.effective_frames(own, v).groupBy(F.col("seen_from").alias("version_id"), "label")
           .agg(F.sum("n").alias("have"))
           .withColumn("vno", F.substring("version_id", 2, 10).cast("bigint")))
    last = cum.select(F.max("vno")).scalar()
    before = cum.where(F.col("vno") < last).withColumn("vno", F.col("vno") + 1)
    return gap.before_after(before, cum.where(F.col("vno") > 0), ["vno"])


@query("label_changes", f"""WITH {FRAMES},
a AS (SELECT DISTINCT anomaly_type AS label FROM frames WHERE vno >= 5),
b AS (SELECT DISTINCT anomaly_type AS label FROM frames WHERE vno < 15)
SELECT label, 'added' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT label, 'removed' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _label_changes(spark, sf):
    """What the later versions label against what the earlier ones do; all frames of either are read."""
    f = frames(spark, sf).select("vno", F.col("anomaly_type").alias("label"))
    return vs.label_changes(f.where("vno < 15"), f.where("vno >= 5"))


@query("origin_mix", f"""WITH {FRAMES}
SELECT label, count(*) FILTER (origin = 'real') AS real_rows, count(*) FILTER (origin = 'synthetic') AS synthetic_rows,
  count(*) AS total_rows FROM frames GROUP BY label""")
def _origin_mix(spark, sf):
    return training.origin_mix(frames(spark, sf), ["label"])


@query("expected_counts", f"""WITH {FRAMES},
e AS (SELECT label, count(*) AS n FROM frames WHERE origin = 'real' GROUP BY 1),
a AS (SELECT label, count(*) AS n FROM frames WHERE origin = 'synthetic' GROUP BY 1)
SELECT label, coalesce(e.n, 0) AS expected, coalesce(a.n, 0) AS actual, coalesce(e.n, 0) = coalesce(a.n, 0) AS matches
FROM e FULL JOIN a USING (label)""")
def _expected_counts(spark, sf):
    n = frames(spark, sf).groupBy("origin", "label").agg(F.count(F.lit(1)).alias("have"))
    return checks.expected_counts(n.where(F.col("origin") == "synthetic"), n.where(F.col("origin") == "real"))


@query("annotated_share", f"""WITH {SCORED}
SELECT run_id, count(*) AS frames, count(quality) AS annotated, round(100.0 * count(quality) / count(*), 6) AS percent
FROM scored GROUP BY run_id""")
def _annotated_share(spark, sf):
    rows = manifest(spark, sf).withColumn("rois", F.when(
        F.col("quality").isNotNull(), F.array("label")).otherwise(F.array().cast("array<string>")))
    return checks.annotated_share(rows, ["run_id"]).withColumn("percent", r6("percent"))


@query("growth_check", f"""WITH {LINEAGE},
s AS (SELECT l.vno, count(*) AS size FROM lineage l JOIN frames f ON f.version_id = l.ancestor GROUP BY 1)
SELECT vno, size, lag(size) OVER (ORDER BY vno) AS previous, size > lag(size) OVER (ORDER BY vno) AS grew FROM s""")
def _growth_check(spark, sf):
    v = version_table(spark, sf)
    own = v.select("version_id", "own_frames")
    sizes = vs.effective_frames(own, v.select("version_id", "lineage")).groupBy("seen_from").agg(
        F.sum("own_frames").alias("size"))
    sizes = sizes.select(F.substring("seen_from", 2, 10).cast("bigint").alias("vno"), "size")
    return checks.growth_check(sizes, "vno", "size")


@query("dup_frames", """SELECT md5(text) AS content, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1""")
def _dup_frames(spark, sf):
    rows = table(spark, sf, "documents").select(F.md5("text").alias("content"))
    return checks.dup_frames(rows, ["content"])


# ---- versions ---------------------------------------------------------------


@query("latest_published", f"""WITH {FRAMES}
SELECT 'd1' AS dataset_id, 'v' || max(vno) AS version_id, 'v' || max(vno) || CASE WHEN max(vno) < 10 THEN '-real' ELSE '-made' END AS name
FROM frames WHERE vno < 19""")
def _latest_published(spark, sf):
    return vs.latest_published(version_table(spark, sf)).drop("created")


@query("next_version_name", f"WITH {FRAMES} SELECT 'd1' AS dataset_id, 'v' || (max(vno) + 1) AS next_name FROM frames")
def _next_version_name(spark, sf):
    return vs.next_version_name(version_table(spark, sf))


@query("version_history", f"""WITH {FRAMES}
SELECT DISTINCT version_id, 'v' || vno || CASE WHEN vno < 10 THEN '-real' ELSE '-made' END AS name, vno * 86400 AS created
FROM frames WHERE vno < 19""")
def _version_history(spark, sf):
    from larkspur.operators.registry import version_history
    return version_history(version_table(spark, sf)).withColumn("created", F.unix_seconds("created"))


@query("ancestry", f"WITH {LINEAGE} SELECT version_id, ancestor, CAST(vno - bno AS INTEGER) AS depth FROM lineage")
def _ancestry(spark, sf):
    return vs.ancestry(version_table(spark, sf))


@query("effective_frames", f"""WITH {LINEAGE}
SELECT l.version_id AS seen_from, f.label, count(*) AS frames FROM lineage l JOIN frames f ON f.version_id = l.ancestor GROUP BY 1, 2""")
def _effective_frames(spark, sf):
    v = version_table(spark, sf)
    own = frames(spark, sf).groupBy("version_id", "label").agg(F.count(F.lit(1)).alias("n"))
    return vs.effective_frames(own, v).groupBy("seen_from", "label").agg(F.sum("n").alias("frames"))


@query("skip_published_run", f"""WITH {FRAMES}
SELECT doc_id, run_id FROM frames WHERE run_id NOT IN (SELECT run_id FROM frames WHERE origin = 'real')""")
def _skip_published_run(spark, sf):
    f = frames(spark, sf)
    parent = f.where(F.col("origin") == "real").select(run_id_of(F.col("uri")).alias("run_id"))
    return vs.skip_published_runs(f, parent).select("doc_id", "run_id")


@query("find_dataset", """SELECT DISTINCT md5(lang) AS dataset_id, lang AS dataset FROM documents WHERE lang = 'fr'""")
def _find_dataset(spark, sf):
    """Every language is a dataset, every document a version of it; one is looked up by name."""
    versions = table(spark, sf, "documents").select(
        F.md5(F.col("lang").cast("binary")).alias("dataset_id"), F.col("lang").alias("dataset"))
    return vs.find_dataset(versions, "fr")


@query("lineage", f"""WITH {LINEAGE},
models AS (SELECT 'm' || o_orderkey AS model_id, 'v' || (o_orderkey % 20) AS version_id FROM orders),
n AS (SELECT l.version_id, f.origin, f.run_id, f.label, count(*) AS frames
  FROM lineage l JOIN frames f ON f.version_id = l.ancestor GROUP BY 1, 2, 3, 4)
SELECT version_id, origin, label, count(DISTINCT model_id) AS models, CAST(sum(frames) AS BIGINT) AS frames
FROM models JOIN n USING (version_id) GROUP BY 1, 2, 3""")
def _lineage(spark, sf):
    from larkspur.operators.registry import version_lineage
    models = table(spark, sf, "orders").select(
        F.concat(F.lit("m"), "o_orderkey").alias("model_id"),
        F.concat(F.lit("v"), F.col("o_orderkey") % 20).alias("version_id"))
    held = version_lineage(version_table(spark, sf), frames(spark, sf)).groupBy("version_id", "origin", "label").agg(
        F.sum("frames").alias("frames"))
    trained = models.groupBy("version_id").agg(F.count_distinct("model_id").alias("models"), F.count(F.lit(1)).alias("n"))
    return held.join(trained, "version_id").select(
        "version_id", "origin", "label", "models", (F.col("frames") * F.col("n")).alias("frames"))


# ---- scores and gates -------------------------------------------------------


def run_gated(spark, sf):
    found = scores(spark, sf).drop("doc_id")
    scored = scoring.manifest_scores(manifest(spark, sf), found)
    return scoring.gate_accept(scored, ["run_id"], bars=scoring.default_thresholds(found))


@query("manifest_scores", f"WITH {SCORED} SELECT doc_id, run_id, nn_score FROM scored")
def _manifest_scores(spark, sf):
    return scoring.manifest_scores(manifest(spark, sf), scores(spark, sf).drop("doc_id")).select(
        "doc_id", "run_id", "nn_score")


@query("default_threshold", f"WITH {SCORED} SELECT run_id, (SELECT count(*) FROM scored s WHERE s.run_id = b.run_id AND nn_score IS NOT NULL) AS n, threshold FROM bars b")
def _default_threshold(spark, sf):
    return scoring.default_thresholds(scores(spark, sf))


def score_store(spark, sf):
    """Scores of all runs, added in two commits; the second offers the runs of the first again."""
    f = frames(spark, sf).select("base", "run_id", "vno", F.col("label").alias("anomaly_type"))
    rows = f.join(scores(spark, sf).select("run_id", "base", "nn_score"), ["run_id", "base"])
    store = ScoreStore(spark, scratch_path(spark, "scores"), ["anomaly_type"])
    store.add_runs(rows.where("vno < 12"))
    store.add_runs(rows)
    return store


@query("default_threshold_store", f"WITH {SCORED} SELECT run_id, (SELECT count(*) FROM scored s WHERE s.run_id = b.run_id AND nn_score IS NOT NULL) AS n, threshold FROM bars b")
def _default_threshold_store(spark, sf):
    return score_store(spark, sf).default_thresholds()


@query("batch_threshold_store", f"WITH {SCORED} SELECT count(*) AS n, median(nn_score) AS threshold FROM scored WHERE nn_score IS NOT NULL")
def _batch_threshold_store(spark, sf):
    return score_store(spark, sf).default_thresholds([])


@query("score_distribution_store", f"""WITH {SCORED}
SELECT label AS anomaly_type, count(*) AS n, min(nn_score) AS min_score, median(nn_score) AS median_score, max(nn_score) AS max_score
FROM scored WHERE nn_score IS NOT NULL GROUP BY label""")
def _score_distribution_store(spark, sf):
    return score_store(spark, sf).distribution(["anomaly_type"])


@query("mean_threshold", f"WITH {SCORED} SELECT round(avg(threshold), 6) AS mean_threshold FROM bars")
def _mean_threshold(spark, sf):
    return scoring.mean_threshold(scoring.default_thresholds(scores(spark, sf))).select(
        r6("mean_threshold").alias("mean_threshold"))


@query("gate_accept", f"WITH {SCORED} SELECT doc_id, nn_score, threshold, accepted, verdict FROM gated")
def _gate_accept(spark, sf):
    return run_gated(spark, sf).select("doc_id", "nn_score", "threshold", "accepted", "verdict")


@query("gate_accept_batch", f"""WITH {SCORED}, m AS (SELECT median(nn_score) AS threshold FROM scored WHERE nn_score IS NOT NULL)
SELECT doc_id, threshold, coalesce(nn_score >= threshold, false) AS accepted FROM scored, m""")
def _gate_accept_batch(spark, sf):
    rows = scoring.manifest_scores(manifest(spark, sf), scores(spark, sf).drop("doc_id"))
    return scoring.gate_accept(rows).select("doc_id", "threshold", "accepted")


@query("earn_label", f"""WITH {SCORED}
SELECT doc_id, accepted AS verified, CASE WHEN accepted THEN label ELSE 'pending-review' END AS label
FROM gated WHERE guardrail_pass <> '0'""")
def _earn_label(spark, sf):
    rows = ops.split_defect_type(ops.guardrail_filter(run_gated(spark, sf)))
    return ops.earn_label(rows, F.col("accepted")).select("doc_id", "verified", "label")


@query("score_distribution", f"""WITH {SCORED}
SELECT label AS anomaly_type, count(*) AS n, min(nn_score) AS min_score, median(nn_score) AS median_score, max(nn_score) AS max_score
FROM scored WHERE nn_score IS NOT NULL GROUP BY label""")
def _score_distribution(spark, sf):
    f = frames(spark, sf).select("base", "run_id", F.col("label").alias("anomaly_type"))
    return scoring.score_distribution(f.join(scores(spark, sf), ["run_id", "base"]))


@query("acceptance_by_class", f"""WITH {SCORED}
SELECT label, count(*) FILTER (accepted) AS accepted, count(*) AS total FROM gated
WHERE verdict IS NOT NULL GROUP BY ROLLUP (label)""")
def _acceptance_by_class(spark, sf):
    return scoring.acceptance_by_class(run_gated(spark, sf), "label")


@query("publish_counters", f"""WITH {SCORED}
SELECT run_id, count(*) FILTER (ok) AS published, count(*) FILTER (ok AND accepted) AS verified,
  count(*) FILTER (NOT ok) AS skipped, count(*) FILTER (ok AND NOT accepted) AS pending_review
FROM (SELECT *, guardrail_pass <> '0' AS ok FROM gated) GROUP BY run_id""")
def _publish_counters(spark, sf):
    from larkspur.functions.text import guardrail_ok
    return scoring.publish_counters(run_gated(spark, sf), guardrail_ok(F.col("guardrail_pass")), ["run_id"])


@query("gate_panels", f"""WITH {SCORED}
SELECT * FROM (SELECT doc_id, verdict, nn_score FROM gated WHERE verdict = 'accept' ORDER BY nn_score DESC, doc_id LIMIT 12)
UNION ALL
SELECT * FROM (SELECT doc_id, verdict, nn_score FROM gated WHERE verdict = 'reject' ORDER BY nn_score, doc_id LIMIT 12)""")
def _gate_panels(spark, sf):
    return scoring.gate_panels(run_gated(spark, sf).select("doc_id", "verdict", "nn_score"), "doc_id")


@query("score_table_sorted", f"""WITH {SCORED}
SELECT base AS image, anomaly_type, round(nn_score, 4) AS nn_score, verdict FROM gated WHERE verdict IS NOT NULL""")
def _score_table_sorted(spark, sf):
    return scoring.score_table(run_gated(spark, sf), "output_filename")


# ---- training sets ----------------------------------------------------------


def items(spark, sf):
    """Real documents plus the accepted ones of every run."""
    real = frames(spark, sf).where(F.col("origin") == "real")
    made = manifest(spark, sf).where(F.col("origin") == "synthetic")
    return training.collect_training_items(real, made, scores(spark, sf).drop("doc_id"))


@query("collect_training_items", f"""WITH {SCORED}
SELECT uri, label, origin, CAST(NULL AS VARCHAR) AS run_id, CAST(NULL AS DOUBLE) AS score FROM frames WHERE origin = 'real'
UNION ALL SELECT uri, label, origin, run_id, nn_score FROM gated WHERE origin = 'synthetic' AND accepted""")
def _collect_training_items(spark, sf):
    return items(spark, sf)


@query("training_set_parents", f"""WITH {SCORED}
SELECT uri, label, 'real' AS parent_dataset FROM frames WHERE origin = 'real'
UNION ALL SELECT uri, label, 'synthetic' FROM gated WHERE origin = 'synthetic' AND accepted
UNION ALL SELECT uri, label, 'mined' FROM scored WHERE quality = 1 AND origin = 'synthetic'""")
def _training_set_parents(spark, sf):
    rows = items(spark, sf)
    mined = manifest(spark, sf).where((F.col("quality") == 1) & (F.col("origin") == "synthetic"))
    return training.training_set_parents({
        "real": rows.where(F.col("origin") == "real").select("uri", "label"),
        "synthetic": rows.where(F.col("origin") == "synthetic").select("uri", "label"),
        "mined": mined.select(F.col("output_filename").alias("uri"), "label")})


SPLIT = FRAMES + """,
held AS (
  SELECT uri, CASE WHEN n >= 2 AND rn <= round(n * 0.3) THEN 'holdout' ELSE 'train' END AS split FROM (
    SELECT uri, count(*) OVER (PARTITION BY label) AS n,
      row_number() OVER (PARTITION BY label ORDER BY md5('0:' || uri), uri) AS rn FROM frames WHERE origin = 'real')),
split AS (SELECT f.*, coalesce(h.split, 'train') AS split FROM frames f LEFT JOIN held h USING (uri))"""


@query("stratified_split", f"WITH {SPLIT} SELECT doc_id, label, origin, split FROM split")
def _stratified_split(spark, sf):
    return training.stratified_split(frames(spark, sf)).select("doc_id", "label", "origin", "split")


@query("leakage_check", f"""WITH {SPLIT},
k AS (SELECT split, md5(text) AS key FROM split JOIN documents USING (doc_id))
SELECT 'content' AS kind, key, count(*) FILTER (split = 'train') AS train_rows,
  count(*) FILTER (split = 'holdout') AS holdout_rows FROM k GROUP BY key
HAVING count(*) FILTER (split = 'train') > 0 AND count(*) FILTER (split = 'holdout') > 0""")
def _leakage_check(spark, sf):
    f = frames(spark, sf, F.md5("text").alias("content_hash"))
    return training.leakage_check(training.stratified_split(f))


@query("shuffle_shards", f"""WITH {FRAMES}
SELECT uri, CAST(('0x' || substr(md5('1:' || uri), 1, 8))::BIGINT % 16 AS BIGINT) AS shard FROM frames""")
def _shuffle_shards(spark, sf):
    return training.shuffle_shards(frames(spark, sf).select("uri"), 1, 16)


@query("label_index", f"WITH {FRAMES} SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT label FROM frames)")
def _label_index(spark, sf):
    return training.label_index(frames(spark, sf))


@query("class_weights", f"""WITH {FRAMES}, n AS (SELECT label, count(*) AS n FROM frames GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM n) / ((SELECT count(*) FROM n) * n), 6) AS weight FROM n""")
def _class_weights(spark, sf):
    return training.class_weights(frames(spark, sf)).withColumn("weight", r6("weight"))


@query("publish_version", f"""WITH {SCORED},
pub AS (SELECT 'real' AS part, label FROM scored WHERE origin = 'real'
  UNION ALL SELECT 'made', CASE WHEN accepted THEN label ELSE 'pending-review' END FROM gated
  WHERE origin = 'synthetic' AND guardrail_pass <> '0')
SELECT 'v1-real' AS version, label, count(*) AS have FROM pub WHERE part = 'real' GROUP BY 2
UNION ALL SELECT 'v2-made', label, count(*) FROM pub GROUP BY 2""")
def _publish_version(spark, sf):
    store = vs.VersionStore(spark, scratch_path(spark, "store"))
    real = frames(spark, sf).where(F.col("origin") == "real").withColumn("labels", F.array("label"))
    first = store.publish("documents", "v1-real", ops.make_frames(ops.frame_meta(real)))
    gated = ops.split_defect_type(ops.guardrail_filter(
        run_gated(spark, sf).where(F.col("origin") == "synthetic")))
    rows = ops.earn_label(gated, F.col("accepted")).select(
        F.col("output_filename").alias("uri"), "label", "origin", "texture", "defect",
        F.lit("anomaly").alias("kind"), "verified", "run_id", "nn_score")
    second = store.publish_run("documents", rows, "made", ["nn_score"])
    store.publish_run("documents", rows, "again")  # the same runs again add nothing
    names = store.versions().select("version_id", F.col("name").alias("version"))
    counts = store.stats(first).unionByName(store.stats(second)).where(F.col("dimension") == "labels")
    return counts.join(names, "version_id").select(
        "version", F.col("name").alias("label"), F.col("count").alias("have"))


@query("version_pairs_dataset", f"WITH {PAIRS} SELECT 'v' || g AS version, count(*) * g AS rows FROM pairs, (SELECT unnest([1, 2]) AS g) GROUP BY g")
def _version_pairs_dataset(spark, sf):
    store = vs.VersionStore(spark, scratch_path(spark, "pair-store"))
    rows = pairs(spark, sf).select("instruction", "response")
    first = store.publish("pairs", store.next_name("pairs"), rows, framed=False)
    second = store.publish("pairs", store.next_name("pairs"), rows, store.latest("pairs"), framed=False)
    names = store.versions().select("version_id", F.col("name").alias("version"))
    counts = store.stats(first).unionByName(store.stats(second))
    return counts.join(names, "version_id").select("version", F.col("count").alias("rows"))


@query("register_model_row", f"""WITH {FRAMES}
SELECT 'probe' AS name, 'v1-real' AS version, label, count(*) AS have, (SELECT count(*) FROM frames) AS training_rows
FROM frames GROUP BY label""")
def _register_model_row(spark, sf):
    store = vs.VersionStore(spark, scratch_path(spark, "model-store"))
    rows = frames(spark, sf).withColumn("labels", F.array("label"))
    version = store.publish("documents", "v1-real", ops.make_frames(ops.frame_meta(rows)))
    total = store.stats(version).where(F.col("dimension") == "frames").collect()[0]["count"]
    store.register_model("probe", version, total, 0, None, None, ["probe"])
    named = store.versions().select("version_id", F.col("name").alias("version"))
    return store.models().join(named, "version_id").select(
        "name", "version", F.explode("label_counts").alias("label", "have"), "training_rows")


assert schemas.PENDING in schemas.HOUSEKEEPING
