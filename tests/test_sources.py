import json

import pytest

from comparing import rows
from larkspur.operators.search import attempt_wins
from larkspur.sources import configs, manifests, pairs, reports, trees


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_pairs_csv(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'instruction,response\na, b \n,x\n"  ",y\n"q, ""r""","two\nlines"\nonly,\n')
    assert rows(pairs.load_pairs_csv(spark, p)) == [
        ("", "y"), ("a", "b"), ('q, "r"', "two\nlines")]


def test_pairs_csv_rejects_other_headers(spark, tmp_path):
    p = put(tmp_path / "a.csv", "response,instruction\na,b\n")
    with pytest.raises(Exception, match="header"):
        pairs.load_pairs_csv(spark, p).collect()


def test_require_rows(spark, tmp_path):
    p = put(tmp_path / "a.csv", "instruction,response\n,\n")
    with pytest.raises(pairs.EmptyDataset):
        pairs.require_rows(pairs.load_pairs_csv(spark, p), "a.csv")


def test_pairs_jsonl_round_trip_and_strictness(spark, tmp_path):
    df = spark.createDataFrame([("d", "a", "b\nc"), ("e", "x", "y")],
                               "dataset string, instruction string, response string")
    pairs.write_pairs_jsonl(df, str(tmp_path / "out"))
    assert rows(pairs.read_pairs_jsonl(spark, str(tmp_path / "out" / "dataset=d"))) == [("a", "b\nc")]
    blank = put(tmp_path / "blank.jsonl", '{"instruction":"a","response":"b"}\n\n')
    assert rows(pairs.read_pairs_jsonl(spark, blank)) == [("a", "b")]
    for bad in ('{"instruction":"a"}\n', '{"instruction":"a","response":"b"}\nnot json\n'):
        p = put(tmp_path / f"bad{len(bad)}.jsonl", bad)
        with pytest.raises(Exception):
            pairs.read_pairs_jsonl(spark, p).collect()


def test_lenient_jsonl(spark, tmp_path):
    p = put(tmp_path / "l.jsonl", '{"seq":1}\n\nnope\n{"seq":2}\n')
    assert rows(pairs.read_jsonl_lenient(spark, p, "seq bigint").where("seq is not null")) == [(1,), (2,)]
    kept = pairs.read_jsonl_lenient(spark, p, "seq bigint", keep_rejects=True).cache()
    assert kept.where("_corrupt_record is not null").count() == 1


def tree(tmp_path):
    for rel in ("IC/anomaly_image/bridge/1.png", "IC/clean_image/2.jpg", "IC/mask/bridge/3.png",
                "IC/cad/4.png", "IC/anomaly_image/bridge/5.JPEG", "IC/anomaly_image/bridge/6.txt",
                "cap/mask/missing/7.png", "cap/anomaly_image/deep/er/8.png"):
        put(tmp_path / "tree" / rel, "x")
    return str(tmp_path / "tree")


def test_trees(spark, tmp_path):
    root = tree(tmp_path)
    got = trees.list_labeled_tree(spark, root)
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "kind", "texture", "defect", "label") == sorted([
        ("anomaly", "IC", "bridge", "bridge"), ("clean", "IC", None, "clean"),
        ("mask", "IC", "bridge", "mask"), ("mask", "cap", "missing", "mask"),
        ("anomaly", "cap", "er", "er")], key=repr)
    assert rows(trees.list_training_tree(spark, root), "label") == [("bridge",), ("bridge",), ("clean",)]
    assert rows(trees.mask_counts(got)) == sorted([
        ("IC", "bridge", 1), ("IC", None, 1), ("cap", "missing", 1), ("cap", None, 1),
        (None, None, 2)], key=repr)


def run_folders(tmp_path):
    head = "output_filename,image_filename,mask_filename,anomaly_type,guidance,num_steps,seed,PSNR,guardrail_pass\n"
    root = tmp_path / "runs"
    put(root / "r1" / "manifest.csv", head + "x/a.png,,,IC+b,7,30,1,20,1\nx/gone.png,,,IC+b,7,30,1,20,1\n")
    put(root / "r1" / "a.png", "x")
    put(root / "r2" / "manifest.csv", head + "x/a.png,,,IC+c,7,30,1,20,\n")
    put(root / "r2" / "b.png", "x")
    put(root / "r1" / "per_sample.csv", "path,anomaly_type,nn_score\na.png,IC+b,0.5\na.png,IC+b,0.7\nz.png,IC+b,nan\n")
    put(root / "r2" / "per_sample.csv", "path,anomaly_type,nn_score\na.png,IC+c,bad\nq.png,IC+c,0.1\n")
    return root


def test_manifest_runs_and_files(spark, tmp_path):
    root = run_folders(tmp_path)
    m = manifests.read_manifest(spark, f"{root}/*/manifest.csv")
    assert rows(m, "run_id", "output_filename", "guardrail_pass") == [
        ("r1", "x/a.png", "1"), ("r1", "x/gone.png", "1"), ("r2", "x/a.png", None)]
    files = trees.list_files(spark, str(root))
    assert rows(trees.existing(m, "output_filename", files), "run_id") == [("r1",)]
    assert rows(trees.runs(files), "run_id") == [("r1",), ("r2",)]
    assert trees.latest_run(files).count() == 1
    resolved = trees.resolve_paths(m.select("output_filename"), "output_filename", files)
    assert resolved.where("resolved_path like '%r1/a.png'").count() == 2


def test_manifest_without_guardrail_column_passes(spark, tmp_path):
    p = put(tmp_path / "r" / "manifest.csv", "output_filename,anomaly_type\na.png,IC+b\n")
    assert rows(manifests.read_manifest(spark, p), "guardrail_pass", "seed") == [("1", None)]


def test_scores(spark, tmp_path):
    root = run_folders(tmp_path)
    path = f"{root}/*/per_sample.csv"
    assert rows(manifests.read_scores(spark, path)) == [("r1", 0, 0.5), ("r1", 1, 0.7), ("r2", 1, 0.1)]
    assert rows(manifests.read_scores(spark, path, "base")) == [("r1", "a.png", 0.7), ("r2", "q.png", 0.1)]
    p = put(tmp_path / "k" / "per_sample.csv",
            "path,nn_score,sample_index,index\na,0.1,4,9\nb,0.2,,8\nc,0.3,,\nd,0.4,x,7\ne,0.9,4,\n")
    assert rows(manifests.read_scores(spark, p)) == [("k", 2, 0.3), ("k", 3, 0.4), ("k", 4, 0.9), ("k", 8, 0.2)]


def test_catalog_and_summary(spark, tmp_path):
    p = put(tmp_path / "spec.jsonl", '{"defect_type":"IC+b"}\nbroken\n{"x":1}\n{"defect_type":"A+c"}\n{"defect_type":"IC+b"}\n')
    assert [r[0] for r in manifests.read_catalog(spark, p).collect()] == ["IC+b", "A+c"]
    s = put(tmp_path / "s.csv", "best_round\nround_001\n\"\"\nround_001\n")
    wins = attempt_wins(manifests.read_search_summary(spark, s))
    assert rows(wins) == [("original", 1), ("round_001", 2)]


def test_config_instances(spark, tmp_path):
    doc = {"task_name": "t", "config_per_instance": [{"model": "", "name": "A"}, {"model": "", "name": "B"}]}
    p = put(tmp_path / "c.json", json.dumps(doc, indent=2))
    flat = configs.config_instances(configs.read_config(spark, p))
    assert rows(flat, "task_name", "position", "instance.name") == [("t", 0, "A"), ("t", 1, "B")]
    nested = configs.nest_instances(flat, ["task_name"]).collect()[0]
    assert [i["name"] for i in nested["config_per_instance"]] == ["A", "B"]


def test_reports(spark, tmp_path):
    t = spark.createDataFrame([("a", 1)], "label string, n int")
    reports.write_reports({"labels": t}, str(tmp_path / "rep"), "csv")
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "rep" / "labels"))) == [("a", "1")]


def test_files_with_different_headers(spark, tmp_path):
    put(tmp_path / "r1" / "m.csv", "output_filename,anomaly_type,guardrail_pass\na.png,IC+b,0\n")
    put(tmp_path / "r2" / "m.csv", "anomaly_type,seed,output_filename\nIC+c,7,b.png\n")
    got = rows(manifests.read_manifest(spark, str(tmp_path / "*" / "m.csv")), "run_id", "output_filename", "seed", "guardrail_pass")
    assert got == [("r1", "a.png", None, "0"), ("r2", "b.png", "7", "1")]
    put(tmp_path / "s1" / "p.csv", "path,nn_score\na,0.5\n")
    put(tmp_path / "s2" / "p.csv", "path,sample_index,nn_score\na,9,0.7\n")
    assert rows(manifests.read_scores(spark, str(tmp_path / "s*" / "p.csv"))) == [("s1", 0, 0.5), ("s2", 9, 0.7)]


def test_reading_scores_sorts_no_rows_of_cells(spark, tmp_path, monkeypatch):
    """A file is one task, so an aggregate that sorts rows with all their cells grows with the largest file."""
    put(tmp_path / "r1" / "p.csv", 'path,nn_score,sample_index\n"a\nb",0.5,1\nc,0.6,1\n')
    put(tmp_path / "r2" / "p.csv", "x,sample_index,nn_score\n-,9,0.7\n-,8,0.2\n-,9,0.1\n")
    plans = []

    def watched(rows_, facts, keys, how="inner", real=manifests.attach):
        plans.append(facts._jdf.queryExecution().executedPlan().toString())
        return real(rows_, facts, keys, how)

    monkeypatch.setattr(manifests, "attach", watched)
    found = manifests.read_scores(spark, str(tmp_path / "r*" / "p.csv"))
    assert not any("SortAggregate" in p for p in [*plans, found._jdf.queryExecution().executedPlan().toString()])
    assert rows(found) == [("r1", 1, 0.6), ("r2", 8, 0.2), ("r2", 9, 0.1)]
