"""Runs of the pipeline that are broken off and go on."""

import glob
import os

import corpus_pipeline
import pytest


def test_a_run_goes_on_after_the_last_complete_stage(spark, sf_dir, tmp_path, monkeypatch):
    told, broken = [], [True]

    def stage(name, keep):
        def apply(spark, docs, sf_dir):
            told.append((name, docs.count()))
            if name == "c" and broken[0]:
                raise RuntimeError("lost")
            return docs.filter(keep)

        return name, apply

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("a", "doc_id < 50"), stage("b", "doc_id < 20"), stage("c", "doc_id < 10"), stage("d", "doc_id < 5")])
    folder = str(tmp_path / "run")
    with pytest.raises(RuntimeError, match="lost"):
        corpus_pipeline.run(spark, sf_dir, folder)
    assert [n for n, _ in told] == ["a", "b", "c"] and sorted(os.path.basename(x) for x in glob.glob(f"{folder}/[a-d]")) == ["b"]
    broken[0] = False
    os.makedirs(f"{folder}/c")  # what a lost driver left: no _SUCCESS
    open(f"{folder}/c/part-0.parquet", "w").close()
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir, folder).collect()} == set(range(5))
    assert told[3:] == [("c", 20), ("d", 10)] and sorted(os.path.basename(x) for x in glob.glob(f"{folder}/[a-d]")) == ["d"]
    assert corpus_pipeline.run(spark, sf_dir, folder).count() == 5 and len(told) == 5
    with pytest.raises(ValueError, match="other parameters"):
        corpus_pipeline.run(spark, sf_dir + "/", folder)


def test_a_failed_run_leaves_nothing(spark, sf_dir, monkeypatch):
    def fails(spark, docs, sf_dir):
        raise RuntimeError("lost")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", lambda spark, docs, sf_dir: docs), ("b", fails)])
    left = lambda: glob.glob(f"{corpus_pipeline.checkpoint_dir(spark).removeprefix('file:')}/pipeline-*")
    before = left()
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, sf_dir)
    assert left() == before
