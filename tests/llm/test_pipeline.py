"""The pipeline's stages one by one on a small fixture, and on the smallest tables."""

import os

import pytest

import corpus_pipeline

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    clean = [f"The quiet street number {k} had a baker, and the baker of house {k * 7} sold bread to people from {k * 3} towns."
             + " ".join(f"word{k}n{j}" for j in range(60)) for k in range(40)]
    junk = [("### %%% *** $$$ &&& " + f"click{k} ") * 20 for k in range(40)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate([*clean, *junk])]
    rows += [(200, clean[3], "en", "s", 1), (201, clean[4] + " tail", "en", "s", 1), (202, clean[5] + " a.b@c.org +1 (555) 010-9999", None, None, None),
             (203, "Own words stand here before " + ITEM + " and own words after it too.", "en", "s", 1), (204, None, "en", "s", 0), (205, "", "en", "s", 0)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 40), 0) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, "another item that nobody quotes anywhere at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


ITEM = "Which of the seven bridges did the mathematician cross first when leaving the island?"


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_classifier"](spark, docs, tables)
    ids = {r["doc_id"] for r in good.collect()}
    assert set(range(40)) | {200, 201, 202, 203} <= ids and not ids & set(range(40, 80)) and good.columns == docs.columns
    single = stages["ngram_join"](spark, good, tables)
    assert ids - {r["doc_id"] for r in single.collect()} == {200, 201, 202} and single.columns == docs.columns
    kept = stages["decontamination"](spark, docs, tables)
    assert docs.count() - kept.count() == 1 and kept.filter("doc_id = 203").count() == 0 and kept.columns == docs.columns
    masked = stages["pii"](spark, docs, tables)
    row = masked.filter("doc_id = 202").first()
    assert row["text"].endswith("<EMAIL> <PHONE>") and row["n_chars"] == len(row["text"]) and masked.columns == docs.columns
    assert stages["packing"](spark, masked, tables).select("doc_id").distinct().count() == docs.count()
    for stage in list(stages.values())[:-1]:
        assert stage(spark, docs.limit(0), tables).count() == 0


def test_run(spark, tables):
    pieces = corpus_pipeline.run(spark, tables)
    assert 35 <= pieces.select("doc_id").distinct().count() <= 43


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_run_on_given_tables(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_personal_data_travels_in_small_batches(spark, monkeypatch):
    """Both passes of the stage, over clusters and over texts to mask, run with bounded batches; the setting is put back."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    for module in (corpus_pipeline, corpus_pipeline.pii):
        def watched(df, keep=module.store):
            seen.append(int(spark.conf.get(key)))
            return keep(df)
        monkeypatch.setattr(module, "store", watched)
    rows = [(k, f"Write to user{k}@example.org or call +1 555 {k:07d} today.", "en", "web", 50) for k in range(40)] + [(40, None, "en", "web", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert len(seen) == 2 and max(seen) <= 1_000 and spark.conf.get(key) == before
    assert len(got) == 41 and got[40] is None and all("<EMAIL>" in got[k] and "<PHONE>" in got[k] for k in range(40))


def test_texts_to_pack_travel_in_small_batches(spark, monkeypatch):
    key, seen, keep = "spark.sql.execution.arrow.maxRecordsPerBatch", [], corpus_pipeline.store
    before = spark.conf.get(key)
    monkeypatch.setattr(corpus_pipeline, "store", lambda df: seen.append(int(spark.conf.get(key))) or keep(df))
    docs = spark.createDataFrame([(k, f"text {k}", "en", "web", 6) for k in range(5)], COLUMNS)
    assert corpus_pipeline.sequence_packing(spark, docs, "").select("doc_id").distinct().count() == 5
    assert seen and max(seen) <= 1_000 and spark.conf.get(key) == before
