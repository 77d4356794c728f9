"""The corpus pipeline: every stage's decisions take effect on what the one before kept."""

import corpus_pipeline
import pytest
from marquee.llm import decontam, linededup, simhash


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """Rows after each stage, as lists."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir))
        out.append((name, docs))
    return dict(out)


def test_order_and_columns(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                     "best_fit_packing"]
    for name in names[:-1]:
        assert kept[name].columns == kept["input"].columns
        assert kept[name].dtypes == kept["input"].dtypes


def test_each_stage_is_brute_force_on_its_input(spark, sf_dir, kept):
    rows = {n: df.collect() for n, df in kept.items()}
    ids = {n: {r.doc_id for r in some} for n, some in rows.items()}
    assert ids["toxicity"] <= ids["input"] and ids["line_dedup"] == ids["toxicity"]
    assert len(rows["line_dedup"]) == len(rows["toxicity"])
    assert all(r.n_chars == len(r.text or "") for r in rows["line_dedup"])
    groups = simhash.simhash_groups(kept["line_dedup"]).collect()
    assert ids["simhash_near_dedup"] == {r.component_id for r in groups}
    assert len(rows["simhash_near_dedup"]) == len(ids["simhash_near_dedup"])
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontam.judged(kept["simhash_near_dedup"], bench).collect()
    assert ids["benchmark_decontamination"] == {r.doc_id for r in judged if not r.n_hit}
    assert {r.doc_id for r in rows["best_fit_packing"]} == ids["benchmark_decontamination"]
    # Nothing is left to do a second time.
    assert linededup.repeated_lines(kept["toxicity"].limit(0)).count() == 0


def test_run_equals_the_stages(spark, sf_dir, kept):
    ran = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32")
    staged = kept["best_fit_packing"].select(ran.columns)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, staged.collect()))


def test_documents_stay_where_nothing_is_labelled(spark, sf_dir, tmp_path):
    """Toxicity without labels rejects nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path)).count() == docs.count()


def test_copies_without_an_id_leave_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = " ".join(f"word{i}" for i in range(50))
    rows = spark.createDataFrame([(None, text, "en", "s", 1)] * 3, docs.schema)
    assert corpus_pipeline.simhash_stage(spark, rows, sf_dir).count() == 1


def test_stages_take_an_empty_table_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (3, "", None, "s", 0), (3, "", None, "s", 0)],
                                docs.schema)
    for some in (docs.limit(0), odd):
        now = some
        for _, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.materialise(stage(spark, now, sf_dir))
        assert now.count() <= 2
