import os

import pytest

import corpus_pipeline
from tests.llm.test_classifiers import make
from tests.llm.test_decontamination import brute as hits
from tests.llm.test_near_dedup import brute as groups
from tidewell.llm import pii, queries_classifiers, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = make(4, 300)
    item = "when seven quiet ships went over the cold northern water they found nothing"
    docs += [(20_000, docs[3][1], "en"), (20_001, docs[3][1].replace(" ", "  ", 1), "en"), (20_002, f"{docs[8][1][:300]} {item} write to ann@mail.example.com", "en"), (20_003, item, "en")]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, item


def test_each_stage_on_what_the_one_before_kept(spark, folder):
    path, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "pii", "byte_bpe"]
    step = dict(corpus_pipeline.STAGES)

    model = queries_classifiers.toxicity_model(spark, docs, path)
    scores = {(r.doc_id, r.score) for r in toxicity.score(docs, model).collect()}
    clean = step["toxicity"](spark, docs, path)
    kept = [tuple(r)[:2] for r in clean.collect()]
    assert {i for i, _ in kept} == {i for i, s in scores if s < 0.5} and clean.columns == docs.columns

    single = step["near_dedup"](spark, clean, path)
    roots = {i for i, _, c in groups(kept, 5, 80) if i == c or i is None}
    got = [r.doc_id for r in single.collect()]
    assert set(got) == roots and len(got) == len(set(got)) and single.columns == docs.columns
    assert 20_000 not in roots and 20_001 not in roots

    cut = {r.doc_id: r for r in step["decontamination"](spark, single, path).collect()}
    for r in single.collect():
        n, hit, _ = hits(r.text, [(1, item)], 10)
        assert (r.doc_id in cut) == (hit <= 0.5 * n)
        if r.doc_id in cut and not hit:
            assert cut[r.doc_id].text == r.text
    assert 20_003 not in cut and item not in cut[20_002].text and cut[20_002].n_chars == len(cut[20_002].text)

    last = step["pii"](spark, single, path)
    texts = {r.doc_id: r.text for r in last.collect()}
    assert "[EMAIL]" in texts[20_002] and not pii.identifiers(texts[20_002])
    assert last.columns == docs.columns


def test_run(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) > 150 and all(r.n_tokens == len(r.ids) for r in out) and 20_003 not in ids


def test_empty_tables(spark, tmp_path):
    for name, kind in (("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], kind).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
