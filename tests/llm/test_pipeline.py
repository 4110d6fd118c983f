import corpus_pipeline
from samples import odd_rows
from test_dedup import expected_near, lowered

from pacewatch.llm import bpe
from pacewatch.llm.queries import tokenizer_spec

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_a_small_table(spark, sf_dir, documents):
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf_dir))
        seen.append(name)
        if name != "bpe":
            assert docs.columns == DOCUMENTS
        if name == "exact_dedup":
            texts = [lowered(r.text) for r in docs.collect()]
            assert sorted(texts) == sorted({lowered(r.text) for r in before.collect()})
        if name == "simhash_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in docs.collect()} == {c for _, _, c in expected_near(rows)}
        if name == "bpe":
            assert sorted(docs.collect()) == sorted(bpe.tokenized(before, tokenizer_spec()).collect())
    assert seen == ["quality", "exact_dedup", "simhash_dedup", "mixing", "bpe"]


def test_pipeline_ends_with_tokens(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_stages_take_odd_rows(spark, sf_dir, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
    assert docs.count() > 0 and len(odd_rows()) == odd.count()
