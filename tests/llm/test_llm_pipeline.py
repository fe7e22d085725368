import corpus_pipeline
import __spark_entry__ as contract
from shiftpay.llm import packing, simhash, toxicity
from shiftpay.sources.files import stage
from test_llm_simhash import plain_fingerprint
from test_llm_suffixes import brute

SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, given = docs.columns, docs
    results = {}
    for name, work in corpus_pipeline.STAGES:
        given = stage(work(spark, given, SMALL), name)
        results[name] = given
        if name != "packing":
            assert given.columns == columns
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.scored(docs, model).where("predicted = 1").collect()}
    assert rejected and rejected.isdisjoint(r.doc_id for r in results["toxicity"].collect())
    assert results["toxicity"].count() == docs.count() - len(rejected)
    assert results["line_dedup"].count() == results["toxicity"].count()
    lines = [(r.doc_id, r.text) for r in results["line_dedup"].collect()]
    kept = {r.doc_id for r in results["simhash_dedup"].collect()}
    marks = {i: plain_fingerprint(t) for i, t in lines}
    for i, _ in lines:  # each is kept, or a chain of links leads to a smaller id
        near = [j for j in marks if j < i and (marks[i] ^ marks[j]).bit_count() <= 4]
        assert not (i in kept and near)
    before = [(r.doc_id, r.text) for r in results["simhash_dedup"].collect()]
    left = {r.doc_id: r for r in results["suffix_dedup"].collect()}
    for i, _, _, _, body in brute(before, 200):
        assert left[i].text == body.decode("utf-8", "ignore")
        assert left[i].n_chars == len(left[i].text)
    assert results["packing"].agg({"length": "sum"}).first()[0] == (
        packing.tokenized(results["suffix_dedup"], packing.public_tokenizers.path("byte_bpe_50k.json"))
        .agg({"n_ids": "sum"})
        .first()[0]
    )
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.count() == results["packing"].count()
    assert simhash.keep_one(results["simhash_dedup"]).count() == results["simhash_dedup"].count()
