"""Every stage against brute force on what the stage before it kept."""

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from quern.llm import quality
from quern.sources.staging import staged
from quern.sources.tables import table
from tests.llm.helpers import jaccard_components, none, odd


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    kept = {r.doc_id for r in quality.document_quality(docs).where("kept").collect()}
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(staged(stage(spark, frames[-1], sf_dir), "test-stage"))
        assert frames[-1].dtypes == docs.dtypes, name
    _, good, known, single, cut = [{r.doc_id: r for r in f.collect()} for f in frames]
    assert set(good) == kept and all(r.lang for r in known.values())
    assert set(known) <= set(good) and len(known) >= 0.99 * len(good)
    want, _ = jaccard_components({i: r.text for i, r in known.items()})
    assert len(single) == len(set(want.values())) and {want[i] for i in single} == set(want.values())
    assert set(cut) == set(single) and all(r.n_chars == len(r.text) <= len(single[i].text) for i, r in cut.items())
    assert sum(len(r.text) for r in cut.values()) < sum(len(r.text) for r in single.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.STAGES[-1][1](spark, frames[-1], sf_dir).collect()
    sizes = {r.doc_id: r.doc_tokens for r in rows}
    assert sizes == {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in cut.items()}
    assert sum(r.length for r in rows) == sum(sizes.values())


def test_run_is_registered(spark, sf_dir):
    names = contract.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {q[: q.index("_") + 1] for q in names if q.startswith("op") and q[2].isdigit()}
    assert names["pipeline"](spark, sf_dir).count() > 0


def test_odd_tables(spark, sf_dir):
    for docs in (none(spark), odd(spark)):
        docs = docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as long) as n_chars", "*").select("doc_id", "text", "lang", "source", "n_chars") if docs.isEmpty() else docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 0
