"""The pipeline against a brute-force run of its stages."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from loadkit.llm.language import predict_languages
from loadkit.session import materialise
from tests.llm.odd import no_docs, odd_docs
from tests.llm.test_sets import brute_dedup, brute_groups, check_mix
from tests.oracle import TABLES

SF_DIR = f"{TABLES}/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rejected = {r["doc_id"] for r in predict_languages(docs).filter("rejected").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in rejected]
    kept = {keep for _, keep, _, _ in brute_dedup(rows)}
    rows = [r for r in rows if r[0] in kept]
    kept = {least for _, _, least in brute_groups(rows, 5, 80)}
    want = {i: t for i, t in rows if i in kept}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    copies = Counter(r["doc_id"] for r in got)
    assert set(copies) <= set(want)
    assert all(r["ids"] == library.encode(want[r["doc_id"]]) for r in got)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    from loadkit.llm.mixing import mix

    mixed = mix(docs.filter(docs.doc_id.isin(list(want)))).collect()
    check_mix(mixed)
    assert {r["doc_id"]: r["copies"] for r in mixed if r["copies"]} == dict(copies)
    assert {r["doc_id"] for r in mixed} == set(want) and all(r["source"] == source[r["doc_id"]] for r in mixed)


def test_stages_keep_columns_and_take_odd_rows(spark):
    for make in (odd_docs, no_docs):
        docs = make(spark)
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = materialise(stage(spark, docs, SF_DIR), "stage")
            assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
        assert (docs.count() > 0) == (make is odd_docs)


def test_stages_keep_rows_without_id_and_repeated_ids(spark):
    """Every text that the exact stage marks kept goes on to the end, whatever its id or null."""
    from tests.llm.odd import prose

    rows = [(None, prose(100 + i), "en", "a") for i in range(6)]
    rows += [(7, prose(200 + i), "en", "b") for i in range(4)]  # one id, four texts
    rows += [(8, prose(200)), (1, prose(300)), (9, prose(300)), (9, prose(301)), (None, prose(301))]
    rows = [(*r, "en", "c")[:4] for r in rows] + [(None, prose(100), "en", "a"), (7, prose(201), "en", "b")]
    near = prose(400, 200)
    rows += [(None, near + " one", "en", "a"), (None, near + " two", "en", "a"), (20, near + " three", "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    exact = materialise(corpus_pipeline.exact_dedup(spark, docs, SF_DIR), "stage")
    texts = Counter(r[1] for r in rows)
    assert Counter(r["text"] for r in exact.collect()) == Counter(set(texts))
    owner = {r["text"]: r["doc_id"] for r in exact.collect()}
    assert owner[prose(200)] == 7 and owner[prose(300)] == 1 and owner[prose(301)] == 9
    left = materialise(corpus_pipeline.near_dedup(spark, exact, SF_DIR), "stage")
    want = {(r["doc_id"], r["text"]) for r in exact.collect() if not r["text"].startswith(near)}
    want.add((20, near + " three"))
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(want)
    from loadkit.llm.mixing import mix

    mixed = corpus_pipeline.mixing(spark, left, SF_DIR)
    planned = Counter()
    for r in mix(left).collect():
        planned[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == +planned
    again = corpus_pipeline.mixing(spark, docs, SF_DIR)  # also rows that are the same throughout
    planned = Counter()
    for r in mix(docs).collect():
        planned[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r["doc_id"], r["source"]) for r in again.collect()) == +planned
