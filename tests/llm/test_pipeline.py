"""The pipeline against plain versions of its stages on whole tables."""

from collections import Counter

import corpus_pipeline
from test_decontaminate import brute as contaminated
from test_quality_rules import brute as quality
from test_simhash import brute as near
from test_token_output import brute as tokens

from tallylake.llm import mixing

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(r.doc_id, r.text) for r in docs.values() if quality(r.text)[-1]]
    kept = [(d, docs[d].text) for d, _, c in near(kept) if d == c]
    kept = [d for d, *_, bad in contaminated(kept, items) if not bad]
    left = spark.createDataFrame([docs[d] for d in kept])
    order = {r.doc_id: r.kept for r in mixing.mix_order(left).collect()}
    wanted = tokens(sorted((d, docs[d].text) for d in kept if order[d]))
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, found.collect())) == wanted and wanted


def test_stages_keep_the_columns_and_odd_rows(spark):
    rows = [(None, None, None, None, 0, "e"), (1, "", "en", "src0", 0, "e"), (2, "word " * 90_000, "en", "src0", 1, None)]
    rows += [(i % 90 + 3, " ".join(f"w{i % 90}x{k}" for k in range(70)), "en", f"src{i % 3}", 5, "e") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string")
    assert corpus_pipeline.STAGES[-1][0] == "token_output" and len(corpus_pipeline.STAGES) == 5
    for _, function in corpus_pipeline.STAGES[:-1]:
        empty = function(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0
        out = function(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() > 0
    assert Counter(r.doc_id for r in docs.collect()).most_common(1)[0][1] == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
