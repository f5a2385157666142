import pytest

import corpus_pipeline as P
from chainfeatures.llm import decontam, mixing, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_in_order_on_a_table(spark):
    import __spark_entry__ as e

    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    d, kept = docs, {}
    for name, stage in P.STAGES:
        d = stage(spark, d, SF).cache()
        kept[name] = d
        if name != "sharding":
            assert d.columns == docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    after = {r["doc_id"] for r in kept["toxicity"].collect()}
    assert after == {i for i, p in scores.items() if not p}
    from test_neardup import brute
    rows = [(r["doc_id"], r["text"]) for r in kept["toxicity"].collect()]
    comp = brute(rows)
    near = {r["doc_id"] for r in kept["near_duplicates"].collect()}
    assert near == {i for i, c in comp.items() if i == c}
    flags = {r["doc_id"]: r["contaminated"] for r in decontam.decontaminate(kept["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    clean = {r["doc_id"] for r in kept["decontamination"].collect()}
    assert clean == {i for i, c in flags.items() if not c}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(kept["decontamination"]).collect()}
    mixed = [r["doc_id"] for r in kept["mixing"].select("doc_id").collect()]
    assert {i: mixed.count(i) for i in copies} == copies
    shards = kept["sharding"].toPandas()
    assert sorted(shards["doc_id"]) == sorted(mixed)
    assert sorted(map(tuple, P.run(spark, SF).select("doc_id", "shard", "slot").toPandas().itertuples(index=False))) == sorted(
        map(tuple, shards[["doc_id", "shard", "slot"]].itertuples(index=False)))
    assert e.HAS_PIPELINE and "pipeline" in e.queries()


def test_stages_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        d = docs
        for name, stage in P.STAGES:
            d = stage(spark, d, SF)
            if name != "sharding":
                assert d.columns == docs.columns
        assert d.count() >= 0
    kept = P.drop_near_duplicates(spark, edge_docs, SF)
    assert kept.filter("doc_id is null").count() == 2


def test_helper_columns_never_clash(spark, edge_docs):
    """Extra columns named like helper columns, in any case of letters, come through as they were."""
    docs = edge_docs.selectExpr("*", "1 AS __gone", "2 AS gone", "3 AS __HIT", "4 AS HIT", "5 AS __key", "6 AS key", "7 AS SCORE_")
    for d in (P.drop_toxic(spark, docs, SF), P.drop_near_duplicates(spark, docs, SF), P.drop_contaminated(spark, docs, SF),
              decontam.keep_clean(docs, spark.read.parquet(f"{SF}/benchmark.parquet"), broadcast_bytes=0)):
        assert d.columns == docs.columns
        assert {tuple(r[-7:]) for r in d.collect()} == {(1, 2, 3, 4, 5, 6, 7)}
