"""The pipeline against a brute-force version of each of its stages."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from ampora.llm.quality import quality_scores
from ampora.llm.queries import QUERIES, tokenizer_path
from ampora.llm.toxicity import toxicity_scores
from tests.llm.test_filters import brute_hits
from tests.llm.test_near_dedup import bag

SF = "/root/testdata/sf0.001"


def test_operators_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "toxicity", "minhash near-dedup", "benchmark decontamination", "bpe encoding and decoding"]


def test_run_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    bad = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 0").collect()}
    toxic = {r.doc_id for r in toxicity_scores(docs, labels).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in bad | toxic}
    bags = {d: bag(t) for d, t in texts.items()}
    ids = sorted(texts)
    parent = {d: d for d in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if not bags[a].keys() & bags[b].keys():
                continue
            if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
                parent = {d: new if p == old else p for d, p in parent.items()}
    items = [(r.item_id, r.text) for r in bench.collect()]
    clean = {d for d in ids if parent[d] == d and not brute_hits(texts[d], items)[4]}
    library = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == clean and 0 < len(clean) < docs.count()
    for d in clean:
        encoded = library.encode(texts[d] or "", add_special_tokens=False).ids
        assert got[d].n_tokens == len(encoded)
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, encoded)).encode()).hexdigest()


def test_stages_take_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (None, "no id", "en", "s", 1), (-2, "", "en", "s", 0), (-2, "", "en", "s", 0)], docs.schema)
    rows = docs.limit(40).union(odd).withColumns({c: F.lit("mine") for c in ("score", "class_id", "hits", "dropped_id", "id")})
    for given in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, given, SF)
            assert kept.columns == rows.columns, name
            assert kept.count() <= given.count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() == given.count()


def test_stages_bound_the_batches_of_texts(spark):
    """Workers get a bounded number of rows at once; a smaller setting of the session stays."""
    import corpus_pipeline
    from ampora.llm.ship import TEXTS_AT_ONCE, bound_batches

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3)], "doc_id long, text string")
    before = spark.conf.get(key)
    try:
        for given, held in (("10000", str(TEXTS_AT_ONCE)), ("0", str(TEXTS_AT_ONCE)), ("7", "7")):
            spark.conf.set(key, given)
            corpus_pipeline.bpe_encoding(spark, docs, "")
            assert spark.conf.get(key) == held
            spark.conf.set(key, given)
            bound_batches(spark)
            assert spark.conf.get(key) == held
    finally:
        spark.conf.set(key, before)
