import hashlib
from functools import partial
import re

import duckdb

from pyspark.sql import functions as F

import corpus_pipeline
from flightlake.llm.oracle import ORACLE
from flightlake.llm.queries import QUERIES
from flightlake.llm import bpe_codec

from .helpers import clashing, empty, messy, store, text_rows


def same(spark_df, sql, sf):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(sql).df()
    got = spark_df.toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda f: sorted(map(str, f[cols].astype(str).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_queries_equal_their_sql(spark, sf_small):
    for name, sql in ORACLE.items():
        same(QUERIES[name](spark, sf_small), sql, sf_small)


def test_query_names_and_stage_order():
    assert [int(re.match(r"op(\d+)_", k).group(1)) for k in QUERIES] == list(range(1, 14))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixed", "encoded"]


def test_pipeline_stages(spark, sf_small):
    """Each stage against a plain computation on what it was given."""
    from flightlake.llm import quality_rules
    from flightlake.llm.common import written
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    kept = written(corpus_pipeline.quality(spark, docs, sf_small), "t-quality")
    assert kept.columns == columns
    verdict = {r.doc_id for r in QUERIES["op3_quality_rules"](spark, sf_small).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    unique = written(corpus_pipeline.exact_dedup(spark, kept, sf_small), "t-exact")
    best = {}
    for r in kept.collect():
        k = r.text.encode().lower()
        best[k] = max(best.get(k, -1), r.doc_id)
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == set(best.values())
    apart = written(corpus_pipeline.near_dedup(spark, unique, sf_small), "t-near")
    from .test_documents import brute_links
    rows = unique.collect()
    links = brute_links([r.text for r in rows])
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        for i, js in links.items():
            label[i] = min([label[i], *[label[j] for j in js]])
    top = {}
    for r, x in zip(rows, label):
        top[x] = max(top.get(x, -1), r.doc_id)
    assert {r.doc_id for r in apart.collect()} == set(top.values())
    mixed = written(corpus_pipeline.mixed(spark, apart, sf_small), "t-mix")
    assert mixed.columns == columns
    words = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in d.collect())
    assert abs(words(mixed) - 1.5 * words(apart)) < 0.1 * words(apart)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in apart.collect()}
    out = corpus_pipeline.encoded(spark, mixed, sf_small).collect()
    c = bpe_codec.Codec(bpe_codec.default_tokenizer())
    want = sorted((r.doc_id, hashlib.sha256(" ".join(map(str, c.encode(r.text))).encode()).hexdigest()) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in out) == want


def test_stages_take_empty_tables(spark, sf_small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), sf_small).count() == 0


def test_columns_with_the_operators_own_names(spark, sf_small):
    """Extra columns keep names and values; what an operator adds steps aside."""
    from flightlake.llm import pii_surrogates, quality_rules, source_mix
    docs = clashing(spark)
    own = docs.columns[12:]
    first = list(docs.first())[12:]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        rows = out.collect()
        assert out.columns == docs.columns and rows
        assert all(list(r)[12:] == first for r in rows)
    assert corpus_pipeline.encoded(spark, docs, sf_small).count() == len(text_rows())
    added = {quality_rules.with_verdict: ["quality_", "quality__kept"], source_mix.mix: ["mix_shard_", "mix_order_"],
             partial(pii_surrogates.replace_entities, key="k"): ["pii_"]}
    for operator, names in added.items():
        out = operator(docs)
        assert out.columns == docs.columns + names
        assert all(list(r)[12:12 + len(own)] == first for r in out.collect())


def test_groups_named_like_result_columns(spark):
    """The histogram's group may have any name, also one of its own columns."""
    from flightlake.llm import length_histogram
    for name in ("__text", "n_tokens", "P50", "p", "group_key", "docs_total", "a.b"):
        docs = messy(spark).select(*[c for c in ("doc_id", "text")], F.col("rep").alias("other"), F.col("source").alias(name))
        sums = length_histogram.token_histogram(docs, group=name)
        out = length_histogram.with_quantiles(sums, sums.columns[0]).collect()
        assert {r[0] for r in out} == {t[3] for t in text_rows()} and sum(r.n_docs for r in out) == len(text_rows())
