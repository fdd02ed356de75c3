import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from flightlake.llm import pairwise_quality, quality_rules, source_mix

from .helpers import empty, messy, store, text_rows


def brute_metrics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_metrics_match_brute_force(spark):
    rng = random.Random(1)
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "c#", "é"]) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 6))) for _ in range(40)]
    rows = text_rows() + [(100 + i, t, "en", "z") for i, t in enumerate(texts)]
    got = quality_rules.with_metrics(store(spark, rows)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_metrics(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_quality_filter_keeps_clean_and_drops_outliers(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 99)) for _ in range(50)) for _ in range(60)]
    junk = [" ".join(f"w{i}{k}###" for i in range(40)) for k in range(6)]
    rows = [(i, t, "en", "s" if i % 2 else None) for i, t in enumerate(clean + junk)]
    kept = {r.doc_id for r in quality_rules.filter_quality(store(spark, rows + text_rows()[4:7])).collect()}
    assert set(range(len(clean))) <= kept and not kept & set(range(len(clean), len(rows)))
    out = quality_rules.filter_quality(empty(spark))
    assert out.count() == 0 and out.columns == empty(spark).columns


def test_sketches_merge_and_round(spark):
    v = [0, 1, 63, 64, 127, 128, 129, 255, 1000, 12345]
    got = [r.x for r in spark.createDataFrame([(x,) for x in v], "v long").select(quality_rules.rounded(F.col("v")).alias("x")).collect()]
    assert got == [x - x % (1 << max(0, x.bit_length() - quality_rules.SKETCH_BITS)) for x in v]
    parts = spark.createDataFrame([("en", "a", "symbols", 1, 2), ("en", "b", "symbols", 1, 3)], "lang string, source string, rule string, value long, n long")
    assert [tuple(r) for r in quality_rules.merged(parts, ["lang"]).collect()] == [("en", "symbols", 1, 5)]


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share by weight; stop at the cap; share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), sum(sizes.values()) * share
    while open_ and left > 1e-9:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * unit >= cap * sizes[s]}
        for s in full or open_:
            target[s] = cap * sizes[s] if full else w[s] * unit
        left -= sum(target[s] for s in (full or open_))
        open_ -= full or open_
    return target


def mixed_rows(n=600):
    rng = random.Random(4)
    return [(i, " ".join(["w"] * rng.randint(0, 40)) + f" {i}", "en", rng.choice(["a", "a", "a", "b", "é", None])) for i in range(n)]


def test_mix_meets_targets_and_repeats(spark):
    rows = mixed_rows(20_000) + [r for r in text_rows() if r[1] is None or len(r[1]) < 10_000]
    docs = store(spark, rows)
    got = source_mix.mix_summary(docs).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for _, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(sizes)
    by_size = {v: k for k, v in sizes.items()}
    for r in got:
        assert abs(r.target - want[by_size[r.source_size]]) < 1e-6 * max(1, r.target) and r.taken <= 2 * r.size
        taken[by_size[r.source_size]] += r.taken
    # Whole passes are exact and the cut misses by half a document at most, so by the longest text of the source.
    longest = {s: max(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, x in rows if x == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s]
    assert longest["a"] < 0.05 * want["a"]
    copies = Counter((r.doc_id, r.text) for r in source_mix.mix(docs).collect())
    held = Counter((i, t) for i, t, *_ in rows)  # repeated rows move together
    per_doc = Counter((r.doc_id, r.size, r.taken) for r in got)
    brute = Counter()
    for (i, t), n in held.items():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert copies[i, t] % n == 0
        brute[i, size, size * copies[i, t] // n] += n
    assert per_doc == brute
    again = source_mix.mix_summary(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    long = source_mix.mix_summary(messy(spark)).collect()
    assert len(long) == len(text_rows()) and all(r.taken <= 2 * r.size for r in long)
    assert source_mix.mix(empty(spark)).count() == 0 and source_mix.mix_summary(empty(spark)).count() == 0


def test_tree_quotas_are_exact(spark):
    drawn = spark.range(1000).selectExpr("cast(id % 3 as int) as rank").union(spark.range(200).selectExpr("3 as rank"))
    q = source_mix.quotas(drawn, 7).collect()
    per, shard = Counter(), Counter()
    for r in q:
        per[r["rank"]] += r.quota
        shard[r.shard] += r.quota
    assert per == Counter({0: 334, 1: 333, 2: 333, 3: 200}) and sum(shard.values()) == 1200
    assert max(shard.values()) - min(shard.values()) <= 2 and len(shard) == 7


def test_hypergeometric_draw_has_the_right_law(spark):
    n = 20_000
    u = source_mix.uniform(F.lit(9), F.col("id"))
    got = Counter(r.x for r in spark.range(n).select(source_mix.hypergeometric(F.lit(50), F.lit(20), F.lit(15), u).alias("x")).collect())
    for x in range(16):
        p = math.comb(20, x) * math.comb(30, 15 - x) / math.comb(50, 15)
        assert abs(got[x] - n * p) <= 6 * math.sqrt(n * p + 1)


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    quality = x @ np.array([2.0, -1.0, 0.0])
    good, bad = x[quality > 0], x[quality <= 0]
    w = pairwise_quality.bradley_terry(pairwise_quality.pairs_of(good, bad))
    assert (good @ w).mean() > (bad @ w).mean() and w[0] > 0 > w[1] and abs(w[2]) < abs(w[1]) / 3
    assert 0.9 < pairwise_quality.quantile_cut(np.array([0.0, 1, 2]), np.array([1.0, 1, 1]), 2 / 3) < 2


def test_classifier_on_held_out_rows(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    s = pairwise_quality.score_documents(docs, labels)
    assert s.count() == docs.count() and s.where("score < 0 OR score > 1").isEmpty()
    j = s.join(labels, "doc_id").where("held_out")
    assert j.where("predicted = quality").count() >= 0.93 * j.count()


def test_cut_covers_all_training_rows(spark):
    """The fit's bound on rows does not reach the cut."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, len(pairwise_quality.FEATURES)))
    quality = (x[:, 0] + rng.normal(size=600) > 0.5).astype(int)
    docs = spark.createDataFrame([(i, False, *map(float, f)) for i, f in enumerate(x)], ["id", "held_out", *pairwise_quality.FEATURES])
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(quality)], "doc_id long, quality int")
    ranker = pairwise_quality.fit(docs, labels, max_rows=20)
    n, scores = int((quality == 0).sum()), np.sort(x @ np.array(ranker.weights))
    assert math.isclose(ranker.cut, (scores[n - 1] + scores[n]) / 2, abs_tol=1e-9) and (scores < ranker.cut).sum() == n


def test_cut_equals_sorting(spark):
    for values in ([1.0, 1.0, 1.0], [0.0, 1.0, 2.0, 2.0, 2.0], [1e-300, 2e-300, 1.0, 1e9, -1e9], [5.0, 5.0 + 1e-15, 7.0]):
        scored = spark.createDataFrame([(v,) for v in values], "score double")
        for below in range(1, len(values)):
            expected = pairwise_quality.quantile_cut(np.array(values), np.ones(len(values)), below / len(values))
            assert pairwise_quality.score_cut(scored, below) == expected


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (99, None)], "doc_id long, quality int")
    got = pairwise_quality.score_documents(messy(spark), labels)
    assert got.count() == len(text_rows()) and got.where("score IS NULL").isEmpty()
    none = pairwise_quality.score_documents(messy(spark), labels.where("quality = 1"))
    assert {r.score for r in none.collect()} == {0.5}
    assert pairwise_quality.score_documents(empty(spark), labels).count() == 0
