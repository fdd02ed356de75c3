import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from flightlake.llm import anchor_dedup, impact_search, source_divergence

from .helpers import clashing, empty, messy, store, text_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return (t or "").encode().lower().decode()


# --- ranked search

def brute_search(docs, items, k):
    terms = [TERM.findall(lower(t)) for _, t in docs]
    held = [i for i, t in enumerate(terms) if t]
    n_docs, n_terms = len(held), sum(map(len, terms))
    df = Counter(t for x in terms for t in set(x))
    out = []
    for item_id, text in items:
        scored = []
        for i in held:
            tf, m = Counter(terms[i]), 25 + 75 * len(terms[i]) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in TERM.findall(lower(text)) if tf[t])
            if s > 0:
                scored.append((-s, docs[i][0] is not None, docs[i][0] or 0, docs[i][0]))
        out += [(item_id, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def words(rng, n, pool):
    return " ".join(rng.choice(pool) for _ in range(n))


def search_rows():
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(60)] + ["Zürich", "日本", "A1", "x\x00y", "it's"]
    docs = [(i, words(rng, rng.randint(1, 40), pool)) for i in range(120)]
    docs += [(200 + i, "w1 w2 w3 common passage") for i in range(40)] + [(None, "w1 w2"), (None, None), (300, ""), (301, "w1 " * 30_000), (5, "w4 w5")]
    items = [(i, words(rng, rng.randint(1, 12), pool)) for i in range(20)] + [(50, "w1 w2 w3"), (50, "w1 w1 W1"), (51, None), (None, "w7 日本"), (52, "unheard"), (53, "w9 " * 500)]
    return docs, items


def test_search_matches_brute_force(spark):
    docs, items = search_rows()
    d, q = store(spark, docs, "doc_id long, text string, id long, row long, n long, numbers string, tile int"), store(spark, items, "item_id long, text string, item string, rank int")
    want = brute_search(docs, items, 10)
    for kw in ({}, {"vocabulary_bytes": 0}, {"tile_items": 3, "block_docs": 16}):
        got = impact_search.search(d, q, **kw).select("item_id", "rank", "doc_id", "score")
        assert sorted([tuple(r) for r in got.collect()], key=str) == want, kw
    few = impact_search.search(d, q, k=1)
    assert sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in few.collect()], key=str) == brute_search(docs, items, 1)


def test_search_of_empty_tables(spark):
    docs, items = search_rows()
    d, q = store(spark, docs, "doc_id long, text string"), store(spark, items, "item_id long, text string")
    none = empty(spark)
    assert impact_search.search(none, q).count() == 0
    assert impact_search.search(d, none, item_col="doc_id").count() == 0
    out = impact_search.search(messy(spark), clashing(spark), item_col="doc_id", id_col="doc_id")
    assert out.columns.count("doc_id") == 2  # the names are the caller's


def test_partial_sums_stay_exact(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(impact_search, "VOCAB_TILE", 4)
    n_items, n_cols = 5, 23
    item, col = np.nonzero(rng.random((n_items, n_cols)) < 0.8)
    weight = rng.integers(1, 30_000, len(item))
    weight[::7] *= 200_000  # near, and with 2^53 / 10^6 beyond, what one product may hold
    weight[3] = 1 << 40
    tiles = impact_search.vocabulary_tiles(item, col, weight, n_items, n_cols)
    assert [t[0] for t in tiles][1:] == [t[1] for t in tiles][:-1] and tiles[-1][1] == n_cols
    assert {t[2].dtype.kind for t in tiles} == {"f", "i"}
    doc = rng.integers(0, 999_999, (n_cols, 6))
    total = sum((q @ doc[a:b].astype(q.dtype)).astype(np.int64) for a, b, q in tiles)
    dense = [[sum(int(w) * int(doc[c, d]) for i, c, w in zip(item, col, weight) if i == r) for d in range(6)] for r in range(n_items)]
    assert total.tolist() == dense


# --- source divergence

def brute_audit(rows, min_docs):
    rows = [(lang or "", source or "", LETTERS.findall(lower(t))) for t, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for r in mine for t in set(r[2]))
        kept = sorted((t for t in df if df[t] >= min_docs), key=lambda t: t.encode())
        count, whole = defaultdict(Counter), Counter()
        for _, s, ts in mine:
            count[s].update(t for t in ts if df[t] >= min_docs)
            whole.update(t for t in ts if df[t] >= min_docs)

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q, p = shares(whole), {s: shares(count[s]) for s in count}
        for s in count:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(found) if part == "pair" or r < 50]
    return sorted(out)


def audit_rows():
    rng = random.Random(12)
    pool = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Österreich", "日本語", "ABC"]
    rows = [(words(rng, rng.randint(1, 30), rng.sample(pool, 40)), rng.choice(["en", "de", None, ""]), f"s{min(rng.randint(0, 40), 25)}") for _ in range(500)]
    return rows + [(None, "en", "bare"), ("", "xx", "only"), ("12 34", "xx", None), (None, None, None), ("ta " * 30_000, "en", "s25")]


def test_divergence_matches_brute_force(spark):
    rows = audit_rows()
    t = store(spark, rows, "text string, lang string, source string, term string, n long, no long, tb int, p long, gb int, base long")
    want = brute_audit(rows, 5)
    for blocks in ((64, 4096), (4, 16), (1, 1000)):
        got = source_divergence.divergence_audit(t, min_docs=5, group_block=blocks[0], term_block=blocks[1])
        assert sorted(tuple(r) for r in got.collect()) == want, blocks
    assert any(r[2] == "term" and r[5] == 50 for r in want)


def test_divergence_when_rows_arrive_in_another_order_per_term_block(spark):
    rows = audit_rows()
    t, want = store(spark, rows, "text string, lang string, source string"), brute_audit(rows, 5)
    # Sort-merge joins deal the slices out by a hash of group and term block.
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        for blocks in ((64, 16), (4, 16)):
            got = source_divergence.divergence_audit(t, min_docs=5, group_block=blocks[0], term_block=blocks[1])
            assert sorted(tuple(r) for r in got.collect()) == want, blocks
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pairs_of_a_cell_do_not_depend_on_the_order_of_rows():
    sources = ["b", "a", "\U00010000", "\uffff", ""]
    for b in (0, 1):
        rows = [{"lang": "en", "source": s, "gb": min(i % 2, b), "a": 0, "b": b, "size": 9, "base": 5 + i,
                 "numbers": [i, 7] if i else None, "shares": [40 + i, 90 * i] if i else None} for i, s in enumerate(sources)]
        found = [source_divergence.cell_sums(source_divergence.pa.Table.from_pylist(r)).to_pylist() for r in (rows, rows[::-1], rows[2:] + rows[:2])]
        first, *others = [sorted(tuple(x.values()) for x in f) for f in found]
        assert len(first) == (6 if b else 10) and all(f == first for f in others), b


def test_divergence_of_small_tables(spark):
    assert source_divergence.divergence_audit(empty(spark)).count() == 0
    rows = [(t, lang, s) for _, t, lang, s in text_rows()]
    for table in (messy(spark), clashing(spark)):
        got = source_divergence.divergence_audit(table)
        assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, 30)
    assert not [r for r in brute_audit(rows, 30) if r[4]]  # no term in 30 documents: all values are 0


def test_shares_are_exact(spark):
    big = 9_000_000_000_000_000
    row = spark.createDataFrame([(big, 2 * big, 7)], "n long, total long, terms long").select(
        source_divergence.share(*[source_divergence.F.col(c) for c in ("n", "total", "terms")]).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (2 * big + 35)


# --- repeated passages

def brute_repeats(rows, window):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(window):
    rng = random.Random(window)
    pool = [f"v{i}" for i in range(400)]
    passages = [words(rng, n, pool) for n in (window - 1, window, window + 1, 2 * window, 3 * window)]
    rows = []
    for i in range(150):
        parts = [words(rng, rng.randint(0, window), pool)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            cut = rng.choice([0, 0, 0, 1, 2])
            parts += [" ".join(p[cut:]), words(rng, rng.randint(0, 4), pool)]
        rows.append((rng.randint(0, 120), "\n".join(parts)))
    base = words(rng, 6 * window, pool).split()
    for i in range(20):  # near copies: an edit every so often
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, "same word " * (2 * window)), (301, "same word " * window), (302, "same word " * (window // 2)), (300, "same word " * window)]
    return rows + [(None, " ".join(base)), (None, None), (400, ""), (401, " \t\n\r\x0b\x0c "), (402, "Mit word " * 30_000), (403, "Mit word " * 30_000), (404, "lone")]


def test_covers_meet_at_every_distance():
    for period, cover in anchor_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert anchor_dedup.cover_of(50) == (31, (0, 1, 3, 8, 12, 18), 20)
    for n in (49, 50, 51, 500):
        at = anchor_dedup.cover_positions(n, 50)
        assert at.tolist() == [i for i in range(n - 19) if i % 31 in anchor_dedup.COVERS[31]] * (n >= 50)


def test_repeats_match_brute_force(spark):
    for window in (4, 12, 50):
        rows = repeat_rows(window)
        got = anchor_dedup.find_repeats(store(spark, rows, "doc_id long, text string, row long, id long, n string, h long, k int"), window=window)
        have = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()], key=str)
        assert have == brute_repeats(rows, window), window


def test_cut_texts(spark):
    rows = repeat_rows(12)
    docs = store(spark, rows, "doc_id long, text string, row_number_ long, cut_ranges_ string, `a.b` string, x_row long")
    out = anchor_dedup.cut_repeats(docs, window=12)
    assert out.columns == docs.columns
    cut = {(d, s) for d, _, n, s in brute_repeats(rows, 12) if n}
    kept = Counter((d, t) for d, t in rows)
    for r in out.collect():
        if (r.doc_id, r.text) in kept:
            continue
        assert (r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) in cut
    assert out.count() == len(rows)


def test_repeats_of_small_tables(spark):
    assert anchor_dedup.find_repeats(empty(spark)).count() == 0
    want = brute_repeats([(d, t) for d, t, *_ in text_rows()], 50)
    for table in (messy(spark), clashing(spark)):
        got = anchor_dedup.find_repeats(table)
        assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()], key=str) == want
