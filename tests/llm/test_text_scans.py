import hashlib
import random
import re

import pytest

from flightlake.llm import bpe_codec, length_histogram, license_scan

from .helpers import clashing, empty, messy, text_rows

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def base_places(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), sorted((i, label) for p, label in PHRASES.items() for i in range(len(words))
                              if words[i:i + len(p.split())] == p.split())


def test_license_base_places_match_brute_force(spark):
    got = license_scan.license_summary(license_scan.scan_licenses(messy(spark))).collect()
    assert len(got) == len(text_rows())
    want = sorted(str((d, *base_places(t))) for d, t, *_ in text_rows())
    seen = []
    for r in got:
        places = base_places(next(t for d, t, *_ in text_rows() if d == r.doc_id and len(base_places(t)[1]) == r.n_base))[1]
        seen.append(str((r.doc_id, r.n_words, places)))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert sorted(seen) == want
    assert license_scan.license_summary(license_scan.scan_licenses(empty(spark))).count() == 0


def test_license_edits_and_spans():
    n, hits = license_scan.hits_of("Text. Licensed under the Apache Licence,\n Version 2.0!")
    assert n == 9 and [h["label"] for h in hits] == ["apache-2.0"] and 0 < hits[0]["edits"] <= 4
    assert "Text. Licensed under the Apache Licence,\n Version 2.0!"[hits[0]["start"]:hits[0]["end"]] == "Licensed under the Apache Licence,\n Version 2.0"
    assert hits[0]["word"] == 1


def edit_distance_within(words, notice):
    """Smallest edits of the notice over all substrings (row-wise dynamic programme)."""
    text = " " + " ".join(words) + " "
    row = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_license_search_misses_nothing_within_the_bound():
    rng = random.Random(5)
    for notice in license_scan.FUZZY_NOTICES:
        for edits in range(notice.max_edits + 2):
            s = list(notice.text)
            for _ in range(edits):
                i = rng.randrange(len(s))
                s[i:i + rng.choice([0, 1])] = rng.choice(["q", "z", ""])
            text = f"some words {''.join(s)} then others"
            words = [w.decode() for w in license_scan.normalise(text)]
            _, hits = license_scan.hits_of(text, (notice,))
            best = edit_distance_within(words, notice.text)
            assert bool(hits) == (best <= notice.max_edits), (text, best)
            if hits:
                assert min(h["edits"] for h in hits) == best


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_codec.default_tokenizer())


def test_codec_equals_library(spark, library):
    rows = bpe_codec.encode_digests(messy(spark)).collect()
    want = []
    for d, t, *_ in text_rows():
        e = library.encode(t or "", add_special_tokens=False)
        decoded = library.decode(e.ids, skip_special_tokens=False)
        want.append((d, len(e.ids), hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert bpe_codec.encode_digests(empty(spark)).count() == 0
    out = bpe_codec.encode_documents(messy(spark)).where("doc_id = 8").first()
    assert out.ids == library.encode(text_rows()[10][1], add_special_tokens=False).ids


def test_codec_random_words(library):
    rng = random.Random(3)
    letters = "aeinorst the's!?.,<|>é0Ω漢́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["ab" * 5000, "a" * 9999]
    c = bpe_codec.Codec(bpe_codec.default_tokenizer())
    for (n, ids, decoded), e in zip(c.encode_texts(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids == " ".join(map(str, e.ids)) and n == len(e.ids)
        assert decoded == library.decode(e.ids, skip_special_tokens=False) == c.decode(e.ids)


def test_codec_equals_library_for_every_character(library):
    """Each code point alone, and between letters and marks that compose with them."""
    codec = bpe_codec.codec(bpe_codec.default_tokenizer())
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    points += list(map(chr, [*range(0x2F800, 0x2FA20), *range(0x20000, 0x110000, 997)]))
    for before, after in (("", ""), ("A", "\u0301"), ("C", "\u0327"), ("A\u0323", "\u0302"), ("か", "\u3099"), ("O\u031b", "")):
        texts = [before + c + after for c in points]
        want = [" ".join(map(str, e.ids)) for e in library.encode_batch(texts, add_special_tokens=False)]
        got = [ids for _, ids, _ in codec.encode_texts(texts)]
        assert [hex(ord(c)) for c, a, b in zip(points, got, want) if a != b] == [], (before, after)


def test_codec_keeps_columns_of_any_name(spark):
    docs = clashing(spark).withColumnRenamed("mix_order", "text_").withColumnRenamed("tried", "n_tokens")
    out = bpe_codec.encode_digests(docs, keep=["doc_id", "text_", "n_tokens", "a.b"])
    assert out.columns == ["doc_id", "text_", "n_tokens", "a.b", "n_tokens_", "ids_sha256", "decoded_sha256"]
    assert out.where("n_tokens_ > 0").count() > 0


def test_license_edits_count_characters():
    for text, label, edits in (("All rights reservéd", "reserved", 1), ("released under the mít lícense", "mit", 2), ("released ünder thé mit license", "mit", 2)):
        _, hits = license_scan.hits_of("Zürich – é. " + text + " ñ.")
        assert (label, edits) in {(h["label"], h["edits"]) for h in hits}, text
        hit = next(h for h in hits if h["edits"] == edits)
        assert ("Zürich – é. " + text + " ñ.")[hit["start"]:hit["end"]] in text


def test_codec_small_word_table(library, monkeypatch):
    monkeypatch.setattr(bpe_codec, "MAX_WORDS", 5)
    monkeypatch.setattr(bpe_codec, "MAX_CACHED", 4)
    c = bpe_codec.Codec(bpe_codec.default_tokenizer())
    for _ in range(3):
        for (_, ids, _), e in zip(c.encode_texts(["several longer words here", "words again"]),
                                  library.encode_batch(["several longer words here", "words again"], add_special_tokens=False)):
            assert ids == " ".join(map(str, e.ids))


def test_speculation_agrees_with_exact_merging():
    c = bpe_codec.Codec(bpe_codec.default_tokenizer())
    words = sorted({w for _, t, *_ in text_rows() for w in c.split(t or "") if w[0] != bpe_codec.SPECIAL})
    assert c.encode_words(words) == [c.merge(c.spell(w)) for w in words]


def test_histogram_matches_brute_force(spark):
    path = length_histogram.default_tokenizer()
    lengths = {}
    for _, t, _, s in text_rows():
        lengths.setdefault(s, []).append(length_histogram.length_of(t, path))
    encode = length_histogram.encoder(path).encode_ordinary
    assert all(length_histogram.length_of(t, path) == len(encode(t or "")) for _, t, *_ in text_rows())
    sums = length_histogram.token_histogram(messy(spark)).cache()
    for r in length_histogram.limit_table(sums, "source").collect():
        own = lengths[r.source]
        assert r.docs_cut == sum(x > r.context_limit for x in own) and r.n_docs == own.count(r.context_limit)
        assert r.tokens_kept == sum(min(x, r.context_limit) for x in own) and (r.docs_total, r.tokens_total) == (len(own), sum(own))
        assert r.docs_within == len(own) - r.docs_cut
    for r in length_histogram.at_limits(sums, "source", [0, 1, 7, 50, 10**6]).collect():
        own = lengths[r.source]
        assert (r.docs_cut, r.tokens_kept) == (sum(x > r.context_limit for x in own), sum(min(x, r.context_limit) for x in own))
    for r in length_histogram.quantiles(sums, "source", [0.25, 0.5, 1.0]).collect():
        own = sorted(lengths[r.source])
        assert r.n_tokens == own[-(-int(r.p * len(own) * 4) // 4) - 1]
    whole = length_histogram.with_quantiles(sums, "source").collect()
    assert len(whole) == length_histogram.limit_table(sums, "source").count()
    for r in whole:
        own = sorted(lengths[r.source])
        assert [r.p25, r.p50, r.p75, r.p90, r.p99] == [own[-(-len(own) * k // 100) - 1] for k in (25, 50, 75, 90, 99)]
    nothing = length_histogram.token_histogram(empty(spark))
    assert nothing.count() == 0 and length_histogram.with_quantiles(nothing, "source").count() == 0


def test_long_texts_are_cut_where_words_end():
    text = "some  words\n\n of  prose's  " * 400
    path = length_histogram.default_tokenizer()
    encode = length_histogram.encoder(path).encode_ordinary
    for size in (1, 7, 100, 5000):
        assert "".join(length_histogram.parts(text, size)) == text
        assert sum(len(encode(p)) for p in length_histogram.parts(text, size)) == len(encode(text))


def test_many_places_of_a_notice_in_one_text():
    """Places of one notice are compared with their neighbours only."""
    notice = "released under the mit license"
    text = " and ".join([notice, notice.replace("mit", "mti")] * 1_000)
    n, hits = license_scan.hits_of(text)
    own = [h for h in hits if h["label"] == "mit"]
    assert n == 6 * 2_000 - 1 and [h["word"] for h in own] == list(range(0, n, 6))
    assert [h["edits"] for h in own] == [0, 2] * 1_000


def test_training_rows_that_share_ids(spark):
    """The bounded fit takes the same rows whether or not hashes are spread."""
    from flightlake.llm import pairwise_quality
    rows = [(1, False, 0)] * 90 + [(i, False, 1) for i in range(10, 100)]
    cols = [f"cast(id + {k} as double) as {f}" for k, f in enumerate(pairwise_quality.FEATURES)]
    docs = spark.createDataFrame([(i,) for i in [1, *range(10, 100)]], "id long").selectExpr("id", "false as held_out", *cols)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    ranker = pairwise_quality.fit(docs, labels, max_rows=5)
    assert any(ranker.weights)
