"""Substring dedup by difference-cover anchors.

A word is removed when it lies in a window of ``WINDOW`` consecutive words whose
sequence also starts, anywhere, in a document with a smaller id. Windows are
judged on the input, not on what is left.

1. *Anchors.* ``COVER`` is a difference cover modulo ``PERIOD``: whatever two
   places a passage stands at in two documents, some step below ``PERIOD`` takes
   both to positions of the cover. So only these positions (6 of 31) are hashed,
   ``ANCHOR`` words each, and any two equal windows share an anchor.
2. *Shared anchors.* One aggregate per hash finds the smallest and the largest
   document; an anchor with two documents is joined back to its places.
3. *Extension.* Neighbouring anchors of a document that meet the same earliest
   document at the same distance overlap, so everything from the first one's
   first word to the last one's last word is equal: a chain. A chain of a whole
   window is removed without looking at the text again.
4. *Chain ends.* Windows that hold a shared anchor but reach beyond a chain are
   compared by 128-bit hashes with the windows around the same anchors, of all
   documents that have them.

Nothing is compared in pairs: a passage in m documents costs m places at every
step, aggregates are reduced in the map tasks, and the joins of hot hashes are
merge joins that Spark splits. Anchors are 64-bit hashes: a false match can only
add a window to step 4, as a chain needs several of them in line.

Defined cases: null and blank texts have no words; texts under ``WINDOW`` words
lose none; of rows with equal ids none counts as smaller; a null id is neither
smaller nor larger than any; an empty table gives an empty result; other columns
are not read, or kept as they are by ``cut_repeats``. ``docs`` has to be a
stored table: its scan has to number the rows alike each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, map_batches, row_id, words_of, written

WINDOW = 50
# Perfect difference sets: every distance modulo the period is a difference of two members.
COVERS = {31: (0, 1, 3, 8, 12, 18), 13: (0, 1, 3, 9), 7: (0, 1, 3), 3: (0, 1)}
_U = np.uint64


def cover_of(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, cover, anchor length): the largest period that leaves anchors of a third of the window."""
    period = max((p for p in COVERS if 3 * (p - 1) <= 2 * window), default=3)
    return period, COVERS[period], window - period + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def steps(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


def words_in(text: bytes | None) -> list[bytes]:
    """Maximal runs without the six blanks (space and U+0009 to U+000D)."""
    return (text or b"").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def hashes_at(w: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """One hash of ``length`` words from each position ``at``."""
    total = np.zeros(len(at), np.uint64)
    for k, c in enumerate(steps(length, seed)):
        total += w[at + k] * c
    return mixed(total)


def cover_positions(n: int, window: int) -> np.ndarray:
    """Anchor places in a text of ``n`` words, ascending: the k-th is period * (k div |cover|) + cover[k mod |cover|]."""
    period, cover, anchor = cover_of(window)
    if n < window:
        return np.empty(0, np.int64)
    at = (np.arange(0, n, period)[:, None] + np.array(cover)[None, :]).ravel()
    return at[at <= n - anchor]


def position(k: Column, window: int) -> Column:
    period, cover, _ = cover_of(window)
    place = F.get(F.array(*[F.lit(c) for c in cover]), F.pmod(k, F.lit(len(cover))))
    return F.floor(k / len(cover)).cast("int") * period + place


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *[len(p) for p in parts]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], kind))


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    (i, t) = columns([id_col, text_col])
    return docs.select(row_id(docs.sparkSession).alias("row"), i.alias("id"), t.cast("string").cast("binary").alias("text"))


def scan(texts: DataFrame, window: int) -> DataFrame:
    """row, id, n (words), sha (of all words), anchors (hashes in cover order)."""
    anchor = cover_of(window)[2]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha, anchors = [], [], []
            for text in b.column(2).to_pylist():
                words = words_in(text)
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                at = cover_positions(len(words), window)
                anchors.append(hashes_at(word_hashes(words), at, anchor, 1).view(np.int64) if len(at) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha), list_array(anchors, pa.int64())],
                                             names=["row", "id", "n", "sha", "anchors"])

    return map_batches(texts, build, f"row long, id {dict(texts.dtypes)['id']}, n long, sha string, anchors array<long>")


def shared_anchors(words: DataFrame) -> DataFrame:
    """Places of anchors that two documents hold: h, first (smallest id), row, k, id, n."""
    known = words.where("id IS NOT NULL")
    per = known.select("id", F.explode("anchors").alias("h")).groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # A table of its own, so that the join's sides are plain shuffles and hot hashes are split.
    per = written(per.where("first < last").select(F.col("h").alias("s_h"), "first"), "shared-hashes")
    places = known.select("row", F.posexplode("anchors").alias("k", "h"))
    met = places.hint("merge").join(per, places["h"] == per["s_h"]).select("row", "k", "h", "first")
    info = words.select(F.col("row").alias("i_row"), "id", "n")
    return met.hint("merge").join(info, met["row"] == info["i_row"]).select("h", "first", "row", "k", "id", "n")


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def chains_in(n: int, at: np.ndarray, m_row: np.ndarray, m_at: np.ndarray, window: int):
    """Of one document's anchors that an earlier document shares (sorted by place):
    removed word ranges, ranges of windows still open, and for each anchor the
    steps back to the starts of open windows that hold it, as bits."""
    period, _, anchor = cover_of(window)
    gap = m_at - at
    joined = (m_row[1:] == m_row[:-1]) & (gap[1:] == gap[:-1]) & (at[1:] - at[:-1] <= anchor)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    s, e = at[first], at[last] + anchor
    whole = e - s >= window
    s, e = s[whole], e[whole]

    def marked(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:  # windows lo..hi, hi included
        d = np.zeros(n - window + 2, np.int64)
        np.add.at(d, np.clip(lo, 0, n - window + 1), 1)
        np.add.at(d, np.clip(hi + 1, 0, n - window + 1), -1)
        return np.cumsum(d[:-1]) > 0

    open_ = marked(at - period + 1, at) & ~marked(s, e - window)
    back = np.arange(period)
    start = at[:, None] - back[None, :]
    inside = (start >= 0) & (start < len(open_))
    mask = ((open_[np.where(inside, start, 0)] & inside) << back).sum(axis=1)
    return (s, e), runs(open_), mask


def span_array(parts: list[tuple[np.ndarray, np.ndarray]], names: list[str] | None = None) -> pa.Array:
    ends = np.cumsum([0, *[len(s) for s, _ in parts]])
    s, e = (pa.array(np.concatenate([p[i] for p in parts]) if parts else [], pa.int64()) for i in (0, 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([s, e], names=names or ["s", "e"]))


SPANS = "array<struct<s:long,e:long>>"


def chains(marked: DataFrame, window: int) -> DataFrame:
    """row, removed, open (window ranges), need (anchors of open windows: hash, steps back)."""
    small = written(marked.where("id = first").groupBy("h").agg(F.min(F.struct("row", "k")).alias("m")).withColumnRenamed("h", "m_h"), "first-places")
    late = marked.where("id > first")
    met = late.hint("merge").join(small, late["h"] == small["m_h"])
    item = F.struct(position(F.col("k"), window).cast("long").alias("at"), "h", F.col("m.row").alias("m_row"), position(F.col("m.k"), window).cast("long").alias("m_at"))
    per = met.groupBy("row", "n").agg(F.sort_array(F.collect_list(item)).alias("hits"))  # at most a text's own anchors

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts, opens, needs = [], [], []
            sizes = b.column(1).to_pylist()
            for n, hits in zip(sizes, b.column(2)):
                at, h, m_row, m_at = (x.to_numpy(zero_copy_only=False) for x in hits.values.flatten())
                cut, still, need = chains_in(n, at, m_row, m_at, window)
                cuts.append(cut), opens.append(still), needs.append((h[need > 0], need[need > 0]))
            yield pa.RecordBatch.from_arrays([b.column(0), span_array(cuts), span_array(opens), span_array(needs, ["h", "back"])], names=["row", "removed", "open", "need"])

    return map_batches(per.select("row", "n", "hits"), build, f"row long, removed {SPANS}, open {SPANS}, need array<struct<h:long,back:long>>")


def window_rows(asked: DataFrame, window: int) -> DataFrame:
    """Rows (row, id, i, h1, h2, query) of the windows that ``asked`` (row, id,
    text, ranges of (s, e, back)) names: the open ones, s to e, are marked ``query``;
    those at the steps back from s, as bits, are what they are compared with."""
    back = np.arange(cover_of(window)[0])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at_row, at, query, hashes = [], [], [], [[], []]
            for k, (text, ranges) in enumerate(zip(b.column(2).to_pylist(), b.column(3))):
                words = words_in(text)
                w, flags = word_hashes(words), np.zeros((2, len(words) - window + 1), bool)
                s, e, steps_back = (x.to_numpy(zero_copy_only=False) for x in ranges.values.flatten())
                around = (s[:, None] - back)[(steps_back[:, None] >> back) & 1 == 1]
                flags[0, around[(around >= 0) & (around < flags.shape[1])]] = True
                for lo, hi in zip(s[steps_back == 0].tolist(), e[steps_back == 0].tolist()):
                    flags[1, lo:hi] = True
                i = np.flatnonzero(flags.any(axis=0))
                at_row.append(np.full(len(i), k)), at.append(i), query.append(flags[1, i])
                for seed in (0, 1):
                    hashes[seed].append(hashes_at(mixed(w ^ _U(seed)), i, window, seed + 2).view(np.int64))
            if not at:
                continue
            take = pa.array(np.concatenate(at_row))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(np.concatenate(at), pa.int64()), *[pa.array(np.concatenate(x), pa.int64()) for x in hashes],
                 pa.array(np.concatenate(query))], names=["row", "id", "i", "h1", "h2", "query"])

    return map_batches(asked, build, f"row long, id {dict(asked.dtypes)['id']}, i long, h1 long, h2 long, query boolean")


def removed_words(texts: DataFrame, words: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(row, cuts) of every row that loses words, and the texts of rows that may."""
    marked = written(shared_anchors(words), "shared-anchors")
    linked = written(chains(marked, window), "anchor-chains")
    need = linked.select(F.explode("need").alias("x")).groupBy(F.col("x.h").alias("n_h")).agg(F.bit_or("x.back").alias("back"))
    need = written(need, "open-anchors")
    at = position(F.col("k"), window).cast("long")
    around = marked.hint("merge").join(need, marked["h"] == need["n_h"]).select("row", F.struct(at.alias("s"), at.alias("e"), "back").alias("r"))
    open_ = linked.select("row", F.explode("open").alias("o")).select("row", F.struct("o.s", "o.e", F.lit(0).cast("long").alias("back")).alias("r"))
    ranges = written(around.unionByName(open_).groupBy("row").agg(F.collect_set("r").alias("ranges")).withColumnRenamed("row", "r_row"), "window-ranges")
    seen = written(ranges.select("r_row").union(linked.where("size(removed) > 0").select("row")).distinct(), "touched-rows")
    # Rows with passages in common are a share of all rows: never a side to broadcast.
    touched = written(texts.hint("merge").join(seen, texts["row"] == seen["r_row"], "left_semi"), "touched-texts")
    asked = touched.hint("merge").join(ranges, touched["row"] == ranges["r_row"]).select("row", "id", "text", "ranges")
    found = written(window_rows(asked, window), "end-windows")
    first = found.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    first = written(first.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first"), "first-windows")
    q = found.where("query").hint("merge")
    hits = q.join(first, (q["h1"] == first["f1"]) & (q["h2"] == first["f2"])).where("first < id").select(
        "row", F.struct(F.col("i").alias("s"), (F.col("i") + window).alias("e")).alias("c"))
    all_cuts = hits.unionByName(linked.select("row", F.explode("removed").alias("c")))
    return written(all_cuts.groupBy("row").agg(F.sort_array(F.collect_list("c")).alias("cuts")).withColumnRenamed("row", "c_row"), "removed-words"), touched


def kept_mask(n: int, cuts: pa.Array) -> np.ndarray:
    d = np.zeros(n + 1, np.int64)
    s, e = (x.to_numpy(zero_copy_only=False) for x in cuts.flatten())
    np.add.at(d, s, 1), np.add.at(d, e, -1)
    return np.cumsum(d[:-1]) == 0


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: row, ``id_col``, n_words, n_removed, kept_sha256 (of
    the words that stay, joined by one space) and removed (ranges of word numbers
    that are cut, from 0, ends excluded)."""
    texts = texts_of(docs, id_col, text_col)
    words = written(scan(texts, window), "anchors")
    cuts, touched = removed_words(texts, words, window)
    rows = touched.hint("merge").join(cuts, touched["row"] == cuts["c_row"]).select("row", "text", "cuts")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone, sha, spans = [], [], []
            for text, cut in zip(b.column(1).to_pylist(), b.column(2)):
                words = words_in(text)
                stays = kept_mask(len(words), cut.values)
                gone.append(int((~stays).sum())), spans.append(runs(~stays))
                sha.append(hashlib.sha256(b" ".join([w for w, ok in zip(words, stays.tolist()) if ok])).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gone, pa.int64()), pa.array(sha), span_array(spans)], names=["c_row", "gone", "left_sha", "spans"])

    cut = map_batches(rows, build, f"c_row long, gone long, left_sha string, spans {SPANS}")
    all_rows = words.select("row", "id", "n", "sha")
    out = all_rows.hint("merge").join(cut, all_rows["row"] == cut["c_row"], "left")
    return out.select("row", F.col("id").alias(id_col), F.col("n").alias("n_words"), F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("left_sha", "sha").alias("kept_sha256"), F.coalesce("spans", F.array().cast(SPANS)).alias("removed"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut from ``text_col``: texts that
    lose words hold the rest joined by one space, all others are unchanged."""
    number, spans, key = fresh("row_number_", docs.columns), fresh("cut_ranges_", docs.columns), fresh("cut_row_", docs.columns)
    cut = find_repeats(docs, id_col, text_col, window).where("n_removed > 0").select(F.col("row").alias(key), F.col("removed").alias(spans))
    numbered = docs.withColumn(number, row_id(docs.sparkSession))
    cut = written(cut, "cut-ranges")
    joined = numbered.join(cut, numbered[number] == cut[key], "left")
    (text,) = columns([text_col])
    # What lies between two cut ranges stays.
    words = words_of(text)
    stays = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col(spans)["e"]).alias("s"), F.concat(F.col(spans)["s"], F.array(F.size(words).cast("long"))).alias("e"))
    left = F.flatten(F.transform(stays, lambda g: F.slice(words, (g["s"] + 1).cast("int"), (g["e"] - g["s"]).cast("int"))))
    changed = F.when(F.col(spans).isNotNull(), F.array_join(left, " ")).otherwise(text)
    return joined.withColumn(text_col, changed).select(*columns(docs.columns))
