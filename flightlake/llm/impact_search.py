"""Ranked lexical search by dense blocked multiplication.

Scores are sums of (item term weight) x (document term impact), all whole numbers:

* w = floor(1000 ln((2 N + 2) / (2 df + 1))) for each term of the items,
* impact = (10^9 tf) div (1000 tf + 8 m), with m = 25 + (75 n N) div L,

where N counts the documents with a term, L all their terms, n one document's.

1. *Document terms.* One scan counts each document's terms and keeps those that an
   item uses, as numbers of the items' vocabulary. The vocabulary goes to the
   tasks when it is below ``VOCABULARY_BYTES``, else the terms are joined with it.
2. *Tiles.* Items are dealt to tiles of bounded size, documents to blocks of bounded
   size; each (tile, block) is one task's work. A tile's terms are its compact
   vocabulary; a block's documents are taken ``DOC_TILE`` at a time.
3. *Multiplication.* Items x terms times terms x documents runs in float64 over
   vocabulary tiles cut so that no partial sum reaches 2^53; every partial
   product is therefore exact, and the tiles are added as 64-bit integers.
4. *Top k.* Each tile keeps an item's best k and whatever ties with the k-th until
   ids decide; partial limits run before each shuffle.

Defined cases: null and blank texts have no terms and are never found; an item
without terms finds nothing; repeated items are ranked each for itself, repeated
documents each take a place; equal scores go by ascending id, a null id first,
then by row; empty tables give an empty result; other columns are not read.
Both tables have to be stored: their scans have to number rows alike each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.topk import first_n_per_group
from .common import columns, map_batches, row_id, ship_package, term_bytes, written

K = 10
VOCABULARY_BYTES = 32 << 20
TILE_ITEMS, TILE_TERMS = 256, 16_384
BLOCK_DOCS, BLOCK_TERMS = 4096, 1_000_000
VOCAB_TILE, DOC_TILE = 1024, 1024
MAX_IMPACT = 1_000_000  # (10^9 tf) div (1000 tf + 8 m) lies below it
EXACT = 1 << 53


def rows_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    i, t = columns([id_col, text_col])
    return df.select(row_id(df.sparkSession).alias("row"), i.alias("id"), t.cast("string").cast("binary").alias("text"))


def terms_in(text: bytes | None, table: bytes = term_bytes(digits=True)) -> list[bytes]:
    return (text or b"").translate(table).split()


def counted(values: list, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
    """A list column of the given lists, and their total length."""
    ends = np.cumsum([0, *[len(v) for v in values]])
    flat = np.concatenate(values) if len(values) and pa.types.is_integer(kind) else [x for v in values for x in v]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def item_terms(items: DataFrame) -> DataFrame:
    """item, item_id, term, qtf: a row per distinct term of an item."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, term, n = [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                count: dict = {}
                for t in terms_in(text):
                    count[t] = count.get(t, 0) + 1
                at += [i] * len(count)
                term += count
                n += count.values()
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(term, pa.binary()), pa.array(n, pa.int64())], names=["item", "item_id", "term", "qtf"])
    return map_batches(items, build, f"item long, item_id {dict(items.dtypes)['id']}, term binary, qtf long")


def document_terms(docs: DataFrame, vocabulary: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(row, n) of all documents, and (row, id, n, numbers, tfs) of those with item terms."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["id"]
    size = vocabulary.agg(F.coalesce(F.sum(F.length("term") + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    if size <= limit:
        ship_package(spark)
        shared = spark.sparkContext.broadcast({bytes(r.term): r.no for r in vocabulary.collect()})

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for b in batches:
                n, numbers, tfs = [], [], []
                for text in b.column(2).to_pylist():
                    terms = terms_in(text)
                    no, tf = np.unique(np.array([known[t] for t in terms if t in known], np.int64), return_counts=True)
                    n.append(len(terms)), numbers.append(no), tfs.append(tf)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), counted(numbers, pa.int64()), counted(tfs, pa.int64())],
                                                 names=["row", "id", "n", "numbers", "tfs"])

        both = written(map_batches(docs, build, f"row long, id {kind}, n long, numbers array<long>, tfs array<long>"), "document-terms")
        return both.select("row", "n"), both.where("size(numbers) > 0")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, terms, tfs = [], [], []
            for text in b.column(2).to_pylist():
                count: dict = {}
                for t in terms_in(text):
                    count[t] = count.get(t, 0) + 1
                n.append(sum(count.values())), terms.append(list(count)), tfs.append(np.array(list(count.values()), np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), counted(terms, pa.binary()), counted(tfs, pa.int64())],
                                             names=["row", "id", "n", "terms", "tfs"])

    both = written(map_batches(docs, split, f"row long, id {kind}, n long, terms array<binary>, tfs array<long>"), "all-terms")
    single = both.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", "id", "n", F.col("x.terms").alias("d_term"), F.col("x.tfs").alias("tf"))
    met = single.join(vocabulary, single["d_term"] == vocabulary["term"]).groupBy("row", "id", "n").agg(F.collect_list(F.struct("no", "tf")).alias("x"))  # a text's own terms
    return both.select("row", "n"), written(met.select("row", "id", "n", F.col("x.no").alias("numbers"), F.col("x.tf").alias("tfs")), "document-terms")


def vocabulary_tiles(item: np.ndarray, col: np.ndarray, weight: np.ndarray, n_items: int, n_cols: int) -> list[tuple[int, int, np.ndarray]]:
    """(first column, end, items x columns) tiles of the weights, cut so that a row's
    sum times ``MAX_IMPACT`` stays below 2^53; a column that alone does not is an
    integer tile."""
    tiles, lo = [], 0
    order = np.argsort(col, kind="stable")
    item, col, weight = item[order], col[order], weight[order]
    while lo < n_cols:
        hi = min(lo + VOCAB_TILE, n_cols)
        a, b = np.searchsorted(col, [lo, hi])
        q = np.zeros((n_items, hi - lo), np.int64)
        np.add.at(q, (item[a:b], col[a:b] - lo), weight[a:b])
        fits = int((np.cumsum(q, axis=1).max(axis=0) * float(MAX_IMPACT) < EXACT).sum())
        if fits == 0:
            tiles.append((lo, lo + 1, q[:, :1]))
        else:
            tiles.append((lo, lo + fits, q[:, :fits].astype(np.float64)))
        lo += max(fits, 1)
    return tiles


def impacts(tf: np.ndarray, n: np.ndarray, owner: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[owner])


def block_top(items: pa.Table, docs: pa.Table, n_docs: int, n_terms: int, k: int) -> pa.Table:
    """The best k of a block's documents for each item of a tile: item, item_id, id, row, score."""
    empty = pa.table({"item": pa.array([], pa.int64()), "item_id": items["item_id"].slice(0, 0), "id": docs["id"].slice(0, 0),
                      "row": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    if not items.num_rows or not docs.num_rows:
        return empty
    vocab, col = np.unique(np.concatenate([np.asarray(x, np.int64) for x in items["numbers"].to_pylist()]), return_inverse=True)
    weight = np.concatenate([np.asarray(x, np.int64) for x in items["weights"].to_pylist()])
    item = np.repeat(np.arange(items.num_rows), pc.list_value_length(items["numbers"]).to_numpy())
    tiles = vocabulary_tiles(item, col, weight, items.num_rows, len(vocab))
    # Documents in the order that decides ties, so that a place stands for (id, row).
    docs = docs.take(pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_start"))
    number = np.concatenate([np.asarray(x, np.int64) for x in docs["numbers"].to_pylist()])
    tf = np.concatenate([np.asarray(x, np.int64) for x in docs["tfs"].to_pylist()])
    owner = np.repeat(np.arange(docs.num_rows), pc.list_value_length(docs["numbers"]).to_numpy())
    at = np.minimum(np.searchsorted(vocab, number), len(vocab) - 1)
    used = vocab[at] == number
    at, tf, owner = at[used], tf[used], owner[used]
    value = impacts(tf, docs["n"].to_numpy(), owner, n_docs, n_terms)
    best: list[list[np.ndarray]] = [[], [], []]
    for first in range(0, docs.num_rows, DOC_TILE):
        a, b = np.searchsorted(owner, [first, first + DOC_TILE])
        order = np.argsort(at[a:b], kind="stable")
        c, d, v = at[a:b][order], owner[a:b][order] - first, value[a:b][order]
        width = min(DOC_TILE, docs.num_rows - first)
        score = np.zeros((items.num_rows, width), np.int64)
        for lo, hi, q in tiles:
            x, y = np.searchsorted(c, [lo, hi])
            if x == y:
                continue
            tile = np.zeros((hi - lo, width), q.dtype)
            tile[c[x:y] - lo, d[x:y]] = v[x:y]
            score += (q @ tile).astype(np.int64)
        floor = np.ones(items.num_rows, np.int64)
        if width > k:
            floor = np.maximum(floor, np.partition(score, width - k, axis=1)[:, width - k])
        i, j = np.nonzero(score >= floor[:, None])
        s = score[i, j]
        for held, new in zip(best, top_of(i, j + first, s, k)):
            held.append(new)
    i, j, s = top_of(*[np.concatenate(x) for x in best], k)
    i, j = pa.array(i), pa.array(j)
    return pa.table({"item": items["item"].take(i), "item_id": items["item_id"].take(i), "id": docs["id"].take(j), "row": docs["row"].take(j), "score": pa.array(s, pa.int64())})


def top_of(item: np.ndarray, place: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k of each item by falling score, then by place."""
    order = np.lexsort((place, -score, item))
    item, place, score = item[order], place[order], score[order]
    if not len(item):
        return item, place, score
    start = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    nth = np.arange(len(item)) - np.repeat(start, np.diff(np.concatenate([start, [len(item)]])))
    return item[nth < k], place[nth < k], score[nth < k]


def parts(rows: int, per: int, entries: int, per_entries: int) -> int:
    return max(1, -(-rows // per), -(-entries // per_entries))


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           vocabulary_bytes: int = VOCABULARY_BYTES, tile_items: int = TILE_ITEMS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item (row number), ``item_col``, rank (from 1), ``id_col``, row, score of each
    item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    asked = written(item_terms(rows_of(items, item_col, item_text_col)), "item-terms")
    vocabulary = written(asked.select("term").distinct().select("term", F.monotonically_increasing_id().alias("no")), "item-vocabulary")
    lengths, held = document_terms(rows_of(docs, id_col, text_col), vocabulary, vocabulary_bytes)
    total = lengths.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
    n_docs, n_terms = int(total["n_docs"]), int(total["n_terms"])
    df = held.select(F.explode("numbers").alias("d_no")).groupBy("d_no").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)) * 1000).cast("long")
    weights = vocabulary.join(df, vocabulary["no"] == df["d_no"]).select(F.col("term").alias("w_term"), "no", weight.alias("w"))
    weighed = asked.join(weights, asked["term"] == weights["w_term"]).groupBy("item", "item_id").agg(F.collect_list(F.struct("no", (F.col("qtf") * F.col("w")).alias("w"))).alias("x"))  # an item's own terms
    weighed = written(weighed.select("item", "item_id", F.col("x.no").alias("numbers"), F.col("x.w").alias("weights")), "weighed-items")

    of_items = weighed.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("numbers")), F.lit(0)).alias("entries")).first()
    of_docs = held.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("numbers")), F.lit(0)).alias("entries")).first()
    tiles = parts(of_items["rows"], tile_items, of_items["entries"], TILE_TERMS)
    blocks = parts(of_docs["rows"], block_docs, of_docs["entries"], BLOCK_TERMS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = weighed.withColumn("tile", F.pmod(F.xxhash64("item"), F.lit(tiles)).cast("int")).withColumn("block", every(blocks))
    right = held.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("tile", every(tiles))
    ship_package(spark)

    def tops(items_: pa.Table, docs_: pa.Table) -> pa.Table:
        return block_top(items_, docs_, n_docs, n_terms, k)

    kinds = dict(weighed.dtypes)["item_id"], dict(held.dtypes)["id"]
    found = left.groupBy("tile", "block").cogroup(right.groupBy("tile", "block")).applyInArrow(tops, f"item long, item_id {kinds[0]}, id {kinds[1]}, row long, score long")
    found = written(found.select("item", "item_id", (-F.col("score")).alias("minus"), "id", "row"), "block-tops")
    best = first_n_per_group(found, ["item"], k, ["minus", "id", "row"])
    rank = F.row_number().over(Window.partitionBy("item").orderBy("minus", "id", "row"))
    return best.select("item", F.col("item_id").alias(item_col), rank.cast("int").alias("rank"), F.col("id").alias(id_col), "row", (-F.col("minus")).alias("score"))
