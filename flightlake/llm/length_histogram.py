"""Token counts: an exact histogram of encoded lengths with suffix sums.

Documents are encoded once and only their lengths are kept. The histogram has
one row per group and distinct length, so the group-by reduces map-side and
the rest of the work depends on the number of distinct lengths, not on the
number of documents. Suffix sums (documents and tokens of at least a length)
answer, for every context limit, how many tokens remain after truncation, how
many documents are cut, and any quantile — exactly.

The sums run in two levels: lengths are cut into ranges of ``RANGE`` tokens, a
window sums inside each range, and the ranges' totals (longest text / RANGE of
them) are summed apart, so no task gets more than ``RANGE`` rows of a group.

Defined cases: a null text counts as empty and has length 0; null group values
form a group of their own; repeated rows count as often as they occur; an empty
table gives an empty histogram; very long texts are encoded in parts cut where
the pre-tokeniser always cuts (a blank after a non-blank), which changes no
length. Other columns are not read, and the group column may have any name: inside,
it is ``group_key``, and names that the results add take underscores at the end
where it has one of them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fresh, map_batches, written

RANGE = 1024
PART_CHARS = 100_000
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
# Columns of the results beside the group.
RESULT = ("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "docs_total", "tokens_total", "context_limit",
          "docs_cut", "tokens_kept", "docs_within", "p", "quantile_group", *QUANTILES)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("lengths", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``size``, cut only between a non-blank and a blank."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def length_of(text: str | None, path: str) -> int:
    encode = encoder(path).encode_ordinary
    return sum(len(encode(p)) for p in parts(text or ""))


def encoded_lengths(docs: DataFrame, keep: list[str], text_col: str = "text", tokenizer: str | None = None, out: str = "n_tokens") -> DataFrame:
    """``keep`` columns and ``n_tokens`` (the last column) of every document."""
    path = tokenizer or default_tokenizer()
    out, text = fresh(out, keep), fresh("encoded_text", keep)
    src = docs.select(*columns(keep), columns([text_col])[0].cast("string").alias(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = pa.array([length_of(t, path) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lengths], names=[*b.schema.names[:-1], out])

    return map_batches(src, count, T.StructType([*src.schema.fields[:-1], T.StructField(out, T.LongType())]))


def histogram(lengths: DataFrame, group: str) -> DataFrame:
    """``group``, ``n_tokens``, ``n_docs``: partial counts meet once per key."""
    return lengths.groupBy(group, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame, group: str) -> DataFrame:
    """Adds ``docs_at_least``, ``tokens_at_least``, ``docs_total``, ``tokens_total``."""
    h = hist.withColumn("__range", F.floor(F.col("n_tokens") / RANGE)).withColumn("__tokens", F.col("n_tokens") * F.col("n_docs"))
    totals = h.groupBy(group, "__range").agg(F.sum("n_docs").alias("__d"), F.sum("__tokens").alias("__t"))
    later = Window.partitionBy(group).orderBy(F.col("__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy(group)
    totals = totals.select(
        F.col(group).alias("__g"), F.col("__range").alias("__r"),
        F.coalesce(F.sum("__d").over(later), F.lit(0)).alias("__later_d"),
        F.coalesce(F.sum("__t").over(later), F.lit(0)).alias("__later_t"),
        F.sum("__d").over(all_of).alias("docs_total"), F.sum("__t").over(all_of).alias("tokens_total"))
    inside = Window.partitionBy(group, "__range").orderBy(F.col("n_tokens").desc())
    return (h.withColumn("__in_d", F.sum("n_docs").over(inside)).withColumn("__in_t", F.sum("__tokens").over(inside))
            .join(totals, h[group].eqNullSafe(totals["__g"]) & (h["__range"] == totals["__r"]))
            .select(group, "n_tokens", "n_docs",
                    (F.col("__in_d") + F.col("__later_d")).alias("docs_at_least"),
                    (F.col("__in_t") + F.col("__later_t")).alias("tokens_at_least"),
                    "docs_total", "tokens_total"))


def truncated_total(limit: Column) -> Column:
    """Tokens left when every text is cut at ``limit``, on the row of the
    smallest length of at least ``limit``."""
    return F.col("tokens_total") - F.col("tokens_at_least") + limit * F.col("docs_at_least")


def limit_table(sums: DataFrame, group: str) -> DataFrame:
    """Answers at every distinct length taken as the context limit. Between two
    of them ``tokens_kept`` is linear, so this is the answer for every limit."""
    return sums.select(
        *columns([group]), F.col("n_tokens").alias("context_limit"), "n_docs",
        (F.col("docs_at_least") - F.col("n_docs")).alias("docs_cut"),
        truncated_total(F.col("n_tokens")).alias("tokens_kept"),
        (F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_within"),
        "docs_total", "tokens_total")


def at_limits(sums: DataFrame, group: str, limits: list[int]) -> DataFrame:
    """Tokens kept and documents cut for a stated list of limits."""
    grid = sums.select(*columns([group]), "docs_total", "tokens_total", "n_tokens", "docs_at_least", "tokens_at_least", "n_docs",
                       F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context_limit"))
    reach = F.col("n_tokens") >= F.col("context_limit")
    first = F.min(F.when(reach, F.struct("n_tokens", "docs_at_least", "tokens_at_least", "n_docs")))
    g = grid.groupBy(*columns([group]), "context_limit").agg(first.alias("f"), F.max("docs_total").alias("docs_total"),
                                                 F.max("tokens_total").alias("tokens_total"))
    docs, tokens = F.coalesce("f.docs_at_least", F.lit(0)), F.coalesce("f.tokens_at_least", F.lit(0))
    exact = F.when(F.col("f.n_tokens") == F.col("context_limit"), F.col("f.n_docs")).otherwise(0)
    return g.select(*columns([group]), "context_limit", (docs - exact).alias("docs_cut"),
                    (F.col("tokens_total") - tokens + F.col("context_limit") * docs).alias("tokens_kept"))


def quantiles(sums: DataFrame, group: str, probs: list[float]) -> DataFrame:
    """The smallest length that at least a share ``p`` of the documents do not exceed."""
    within = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
    grid = sums.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    return grid.where(within >= F.ceil(F.col("p") * F.col("docs_total"))).groupBy(*columns([group]), "p").agg(F.min("n_tokens").alias("n_tokens"))


def quantile_columns(hist: DataFrame, group: str, probs: dict[str, float]) -> DataFrame:
    """One row per group: for each name the exact quantile of its lengths."""
    found = quantiles(hist, group, list(probs.values()))
    return found.groupBy(*columns([group])).agg(*[F.max(F.when(F.col("p") == p, F.col("n_tokens"))).alias(name) for name, p in probs.items()])


def with_quantiles(sums: DataFrame, group: str, probs: dict[str, float] = QUANTILES) -> DataFrame:
    """The limit table with the group's exact quantiles in every row."""
    table = limit_table(sums, group)
    q = quantile_columns(sums, group, probs).withColumnRenamed(group, "quantile_group")
    return table.join(q, columns([group])[0].eqNullSafe(F.col("quantile_group")), "left").drop("quantile_group")


def token_histogram(docs: DataFrame, group: str = "source", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Encode, count and sum; the histogram is written once, being read three times.
    The group is the first column; it keeps its name unless a result column has it."""
    keyed = docs.select(columns([group])[0].alias("group_key"), columns([text_col])[0].alias("group_text"))
    lengths = encoded_lengths(keyed, ["group_key"], "group_text", tokenizer)
    sums = suffix_sums(written(histogram(lengths, "group_key"), "length-histogram"), "group_key")
    return sums.withColumnRenamed("group_key", fresh(group, RESULT))
