"""Source divergence audit by a three-dimensional cube of cells.

How far the term shares of the sources of a language lie apart, and which terms
set a source off from its language.

1. *Counts.* Tasks count terms per (lang, source) and send on partial counts; a
   term is kept in a language when at least ``MIN_DOCS`` of its documents hold it.
2. *Shares.* Each kept term has p = 1 + floor(10^9 (count + 5) / (N + 5 V)) in
   each group and language, in whole numbers of up to 38 digits.
3. *Cube.* Groups of a language are dealt to blocks of about ``GROUP_BLOCK``, kept
   terms to blocks of about ``TERM_BLOCK``. A cell (group block, group block, term
   block) gets the two blocks' slices of that term block, replicated to every cell
   that needs them, and sums |p - q| over its terms for its pairs of groups;
   terms that occur in none of a cell's groups enter by their number. A pair has
   the same first group in every term block: the one of the smaller group block,
   within a block the smaller source (rows arrive in any order).
4. *Reduction.* The partial sums are added along the term axis.

A slice holds a group's occurring terms of one block only, so no task ever holds a
language's vocabulary or all of a group; a hot group is as many slices as any
other with its vocabulary. The number of pairs is the contract's own: all sources
of a language with all others.

Defined cases: null text, lang and source read as ''; texts without terms still
make their group known; a language without kept terms has divergence 0 between
all its sources and no telling terms; repeated rows count each time; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, map_batches, ship_package, term_bytes, written

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
GROUP_BLOCK = 64
TERM_BLOCK = 4096
HELD_TERMS = 300_000


def group_columns(docs: DataFrame, names: list[str]) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("")) for c in columns(names)]


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term (bytes), n (occurrences), docs (documents holding it)."""
    lang, source = group_columns(docs, [lang_col, source_col])
    (text,) = columns([text_col])
    src = docs.select(lang.alias("lang"), source.alias("source"), text.cast("string").cast("binary").alias("text"))
    table = term_bytes(digits=False)

    def batch(held: dict) -> pa.RecordBatch:
        keys = list(held)
        per = [held[k] for k in keys]
        sizes = [len(x) for x in per]
        at = pa.array(np.repeat(np.arange(len(keys)), sizes))
        lang, source = (pa.array([k[i] for k in keys], pa.string()).take(at) for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [lang, source, pa.array([t for x in per for t in x], pa.binary()), pa.array([v[0] for x in per for v in x.values()], pa.int64()),
             pa.array([v[1] for x in per for v in x.values()], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(dict)
        size = 0
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
                mine, one = held[lang, source], defaultdict(int)
                for t in (text or b"").translate(table).split():
                    one[t] += 1
                for t, n in one.items():
                    if t in mine:
                        v = mine[t]
                        v[0] += n
                        v[1] += 1
                    else:
                        mine[t] = [n, 1]
                        size += 1
                if size > HELD_TERMS:
                    yield batch(held)
                    held, size = defaultdict(dict), 0
        if size:
            yield batch(held)

    part = map_batches(src, count, "lang string, source string, term binary, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + 5) / (total + 5 terms)), exact; null without terms."""
    top = (n.cast("decimal(19,0)") + SMOOTHING) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(18,0)") + terms.cast("decimal(18,0)") * SMOOTHING
    return F.when(terms > 0, F.call_function("div", top, F.when(terms > 0, below)) + 1)


def blocks_for(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


class Audit:
    """The stored tables of one audit: ``groups`` (lang, source, gb, gbs, terms,
    base: the share of a term that does not occur), ``blocks`` (lang, tb, size) and
    ``shares`` (lang, source, term, no, tb, p, q)."""

    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_docs: int, group_block: int, term_block: int):
        counts = written(term_counts(docs, text_col, lang_col, source_col), "term-counts")
        lang, source = group_columns(docs, [lang_col, source_col])
        groups = written(docs.select(lang.alias("lang"), source.alias("source")).distinct(), "source-groups")
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("l_n")).where(F.col("docs") >= min_docs)
        kept = written(kept.select("lang", "term", "l_n", F.monotonically_increasing_id().alias("no")), "kept-terms")
        sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("l_n").alias("l_total")).withColumnRenamed("lang", "s_lang")
        langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        langs = written(langs.join(sizes, langs["lang"] == sizes["s_lang"], "left").select(
            F.col("lang").alias("m_lang"), F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("l_total", F.lit(0)).alias("l_total"),
            blocks_for(F.col("sources"), group_block).alias("gbs"), blocks_for(F.coalesce("terms", F.lit(0)), term_block).alias("tbs")), "languages")
        at = kept.join(langs, kept["lang"] == langs["m_lang"]).select(
            F.col("lang").alias("k_lang"), F.col("term").alias("k_term"), "no", F.pmod(F.xxhash64("term"), "tbs").cast("int").alias("tb"),
            share(F.col("l_n"), F.col("l_total"), F.col("terms")).alias("q"))
        found = written(counts.join(at, (counts["lang"] == at["k_lang"]) & (counts["term"] == at["k_term"])).select("lang", "source", "term", "no", "tb", "n", "q"), "kept-counts")
        totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total")).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
        g = groups.join(langs, groups["lang"] == langs["m_lang"]).join(totals, (groups["lang"] == totals["t_lang"]) & (groups["source"] == totals["t_source"]), "left")
        total = F.coalesce("total", F.lit(0))
        self.groups = written(g.select("lang", "source", F.pmod(F.xxhash64("source"), "gbs").cast("int").alias("gb"), "gbs", "terms", total.alias("total"),
                                       share(F.lit(0), total, F.col("terms")).alias("base")), "audit-groups")
        # Every block of a language, also one without terms.
        every = langs.select(F.col("m_lang").alias("lang"), F.explode(F.sequence(F.lit(0), F.col("tbs") - 1)).alias("tb"))
        held = found.select("lang", "tb", "no").distinct().groupBy("lang", "tb").agg(F.count(F.lit(1)).alias("size")).withColumnsRenamed({"lang": "h_lang", "tb": "h_tb"})
        self.blocks = written(every.join(held, (every["lang"] == held["h_lang"]) & (every["tb"] == held["h_tb"]), "left").select(
            F.col("lang").alias("b_lang"), "tb", F.coalesce("size", F.lit(0)).alias("size")), "term-blocks")
        of = self.groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "terms", "total")
        self.shares = written(found.join(of, (found["lang"] == of["g_lang"]) & (found["source"] == of["g_source"])).select(
            "lang", "source", "term", "no", "tb", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "q"), "term-shares")


def cell_sums(table: pa.Table) -> pa.Table:
    """One cell: rows (lang, source, gb, a, b, size, base, numbers, shares) of its
    groups; sums of |p - q| over the cell's terms for every pair of its groups."""
    table = table.sort_by("source")
    gb, a, b = table["gb"].to_numpy(), table["a"][0].as_py(), table["b"][0].as_py()
    base, size = table["base"].fill_null(0).to_numpy(), table["size"][0].as_py()
    numbers = [np.asarray(x or [], np.int64) for x in table["numbers"].to_pylist()]
    shares = [np.asarray(x or [], np.int64) for x in table["shares"].to_pylist()]
    seen, place = np.unique(np.concatenate(numbers), return_inverse=True)
    p = np.repeat(base[:, None], len(seen), axis=1)
    ends = np.cumsum([len(x) for x in numbers])
    for i, (end, mine) in enumerate(zip(ends, shares)):
        p[i, place[end - len(mine):end]] = mine
    left, right = np.flatnonzero(gb == a), np.flatnonzero(gb == b)
    u, v, f = [], [], []
    for i in left:
        other = right[right > i] if a == b else right
        u.append(np.full(len(other), i)), v.append(other)
        f.append(np.abs(p[other] - p[i]).sum(axis=1) + (size - len(seen)) * np.abs(base[other] - base[i]))
    u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (u, v))
    source = table["source"]
    return pa.table({"lang": table["lang"].take(pa.array(np.zeros(len(u), np.int64))), "source": source.take(pa.array(u)), "item": source.take(pa.array(v)),
                     "part_sum": pa.array(np.concatenate(f) if f else [], pa.int64())})


def source_pairs(audit: Audit) -> DataFrame:
    """lang, source, item, value: the divergence of every two sources, both ways."""
    ship_package(audit.groups.sparkSession)
    g, blocks = audit.groups, audit.blocks
    heads = g.join(blocks, g["lang"] == blocks["b_lang"]).select("lang", "source", "gb", "gbs", "base", "tb", "size")
    slices = audit.shares.groupBy("lang", "source", "tb").agg(F.collect_list(F.struct("no", "p")).alias("slice")).withColumnsRenamed({"lang": "c_lang", "source": "c_source", "tb": "c_tb"})  # a block's terms at most
    rows = heads.join(slices, (heads["lang"] == slices["c_lang"]) & (heads["source"] == slices["c_source"]) & (heads["tb"] == slices["c_tb"]), "left")
    cells = rows.select("lang", "source", "gb", "tb", "size", "base", F.col("slice.no").alias("numbers"), F.col("slice.p").alias("shares"),
                        F.explode(F.sequence(F.lit(0), F.col("gbs") - 1)).alias("other"))
    cells = cells.select("lang", F.least("gb", "other").alias("a"), F.greatest("gb", "other").alias("b"), "tb", "source", "gb", "size", "base", "numbers", "shares")
    sums = cells.groupBy("lang", "a", "b", "tb").applyInArrow(cell_sums, "lang string, source string, item string, part_sum long")
    one = sums.groupBy("lang", "source", "item").agg(F.sum("part_sum").alias("value"))
    return one.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"), "value").select("lang", "x.*", "value")


def ranked(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.select("*", F.row_number().over(w).alias("rank"))


def telling_terms(audit: Audit, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item (term), value, rank: the ``top`` terms that a source has
    in a larger share than its language."""
    over = audit.shares.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(over).where(F.col("rank") <= top)


def divergence_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
                     group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    audit = Audit(docs, text_col, lang_col, source_col, min_docs, group_block, term_block)
    pairs = written(source_pairs(audit), "source-pairs")
    parts = [("pair", ranked(pairs)), ("term", telling_terms(audit))]
    frames = [f.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")) for name, f in parts]
    return frames[0].unionByName(frames[1])
