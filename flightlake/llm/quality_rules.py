"""Quality rules with thresholds learnt per language and source.

Each document gets integer metrics (built-in expressions only). Per language,
source and metric a quantile sketch is kept: a histogram over values rounded
down to ``SKETCH_BITS`` significant bits, so every quantile is right to a part
in 2^(bits-1). Sketches merge by adding counts: partial aggregation builds
them map-side, the language's sketch is the sum of its sources', and the
result depends on no order or partitioning. A rule's threshold is a robust
upper fence, ``q75 + 3 * (q75 - q50) + slack``, of its own group, kept within
half and twice the language's fence so that a source full of junk (or a tiny
one) cannot set its own law. Documents are then joined with their group's
thresholds and filtered.

A group's sketch has at most some thousand rows, whatever the group's size, so
a source with a third of all rows costs no more than any other; the threshold
table has one row per language and source and Spark broadcasts it only when
its measured size allows, else the join's hot keys are split at run time.

Defined cases: a null text has no words and fails; null languages and sources
are groups of their own; repeated rows get equal verdicts; an empty table gives
an empty result; metric columns are added under one struct, which takes
underscores at the end of its name where an input column has that name, so
input columns of any name stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, fresh, let, null_safe, words_of, written

# Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = r"[#*$%&|<>]"

SKETCH_BITS = 7
# What a rate (per mille) may exceed the fence by before a text is rejected.
SLACK = {"symbols": 100, "dup_lines": 400, "repeats": 300, "stutter": 200, "capitals": 150}
RULES = tuple(SLACK)


def repeat_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Words inside windows of ``size`` words found twice or more in the text.

    Windows are compared by hash. Most texts have no repeated one, so places
    are only sorted where the distinct hashes are fewer. A sorted list of the
    repeated windows' starts then covers min(size, gap to the next) words each.
    """
    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, i: F.least(F.lit(size), F.coalesce(F.get(starts, i + 1) - s, F.lit(size))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(placed: Column) -> Column:
        return F.filter(placed, lambda p, i: (F.get(placed, i - 1)["h"] == p["h"]) | (F.get(placed, i + 1)["h"] == p["h"]))

    def count(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(placed, lambda p: F.array_sort(F.transform(repeated(p), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(starts, covered))

    def hashed(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (size - 1)), lambda i: F.xxhash64(F.slice(h, i, size)))

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), hashed)
    return F.when(F.size(words) < size, F.lit(0)).otherwise(let(hashes, count)).cast("long")


def with_metrics(docs: DataFrame, text_col: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with the struct ``out`` of counts and per-mille rates."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def dup_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"))

    def stutter(w: Column) -> Column:
        return F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))

    def measure(w: Column) -> Column:
        lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), dup_lines)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.alias("lines"),
            repeat_words(w).alias("n_repeat_words"),
            stutter(w).cast("long").alias("n_stutter"),
            (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long").alias("n_capitals"))

    m = let(words_of(F.col(text_col).cast("string")), measure)

    def rate(x: Column, per: Column) -> Column:
        return F.when(per > 0, F.floor(x * 1000 / per)).otherwise(0).cast("long")

    def rates(x: Column) -> Column:
        n = x["n_words"]
        return F.struct(
            n.alias("n_words"), x["word_chars"].alias("word_chars"), x["n_symbols"].alias("n_symbols"),
            x["lines"]["dup"].cast("long").alias("n_dup_lines"), x["n_repeat_words"].alias("n_repeat_words"),
            ((n < MIN_WORDS) | (100 * x["n_repeat_words"] > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
            rate(x["n_symbols"], n).alias("symbols"), rate(x["lines"]["dup"].cast("long"), x["lines"]["n"].cast("long")).alias("dup_lines"),
            rate(x["n_repeat_words"], n).alias("repeats"), rate(x["n_stutter"], n).alias("stutter"),
            rate(x["n_capitals"], x["word_chars"]).alias("capitals"))

    return docs.withColumn(out, let(m, rates))


def rounded(v: Column) -> Column:
    """``v`` without all but its ``SKETCH_BITS`` leading bits."""
    drop = F.greatest(F.lit(0), F.length(F.bin(v)) - SKETCH_BITS)
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), drop)
    return v - v % unit


def sketches(measured: DataFrame, groups: list[str], out: str = "quality") -> DataFrame:
    """One row per group, rule and rounded value: ``n`` documents. Documents
    that the base rules reject anyway do not shape the thresholds."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), rounded(F.col(f"{out}.{r}")).alias("value")) for r in RULES])
    return (measured.where(~F.col(f"{out}.base_failed")).select(*groups, F.explode(pairs).alias("p"))
            .groupBy(*groups, F.col("p.rule").alias("rule"), F.col("p.value").alias("value")).agg(F.count(F.lit(1)).alias("n")))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Coarser sketches: counts of equal values add up."""
    return sketch.groupBy(*groups, "rule", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, groups: list[str], name: str) -> DataFrame:
    """``name``: the upper fence of each group and rule."""
    w = Window.partitionBy(*groups, "rule")
    ranked = sketch.withColumn("cum", F.sum("n").over(w.orderBy("value"))).withColumn("all", F.sum("n").over(w))
    slack = F.coalesce(*[F.when(F.col("rule") == r, F.lit(s)) for r, s in SLACK.items()])
    q = ranked.groupBy(*groups, "rule").agg(
        F.min(F.when(2 * F.col("cum") >= F.col("all"), F.col("value"))).alias("q50"),
        F.min(F.when(4 * F.col("cum") >= 3 * F.col("all"), F.col("value"))).alias("q75"))
    return q.select(*groups, "rule", (F.col("q75") + 3 * (F.col("q75") - F.col("q50")) + slack).alias(name))


def thresholds(sketch: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source with the limit of every rule."""
    own = fences(sketch, [lang, source], "own")
    pool = fences(merged(sketch, [lang]), [lang], "pool")
    bound = own.join(pool, null_safe(own, pool, [lang, "rule"])).select(
        own[lang], own[source], own["rule"],
        F.greatest(F.floor(pool["pool"] / 2), F.least(own["own"], 2 * pool["pool"])).alias("limit"))
    return bound.groupBy(lang, source).agg(*[F.max(F.when(F.col("rule") == r, F.col("limit"))).alias(r) for r in RULES])


def with_verdict(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source",
                 keep: list[str] | None = None, out: str = "quality") -> DataFrame:
    """``keep`` columns (default: all), then the struct ``out`` (metrics) and its
    verdict in ``out_kept``. The measured rows are written once and read twice."""
    kept = docs.columns if keep is None else keep
    needed = list(dict.fromkeys([*kept, lang, source, text_col]))
    out = fresh(out, needed)
    measured = with_metrics(docs.select(*columns(needed)), text_col, out)
    measured = written(measured.select(*columns([c for c in needed if c in kept or c in (lang, source)]), out), "quality-metrics")
    limits = thresholds(sketches(measured, [lang, source], out), lang, source)
    l_lang, l_source, l_limits = (fresh(n, measured.columns) for n in ("l_lang", "l_source", "l_limits"))
    limits = limits.select(F.col(lang).alias(l_lang), F.col(source).alias(l_source), F.struct(*RULES).alias(l_limits))
    judged = measured.join(limits, measured[lang].eqNullSafe(limits[l_lang]) & measured[source].eqNullSafe(limits[l_source]), "left")
    within = F.lit(True)
    for r in RULES:
        within = within & F.coalesce(F.col(f"{out}.{r}") <= F.col(f"{l_limits}.{r}"), F.lit(True))
    return judged.select(*columns(kept), out, (~F.col(f"{out}.base_failed") & within).alias(fresh(f"{out}_kept", kept)))


def filter_quality(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their own columns."""
    judged = with_verdict(docs, text_col, lang, source)
    return judged.where(F.col(judged.columns[-1])).select(*columns(docs.columns))
