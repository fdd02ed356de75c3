"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources ordered by code point (null last) weigh 5, 2, 1 in turn and
   share ``share`` times all words; a target stops at ``cap`` times its source
   and the excess goes to the others by weight (water filling, solved in closed
   form over one row per source).
2. Blocks. Every source is cut into ``BLOCKS`` blocks of documents by a keyed
   hash. A source's draws are its whole passes over all blocks, then a prefix of
   its permuted blocks; the block where the target is reached is cut inside at
   a hash value, so the words taken miss the target by about half a document.
3. Tree. The draws of all sources are dealt to the output shards by recursive
   halving: at a node, the left half's share of each source is an exact
   multivariate hypergeometric draw (inverse transform of a hashed number, one
   source after the other), so every source's quota and every shard's size come
   out exactly. Shard ranges over a source's permuted draws are disjoint.
4. Documents join their block's draws on (source, block); each draw is a copy in
   a shard, ordered there by a keyed hash.

The quota tables have at most ``3 * BLOCKS`` rows per source and no window sees
more than that of a source, except that of the cut block: a 1/BLOCKS part of its
source. The number of sources is that of the weight table. Everything follows
from hashes of the seed and the row, so reruns agree. Rows of a hot source meet
in many blocks; the join's key is (source, block), and Spark broadcasts the draw
table only when its measured size allows.

Defined cases: a null text has 0 words; documents without words are taken with
their block at no cost; a null source is a source, last in the order; exact
repetitions of a row share its hash and move together; an empty table, or one
without words, gives an empty mix with the same columns. The two added columns
come last and take underscores at the end of their names where an input column
has that name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RX, columns, fresh, let, row_id, written

# Fixed values of the mix.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0

BLOCKS = 1024  # per source; a power of two
SHARDS = 16
SEED = 20240607
SIGMAS = 12    # a hashed number has 53 bits; no value lies further out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_RX)), F.lit(0)).cast("long")


def doc_key(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def block_of(key: Column) -> Column:
    return F.pmod(key, F.lit(BLOCKS)).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED,
          row: str | None = None) -> DataFrame:
    """Narrow rows of all documents, written once: id, source, size, key, block (and the column ``row``)."""
    key = doc_key(id_col, text_col, seed)
    return written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                               key.alias("key"), block_of(key).alias("block"), *([F.col(row).alias("row")] if row else [])), "mix-sizes")


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: rank, source_size, target. One row per source in, so
    the single-partition windows are bounded by the weight table."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    s = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights)))))
    s = s.withColumn("limit", F.col("source_size") * cap)
    # The level at which a source is full; sources fill up in this order.
    filling = everything.orderBy(F.col("limit") / F.col("weight"), "rank")
    done = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * share
    level = (total - F.coalesce(F.sum("limit").over(done), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level).withColumn("full", F.col("limit") <= F.col("weight") * F.col("level"))
    # From the first source that does not fill, one level holds for all.
    first = F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("at"), "rank", "level"))).over(everything)
    s = s.withColumn("open", first["level"]).withColumn("from", F.struct(first["at"], first["rank"]))
    place = F.struct((F.col("limit") / F.col("weight")).alias("at"), F.col("rank"))
    target = F.when(F.col("open").isNull() | (place < F.col("from")), F.col("limit")).otherwise(F.least("limit", F.col("weight") * F.col("open")))
    return s.select("source", "rank", "source_size", target.alias("target"))


def permuted(block: Column, source_hash: Column) -> Column:
    """A bijection of the block numbers, other for each source (odd factor, power-of-two modulus)."""
    factor = F.pmod(source_hash, F.lit(BLOCKS // 2)) * 2 + 1
    return F.pmod(block * factor + F.pmod(F.shiftright(source_hash, 20), F.lit(BLOCKS)), F.lit(BLOCKS)).cast("int")


def block_plan(sizes: DataFrame, goals: DataFrame, seed: int = SEED) -> DataFrame:
    """Per source and block: rank, order, passes, and of the last pass whether the
    block is in it (``part``) and up to which key (``cut``; null: all)."""
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    b = blocks.join(goals, blocks["source"].eqNullSafe(goals["source"])).select(
        blocks["source"], "block", "words", "rank", "target",
        F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0)).cast("int").alias("passes"),
        "source_size", permuted(F.col("block"), F.xxhash64(F.lit(seed), blocks["source"])).alias("order"))
    b = b.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy("order")
    b = b.withColumn("upto", F.sum("words").over(run))
    b = b.withColumn("before", F.col("upto") - F.col("words"))
    edge = b.where((F.col("before") < F.col("rest")) & (F.col("rest") < F.col("upto")))
    edge = edge.select(F.col("source").alias("e_source"), F.col("block").alias("e_block"), (F.col("rest") - F.col("before")).alias("need"))
    # Inside the cut block of each source: documents by key until the need is met.
    inside = sizes.join(edge, sizes["source"].eqNullSafe(edge["e_source"]) & (sizes["block"] == edge["e_block"]))
    keyed = inside.groupBy("e_source", "e_block", "need", "key").agg(F.sum("size").alias("size"))
    run = Window.partitionBy("e_source", "e_block").orderBy("key")
    keyed = keyed.withColumn("upto", F.sum("size").over(run))
    taken = F.col("upto") - F.col("size") / 2 <= F.col("need")
    cuts = keyed.groupBy("e_source", "e_block").agg(F.max(F.when(taken, F.col("key"))).alias("cut"))
    joined = b.join(cuts, b["source"].eqNullSafe(cuts["e_source"]) & (b["block"] == cuts["e_block"]), "left")
    whole = F.col("upto") <= F.col("rest")
    return joined.select("source", "rank", "block", "order", "passes", F.col("cut"),
                         ((whole & (F.col("rest") > 0)) | F.col("cut").isNotNull()).alias("part"))


def draws(plan: DataFrame) -> DataFrame:
    """One row per drawn block: rank, block, number ``j`` within the source, cut."""
    part = F.when(F.col("part"), F.array(F.struct(F.col("passes").alias("pass"), F.col("cut").alias("cut")))).otherwise(
        F.array().cast("array<struct<pass:int,cut:bigint>>"))
    whole = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes") - 1), lambda p: F.struct(
        p.alias("pass"), F.lit(None).cast("long").alias("cut")))).otherwise(F.array().cast("array<struct<pass:int,cut:bigint>>"))
    each = plan.select("source", "rank", "block", "order", F.explode(F.concat(whole, part)).alias("d"))
    run = Window.partitionBy("rank").orderBy("d.pass", "order")
    return each.select("source", "rank", "block", F.col("d.pass").alias("pass"), F.col("d.cut").alias("cut"),
                       (F.row_number().over(run) - 1).alias("j"))


# --- the splitting tree

def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted up by 8 to be exact for small n too."""
    x = n.cast("double") + 8
    small = reduce(lambda a, b: a * b, [n.cast("double") + k for k in range(1, 9)])
    series = x * F.log(x) - x + 0.5 * F.log(2 * 3.141592653589793 * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return series - F.log(small)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` fall in ``drawn`` draws: the smallest
    value whose distribution function reaches ``u``."""
    def value(p: Column) -> Column:
        n, k, m = p["n"], p["k"], p["m"]
        low = F.greatest(F.lit(0).cast("long"), m - (n - k))
        high = F.least(k, m)
        mean = m.cast("double") * k / n
        spread = F.sqrt(mean * (1 - k / n) * F.greatest(F.lit(0.0), (n - m) / F.greatest(F.lit(1).cast("long"), n - 1)))
        a = F.greatest(low, F.floor(mean - SIGMAS * spread - SIGMAS))
        b = F.least(high, F.ceil(mean + SIGMAS * spread + SIGMAS))
        fixed = (log_factorial(k) + log_factorial(n - k) + log_factorial(m) + log_factorial(n - m) - log_factorial(n))

        def weight(x: Column, c: Column) -> Column:
            return F.exp(c - log_factorial(x) - log_factorial(k - x) - log_factorial(m - x) - log_factorial(n - k - m + x))
        weights = let(fixed, lambda c: F.transform(F.sequence(a, b), lambda x: F.struct(x.alias("x"), weight(x, c).alias("w"))))

        def pick(ws: Column) -> Column:
            total_w = F.aggregate(ws, F.lit(0.0), lambda s, w: s + w["w"])
            first = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("x"))
            scan = let(total_w * u, lambda goal: F.aggregate(ws, first, lambda s, w: F.struct(
                (s["sum"] + w["w"]).alias("sum"),
                F.when(s["x"].isNotNull(), s["x"]).when(s["sum"] + w["w"] >= goal, w["x"]).alias("x"))))
            return F.coalesce(scan["x"], b)
        return F.when(n <= 0, F.lit(0).cast("long")).when(a == b, a).otherwise(let(weights, pick))

    return let(F.struct(total.cast("long").alias("n"), good.cast("long").alias("k"), drawn.cast("long").alias("m")), value)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1] from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 1) / float(1 << 53)


def split(counts: Column, size: Column, left: Column, *seed: Column) -> Column:
    """The left half's count of every source: exact without replacement."""
    start = F.struct(size.cast("long").alias("n"), left.cast("long").alias("m"), F.array().cast("array<bigint>").alias("out"))

    def step(s: Column, c: Column) -> Column:
        x = hypergeometric(s["n"], c, s["m"], uniform(*seed, F.size(s["out"])))
        return let(x, lambda x: F.struct((s["n"] - c).alias("n"), (s["m"] - x).alias("m"), F.concat(s["out"], F.array(x)).alias("out")))
    return F.aggregate(counts, start, step)["out"]


def quotas(drawn: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Rows (rank, shard, first, quota): the shard's range of the source's draws."""
    per = drawn.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    root = per.agg(F.sort_array(F.collect_list(F.struct("rank", "n"))).alias("s")).select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.transform("s", lambda x: x["rank"]).alias("ranks"),
        F.transform("s", lambda x: x["n"]).alias("counts"))
    nodes = root
    for _ in range(max(0, (shards - 1).bit_length())):
        size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
        middle = (F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2)).cast("int")
        share = F.floor(size * (middle - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")
        parted = nodes.withColumn("mid", middle).withColumn(
            "left", F.when(F.col("hi") - F.col("lo") > 1, split(F.col("counts"), size, share, F.lit(seed), F.col("lo"), F.col("hi"))))
        halves = F.when(F.col("left").isNull(), F.array(F.struct("lo", "hi", "counts"))).otherwise(F.array(
            F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("counts")),
            F.struct(F.col("mid").alias("lo"), F.col("hi"), F.zip_with("counts", "left", lambda c, x: c - x).alias("counts"))))
        nodes = parted.select("ranks", F.explode(halves).alias("h")).select("ranks", "h.*")
    flat = nodes.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("ranks", "counts")).alias("z"))
    flat = flat.select(F.col("z.ranks").alias("rank"), "shard", F.col("z.counts").alias("quota"))
    run = Window.partitionBy("rank").orderBy("shard")
    return flat.withColumn("first", F.sum("quota").over(run) - F.col("quota"))


def deal(drawn: DataFrame, quota: DataFrame) -> DataFrame:
    """Every drawn block with its shard."""
    places = quota.where("quota > 0").select(F.col("rank").alias("q_rank"), "shard", F.explode(F.sequence("first", F.col("first") + F.col("quota") - 1)).alias("q_j"))
    return drawn.join(places, (drawn["rank"] == places["q_rank"]) & (drawn["j"] == places["q_j"])).select(
        "source", "block", "pass", "cut", "shard")


def mix_plan(sizes: DataFrame, goals: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per source and block, its draws (pass, cut, shard); written once."""
    drawn = written(draws(block_plan(sizes, goals, seed)), "mix-draws")
    dealt = deal(drawn, quotas(drawn, shards, seed))
    return written(dealt.groupBy("source", "block").agg(F.collect_list(F.struct("pass", "cut", "shard")).alias("draws")), "mix-plan")


def copies(rows: DataFrame, plan: DataFrame, source_col: str, block_col: str, key_col: str, seed: int = SEED) -> DataFrame:
    """``rows`` once for each draw that takes them, then the shard (``mix_shard``)
    and the random place within it (``mix_order``)."""
    source, block, all_draws, draw, shard, order = (
        fresh(n, rows.columns) for n in ("p_source", "p_block", "p_draws", "p_draw", "mix_shard", "mix_order"))
    p = plan.select(F.col("source").alias(source), F.col("block").alias(block), F.col("draws").alias(all_draws))
    j = rows.join(p, rows[source_col].eqNullSafe(p[source]) & (rows[block_col] == p[block]))
    hit = F.filter(all_draws, lambda d: d["cut"].isNull() | (F.col(key_col) <= d["cut"]))
    return j.select(*columns(rows.columns), F.explode(hit).alias(draw)).select(
        *columns(rows.columns), F.col(f"{draw}.shard").alias(shard),
        F.xxhash64(F.lit(seed), F.col(key_col), F.col(f"{draw}.pass")).alias(order))


def arranged(docs: DataFrame, plan: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """The copies of ``docs`` that the plan draws, dealt to their shards and ordered there."""
    key = doc_key(id_col, text_col, seed)
    k, b = (fresh(n, docs.columns) for n in ("d_key", "d_block"))
    rows = docs.withColumn(k, key).withColumn(b, block_of(key))
    out = copies(rows, plan, source_col, b, k, seed).drop(k, b)
    place = out.columns[-2:]
    return out.repartitionByRange(*place).sortWithinPartitions(*place)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix: documents with repetitions, in shard order and shuffled inside
    every shard; the last two columns are ``mix_shard`` and ``mix_order``. Writing
    it with ``partitionBy("mix_shard")`` makes the shard folders."""
    sizes = sized(docs, id_col, text_col, source_col, seed)
    return arranged(docs, mix_plan(sizes, targets(sizes), shards, seed), id_col, text_col, source_col, seed)


def mix_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: its size, its source's size and target, and the
    words that its copies in the mix hold. The mix is made with whole texts and
    dealt to its shards; ``taken`` is counted over the texts that arrive there.
    ``docs`` has to be a stored table, since rows are numbered by the scan."""
    row = fresh("mix_row", docs.columns)
    numbered = docs.withColumn(row, row_id(docs.sparkSession))
    sizes = sized(numbered, id_col, text_col, source_col, seed, row)
    goals = written(targets(sizes), "mix-targets")
    made = arranged(numbered, mix_plan(sizes, goals, shards, seed), id_col, text_col, source_col, seed)
    taken = made.groupBy(F.col(row).alias("t_row")).agg(F.sum(word_count(F.col(text_col))).alias("taken"))
    g = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    j = sizes.join(g, sizes["source"].eqNullSafe(g["g_source"])).join(taken, sizes["row"] == taken["t_row"], "left")
    return j.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
