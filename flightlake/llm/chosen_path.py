"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles (64-bit hashes); a link is a Jaccard
similarity of at least ``THRESHOLD`` between two documents.

1. *Sets.* Each text gives its set's size, a 128-bit fingerprint, ``T`` minhash
   tokens and a sketch of one byte per token. Documents of equal sets form a
   copy group with one representative; only representatives go on.
2. *Chosen paths.* A run splits its bucket on sampled tokens: a node samples each
   token place with probability 1 / (THRESHOLD * T), and members that agree there
   share a child bucket, so a linked pair has one shared child on average at every
   level. Buckets of one member end, buckets of up to ``SMALL`` are brute-forced on
   the sketches, larger ones are split again. ``runs_for`` repeats runs until a
   pair at the threshold is missed with at most 1 - ``RECALL`` even if it takes
   all levels. What is still large after the last level (masses of near copies,
   which agree everywhere) is compared with a few leaders, and the members that
   resemble none of them with the whole bucket, in blocks; nothing is cut off.
3. *Candidates.* A bucket emits a spanning forest of its sketch matches, never its
   pairs. Connected components of all forests are the candidate groups.
4. *Exact check.* Each candidate group gets its members' shingle sets, once, in
   blocks of bounded size; every two sets are compared exactly and each document's
   links are counted. Spanning forests of the exact links give the classes.

A hot group is spread over (block, block) tasks, and copies of a text were
merged before. Components are found by rounds of minimum labels (large star,
small star) written to the shared folder. No pair list exists anywhere, so the
output is one row per document.

Defined cases: null texts count as empty; a text without words is in no group and
has no links; a text of one to four words is one shingle; repeated rows are
copies of each other; an empty table gives an empty result; other columns are
not read, or kept as they are by ``keep_one``. ``docs`` has to be a stored
table: its scan has to number the rows alike each time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, row_id, written

SHINGLE = 5
THRESHOLD = 0.8
T = 128
LEVELS = 3
RECALL = 0.999
SMALL = 256
LEADERS = 4
BLOCK_SETS = 1024  # sets, and shingles, of one side of an exact comparison
BLOCK_SHINGLES = 400_000
BUCKET_SETS = 4096  # sketches of one side of a large bucket's comparison
# Threshold pairs whose sketches agree in fewer places than SKETCH_MIN, as a share.
SKETCH_MISS = 0.0003
# A sketch of a linked pair agrees on 0.8 of its bytes give or take 0.035.
SKETCH_MIN = round(T * (THRESHOLD - 0.12))
_U = np.uint64


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


FACTORS = _constants(T, 1)
PLACES = _constants(T, 2)
STEPS = _constants(SHINGLE, 3)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


def runs_for(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs until a threshold pair is found with probability ``recall``: shared
    children are Poisson with mean one, so survival is q -> 1 - exp(-q)."""
    q = 1.0
    for _ in range(levels):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def roots(recall: float = RECALL, levels: int = LEVELS) -> list[tuple[int, np.ndarray]]:
    """(root path, sampled places) of the runs: those that sample a place, until a
    threshold pair is missed with at most 1 - ``recall``. A place agrees with
    probability THRESHOLD; below it the nodes are random."""
    q = 1.0
    for _ in range(levels - 1):
        q = 1 - math.exp(-q)
    out, miss, run = [], 1.0, 0
    while miss > max(1 - recall - SKETCH_MISS, 1e-9):
        run += 1
        path = int(mixed(np.array([run], np.uint64))[0])
        if len(at := chosen(path)):
            out.append((path, at))
            miss *= (1 - THRESHOLD * q) ** len(at)
    return out


def chosen(path: int) -> np.ndarray:
    """The token places that a node samples."""
    draw = mixed(PLACES ^ _U(path & 0xFFFFFFFFFFFFFFFF))
    return np.flatnonzero(draw < _U(int(2**64 / (THRESHOLD * T))))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    import xxhash

    words = (text or "").encode().lower().split()  # A-Z only; the six blanks
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(w) < SHINGLE:
        return mixed((w * STEPS[: len(w)]).sum(keepdims=True) + _U(len(w)))
    n = len(w) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += w[k:k + n] * STEPS[k]
    return np.unique(mixed(total))


def minhash(s: np.ndarray) -> np.ndarray:
    low = np.full(T, _U(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(s), 512):
        np.minimum(low, (s[i:i + 512, None] * FACTORS[None, :]).min(axis=0), out=low)
    return low


def sets_of(docs: DataFrame, id_col: str, text_col: str, recall: float) -> DataFrame:
    """row, id, n, fingerprint, sketch and the root paths of all runs."""
    src = docs.select(row_id(docs.sparkSession).alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    places = roots(recall)
    at = np.concatenate([p for _, p in places]).astype(np.int64)
    salt = np.concatenate([np.full(len(p), r, np.uint64) for r, p in places]) ^ PLACES[at]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0).to_pylist()
            n, f1, f2, sketch, paths = [], [], [], [], []
            for row, text in zip(rows, b.column(2).to_pylist()):
                s = shingles(text)
                n.append(len(s))
                if not len(s):  # no set: a copy group of its own, in no bucket
                    f1.append(row), f2.append(-1), sketch.append(bytes(T)), paths.append([])
                    continue
                f1.append(int(mixed(s).sum().view(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(mixed(s ^ STEPS[0])).view(np.int64)))
                low = minhash(s)
                sketch.append((mixed(low) >> _U(56)).astype(np.uint8).tobytes())
                paths.append(mixed(mixed(low[at]) ^ salt).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(sketch, pa.binary()), pa.array(paths, pa.list_(pa.int64()))],
                names=["row", "id", "n", "f1", "f2", "sketch", "paths"])

    return map_batches(src, build, f"row long, id {dict(src.dtypes)['id']}, n long, f1 long, f2 long, sketch binary, paths array<long>")


# --- buckets

def column_of(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def sketches_of(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(b.schema.get_field_index("sketch")).to_pylist()), np.uint8).reshape(-1, T)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups, with the groups' bounds; rows come sorted by key.
    A group may span batches, so the last one waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = np.ones(b.num_rows, bool)  # rows of the batch's last group
        for k in keys:
            c = column_of(b, k)
            last &= c == c[-1]
        start = b.num_rows - int(last[::-1].argmin()) if not last.all() else 0
        whole = start == 0 and held and all(column_of(held[-1], k)[-1] == column_of(b, k)[0] for k in keys)
        if whole:
            held.append(b)
            continue
        if held or start:
            ready = pa.concat_batches([*held, b.slice(0, start)])
            if ready.num_rows:
                yield ready, bounds(ready, keys)
        held = [b.slice(start)]
    if held and (ready := pa.concat_batches(held)).num_rows:
        yield ready, bounds(ready, keys)


def bounds(b: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(b.num_rows, bool)
    for k in keys:
        c = column_of(b, k)
        new[1:] |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(new), [b.num_rows]])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member index of each member's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


EDGES = "u long, v long"


def edge_batch(u: list, v: list) -> pa.RecordBatch:
    both = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (u, v)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in both], names=["u", "v"])


def bucket_edges(b: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
    """Spanning forests of the sketch matches inside each bucket, or, where rows
    have a ``side``, of the matches of side 1 with all rows."""
    rep, s = column_of(b, "rep"), sketches_of(b)
    side = column_of(b, "side") if "side" in b.schema.names else None
    u, v = [], []
    size = np.diff(cuts)
    if side is None:
        two = cuts[:-1][size == 2]  # most buckets: all at once
        hit = two[(s[two] == s[two + 1]).sum(axis=1) >= SKETCH_MIN]
        u.append(rep[hit]), v.append(rep[hit + 1])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi - lo < 2 or side is None and hi - lo == 2:
            continue
        m = s[lo:hi]
        mine = np.arange(hi - lo) if side is None else np.flatnonzero(side[lo:hi] == 1)
        a, c = [], []
        for k in range(0, len(mine), 64):
            x, y = np.nonzero(agreement(m[mine[k:k + 64]], m) >= SKETCH_MIN)
            x = mine[k:k + 64][x]
            a.append(x[x != y]), c.append(y[x != y])
        if not a:
            continue
        label = forest(hi - lo, np.concatenate(a), np.concatenate(c))
        child = np.flatnonzero(label != np.arange(hi - lo))
        u.append(rep[lo:hi][child]), v.append(rep[lo:hi][label[child]])
    return edge_batch(u, v)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bytes of every two sketches."""
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(0, T, 16):
        out += (a[:, None, k:k + 16] == b[None, :, k:k + 16]).sum(axis=2, dtype=np.int16)
    return out


def edges_in(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Spanning edges of the buckets that ``keys`` name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, cuts in grouped(batches, keys):
            yield bucket_edges(b, cuts)
    return map_batches(rows.repartition(*keys).sortWithinPartitions(*keys, "rep"), run, EDGES)


def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The next level's rows (path, rep) of the members of large buckets."""
    known: dict[int, np.ndarray] = {}
    for b in batches:
        path, rep, s = column_of(b, "path"), column_of(b, "rep"), sketches_of(b)
        if len(known) > 100_000:
            known.clear()
        at = [known[p] if p in known else known.setdefault(p, chosen(p)) for p in path.tolist()]
        owner = np.repeat(np.arange(len(path)), [len(x) for x in at])
        place = np.concatenate(at).astype(np.int64) if len(at) else np.empty(0, np.int64)
        value = s[owner, place].astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        child = mixed(mixed(path.view(np.uint64)[owner] ^ PLACES[place]) ^ value).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(child, pa.int64()), pa.array(rep[owner], pa.int64())], names=["path", "rep"])


def leader_edges(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Large buckets after the last level: ``members`` (path, rep, sketch, size).
    Rows (u, path, mask, hits): which of its bucket's leaders a member matches, as
    bits and as representatives."""
    pick = [F.min(F.struct(F.xxhash64(F.lit(k), "path", "rep"), F.col("rep").alias("leader"))).alias(f"l{k}") for k in range(LEADERS)]
    leaders = members.groupBy("path").agg(*pick).select(F.col("path").alias("l_path"), F.explode(F.array_distinct(F.array(*[F.col(f"l{k}.leader") for k in range(LEADERS)]))).alias("leader"))
    leaders = leaders.join(reps.select(F.col("rep").alias("leader"), F.col("sketch").alias("l_sketch")), "leader")
    lists = leaders.groupBy("l_path").agg(F.collect_list(F.struct("leader", "l_sketch")).alias("leaders"))  # LEADERS of them at most
    j = members.join(lists, members["path"] == lists["l_path"]).select("path", "rep", "sketch", F.transform("leaders", lambda x: x["leader"]).alias("leader"), F.transform("leaders", lambda x: x["l_sketch"]).alias("l_sketch"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, masks, hits = sketches_of(b), [], []
            leader, sketch = b.column(3).to_pylist(), b.column(4).to_pylist()
            for i, rep in enumerate(column_of(b, "rep").tolist()):
                l_s = np.frombuffer(b"".join(sketch[i]), np.uint8).reshape(-1, T)
                near = np.flatnonzero((l_s == s[i]).sum(axis=1) >= SKETCH_MIN).tolist()
                masks.append(sum(1 << k for k in near))
                hits.append([leader[i][k] for k in near if leader[i][k] != rep])
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(0), pa.array(masks, pa.int64()), pa.array(hits, pa.list_(pa.int64()))],
                                             names=["u", "path", "mask", "hits"])

    return map_batches(j, match, "u long, path long, mask long, hits array<long>")


def main_clusters(met: DataFrame) -> DataFrame:
    """(m_path, main): of each bucket's leaders, tied to each other by members that
    match several, the cluster with most members, as bits."""
    masks = met.where("mask > 0").groupBy("path", "mask").agg(F.count(F.lit(1)).alias("n"))
    lists = masks.groupBy("path").agg(F.collect_list(F.struct("mask", "n")).alias("masks"))  # 2^LEADERS - 1 at most

    def join_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            main = []
            for rows in b.column(1).to_pylist():
                clusters: dict[int, int] = {}
                for r in rows:
                    mask, n = r["mask"], r["n"]
                    for other in [c for c in clusters if c & mask]:
                        mask, n = mask | other, n + clusters.pop(other)
                    clusters[mask] = n
                main.append(max(clusters, key=lambda c: (clusters[c], c)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(main, pa.int64())], names=["m_path", "main"])

    return map_batches(lists.select("path", "masks"), join_masks, "m_path long, main long")


def large_bucket_edges(large: DataFrame, light: DataFrame) -> list[DataFrame]:
    """Edges that connect all matching members of large buckets (path, rep, sketch, size)."""
    met = written(leader_edges(large, light), "leader-edges")
    main = main_clusters(met)
    loose = met.join(main, met["path"] == main["m_path"]).where(F.col("mask").bitwiseAND(F.col("main")) == 0).select("u", "path")
    loose = written(loose, "unsettled-members")
    found = [met.select("u", F.explode("hits").alias("v"))]
    if not loose.isEmpty():
        found.append(edges_in(block_rows(large, loose), ["path", "x", "y"]))
    return found


def block_rows(members: DataFrame, loose: DataFrame) -> DataFrame:
    """Unsettled members against their whole bucket, block by block."""
    n_loose = loose.groupBy("path").agg(F.count(F.lit(1)).alias("n_loose")).withColumnRenamed("path", "c_path")
    m = members.join(n_loose, members["path"] == n_loose["c_path"])
    nx, ny = F.ceil(F.col("size") / BUCKET_SETS).cast("int"), F.ceil(F.col("n_loose") / BUCKET_SETS).cast("int")
    own = F.xxhash64("rep", "path")
    all_side = m.select("path", F.pmod(own, nx).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), ny - 1)).alias("y"), "rep", "sketch", F.lit(0).alias("side"))
    loose_ids = loose.select(F.col("path").alias("o_path"), F.col("u").alias("o_rep"))
    out = m.join(loose_ids, (m["path"] == loose_ids["o_path"]) & (m["rep"] == loose_ids["o_rep"]), "left_semi")
    loose_side = out.select("path", F.explode(F.sequence(F.lit(0), nx - 1)).alias("x"), F.pmod(own, ny).cast("int").alias("y"), "rep", "sketch", F.lit(1).alias("side"))
    return all_side.unionByName(loose_side)


def candidate_edges(reps: DataFrame) -> DataFrame:
    """Spanning edges between representatives that match on their sketches."""
    light = reps.select("rep", "sketch")
    rows = reps.select(F.explode("paths").alias("path"), "rep")
    small, found = [], []
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnRenamed("path", "s_path")
        full = written(rows.join(sizes, rows["path"] == sizes["s_path"]).select("path", "rep", "size"), f"buckets-{level}")
        small.append(full.where(F.col("size") <= SMALL).select("path", "rep"))
        large = full.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        large = large.join(light, "rep")
        if level < LEVELS:
            rows = written(map_batches(large.select("path", "rep", "sketch"), children, "path long, rep long"), f"paths-{level + 1}")
            continue
        large = written(large.select("path", "rep", "sketch", "size"), "large-buckets")
        found += large_bucket_edges(large, light)
    found.append(edges_in(reduce(DataFrame.unionByName, small).join(light, "rep").select("path", "rep", "sketch"), ["path"]))
    return reduce(DataFrame.unionByName, found)


# --- components

def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by large-star and small-star rounds;
    the root is the smallest node. Each round is written; hot nodes' joins split."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "component-edges")
    while not are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, both["u"] == low["k"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "component-round")
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, large["u"] == low["k"]).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        e = written(small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct(), "component-edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none that leads up too."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("x")).select("x.*")
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


# --- exact check

def shingle_rows(rows: DataFrame) -> DataFrame:
    """``text`` replaced by its set (64-bit hashes, as bytes)."""
    names = [c for c in rows.columns if c != "text"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = pa.array([shingles(t).tobytes() for t in b.column(b.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], sets], names=[*names, "set"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return map_batches(rows.select(*names, "text"), build, f"{schema}, set binary")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left`` with ``right`` members: shared
    shingles as columns of 0/1 matrices, some columns at a time."""
    token = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(token, kind="stable")
    token, member = token[order], member[order]
    new = np.concatenate([[True], token[1:] != token[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    member, column = member[shared], column[shared]
    out = np.zeros((len(left), len(right)), np.int32)  # sums beyond 2^24 stay exact
    if not len(column):
        return out
    new = np.concatenate([[True], column[1:] != column[:-1]])
    column = np.cumsum(new) - 1
    row = np.full((2, len(sets)), -1)  # a member's row in the left and the right matrix
    row[0, left], row[1, right] = np.arange(len(left)), np.arange(len(right))

    def ones(side: int, n: int, a: int, b: int, lo: int) -> np.ndarray:
        x, at = np.zeros((n, 1024), np.float32), row[side, member[a:b]]
        x[at[at >= 0], column[a:b][at >= 0] - lo] = 1
        return x

    for lo in range(0, int(column[-1]) + 1, 1024):
        a, b = np.searchsorted(column, [lo, lo + 1024])
        x = ones(0, len(left), a, b, lo)
        np.add(out, x @ (x if left is right else ones(1, len(right), a, b, lo)).T, out=out, casting="unsafe")
    return out


def exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group (root, x, y) of blocks: each member's links to the other side
    (documents and sets), the first member of its component in the group (rows
    come sorted by representative), and the number of blocks."""
    for b, cuts in grouped(batches, ["root", "x", "y"]):
        rep, copies, block = column_of(b, "rep"), column_of(b, "copies"), column_of(b, "block")
        x, y, blocks = column_of(b, "x"), column_of(b, "y"), column_of(b, "blocks")
        raw = b.column(b.schema.get_field_index("set"))
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            sets = [np.frombuffer(raw[i].as_buffer(), np.uint64) for i in range(lo, hi)]
            size = np.array([len(s) for s in sets], np.float64)
            everyone = np.arange(hi - lo)
            same = x[lo] == y[lo]
            left = everyone if same else np.flatnonzero(block[lo:hi] == x[lo])
            right = everyone if same else np.flatnonzero(block[lo:hi] == y[lo])
            if not len(left) or not len(right):
                continue
            common = overlaps(sets, left, right)
            weight = copies[lo:hi]
            docs, sets_n, label = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64), everyone
            for k in range(0, len(left), 256):  # in slices, so that dense groups need little memory
                i, c = left[k:k + 256], common[k:k + 256].astype(np.float64)
                linked = c >= THRESHOLD * (size[i, None] + size[right][None, :] - c) - 1e-9
                linked &= i[:, None] != right[None, :]
                docs[i] += linked @ weight[right]
                sets_n[i] += linked.sum(axis=1)
                if not same:
                    docs[right] += linked.T @ weight[i]
                    sets_n[right] += linked.sum(axis=0)
                a, d = np.nonzero(linked)
                a, d = label[i[a]], label[right[d]]
                label = forest(hi - lo, a[a != d], d[a != d])[label]
            for c, v in zip(out, (rep[lo:hi], docs, sets_n, rep[lo:hi][label], np.full(hi - lo, blocks[lo]))):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["rep", "docs", "sets", "low", "blocks"])


def verified(docs: DataFrame, reps: DataFrame, groups: DataFrame, text_col: str) -> DataFrame:
    """Exact links of all candidate groups: (rep, docs, sets, low) per block pair."""
    members = groups.join(reps.select("rep", "copies", "n"), groups["node"] == reps["rep"]).select("root", "rep", "copies", "n")
    members = written(members, "candidates")
    load = members.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")).withColumnRenamed("root", "g_root")
    placed = members.join(load, members["root"] == load["g_root"]).select("root", "rep", "copies", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"))
    texts = docs.select(row_id(docs.sparkSession).alias("row"), F.col(text_col).cast("string").alias("text"))
    # The candidates are a share of all documents: never a side to broadcast.
    rows = shingle_rows(placed.hint("merge").join(texts, placed["rep"] == texts["row"]).select("root", "rep", "copies", "blocks", "block", "text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("root", "rep", "copies", "block", "blocks", "set", other).select(
        "root", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "rep", "copies", "block", "blocks", "set")
    keys = ["root", "x", "y"]
    out = map_batches(rows.repartition(*keys).sortWithinPartitions(*keys, "rep"), exact_links, "rep long, docs long, sets long, low long, blocks long")
    return written(out, "exact-links")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per document: row, ``id_col``, ``class_id`` (smallest id of its
    linked group), ``class_size`` (documents in it), ``copy_id`` (smallest id with
    the same set), ``n_copies``, ``n_links`` (other documents at the threshold or
    above, copies included) and ``kept`` (the group's row with the largest id)."""
    sets = written(sets_of(docs, id_col, text_col, recall), "shingle-sets")
    key = ["f1", "f2", "n"]
    copies = sets.groupBy(*key).agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("copy_id"))
    copies = written(copies, "copy-groups")
    c = copies.select("rep", "copies")
    reps = written(sets.where("n > 0").join(c, sets["row"] == c["rep"]).select("rep", "copies", "n", "sketch", "paths"), "representatives")
    exact = verified(docs, reps, components(candidate_edges(reps)), text_col)
    links = exact.groupBy("rep").agg(F.sum("docs").alias("docs"), F.sum("sets").alias("n_linked_sets")).withColumnRenamed("rep", "l_rep")
    # A group of one block has its classes already; blocks of larger ones meet here.
    one = exact.where("blocks = 1").select(F.col("rep").alias("node"), F.col("low").alias("root"))
    several = exact.where("blocks > 1").select(F.col("rep").alias("u"), F.col("low").alias("v"))
    classes = one if several.isEmpty() else one.unionByName(components(several))
    per = copies.join(links, copies["rep"] == links["l_rep"], "left").join(classes, copies["rep"] == classes["node"], "left")
    per = per.select(*[F.col(k).alias(f"k_{k}") for k in key], "copy_id", "copies", F.coalesce("docs", F.lit(0)).alias("docs"),
                     F.coalesce("n_linked_sets", F.lit(0)).alias("n_linked_sets"), F.coalesce("root", "rep").alias("root"))
    rows = sets.select("row", "id", *key)
    j = rows.join(per, (rows["f1"] == per["k_f1"]) & (rows["f2"] == per["k_f2"]) & (rows["n"] == per["k_n"]))
    j = written(j.select("row", "id", "copy_id", "copies", "docs", "n_linked_sets", "root"), "document-links")
    best = F.max(F.struct(F.col("id"), (-F.col("row")).alias("minus_row"))).alias("best")
    g = j.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), best).withColumnRenamed("root", "g_root")
    return j.join(g, j["root"] == g["g_root"]).select(
        "row", F.col("id").alias(id_col), "class_id", "class_size", "copy_id", F.col("copies").alias("n_copies"),
        (F.col("docs") + F.col("copies") - 1).alias("n_links"), "n_linked_sets", (F.col("row") == -F.col("best.minus_row")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (a stored table) of which each linked group keeps one."""
    dropped = written(similarity_classes(docs, id_col, text_col).where("NOT kept").select(F.col("row").alias("dropped_row")), "dropped-rows")
    name = fresh("row_number_", docs.columns)
    numbered = docs.withColumn(name, row_id(docs.sparkSession))
    return numbered.join(dropped, numbered[name] == dropped["dropped_row"], "left_anti").drop(name)
