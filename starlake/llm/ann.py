"""Approximate nearest neighbours: multiprobe p-stable hashing with exact Euclidean reranking.

Equal vectors are one class. A class is hashed in several tables; a table's bucket is the tuple of ``m`` slots
floor((a.v + b) / w) with Gaussian a, so the difference of two vectors at distance d moves a projection by N(0, d^2) and near
vectors share a slot or fall into one beside it. A query visits its own bucket and then perturbed ones: moving a projection by
some slots costs the squared distance to the nearer edge of that slot, and buckets are visited in rising total cost, the order
of estimated success. Bucket mates are compared exactly in double precision; each cell of a bucket hands on its k + 1 nearest,
and the tables' candidates are merged and ranked by distance.

The number of tables, ``m``, the width w and the number of visits are fitted: a bounded sample of query vectors
(``SAMPLE_QUERIES``) is compared with every row, and of all settings that find the ``recall`` share of their true neighbours
the one with the least estimated work is taken. Every row is indexed, no bucket is cut off, and a query for which fewer than k
rows were found is compared with all rows, in blocks.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import HOT_KEYS, INDEX, PROBE, group_ids, large_groups, runs
from .common import cut, small

SEED = 7041
SAMPLE_QUERIES = 40    # query vectors whose true neighbours are known when the settings are fitted
SAMPLE_ROWS = 512      # rows from which the share that a setting compares is estimated
REACH = 2              # a visit moves a projection by this many slots at most
TABLES = (2, 3, 4, 6)   # numbers of tables tried
VISITS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)
ROW_COST = 20          # dealing a row or a visit costs as much as so many comparisons
NO_ID = np.iinfo(np.int64).max
PROBE_BLOCK = 1 << 13
INTEGERS = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Settings:
    """``tables`` tables of ``m`` projections with slots of ``width``; a query visits ``visits`` buckets in each."""

    tables: int
    m: int
    width: float
    visits: int


EXHAUSTIVE = Settings(1, 0, 1.0, 1)  # one bucket: every query meets every row


def _projections(dim: int, table: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng([SEED, dim, table])
    return rnd.standard_normal((32, dim))[:s.m].T, rnd.uniform(0, s.width, 32)[:s.m]


def places(x: np.ndarray, table: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(slot numbers, place inside the slot in units of length) of the rows of ``x``."""
    a, b = _projections(x.shape[1], table, s)
    with np.errstate(over="ignore", invalid="ignore"):
        at = np.nan_to_num(np.clip((x @ a + b) / s.width, -2.0**52, 2.0**52))
    slot = np.floor(at)
    return slot.astype(np.int64), (at - slot) * s.width


def move_costs(inside: np.ndarray, width: float) -> np.ndarray:
    """(rows, m, 2 * REACH + 1): squared distance from a projection to the slot -REACH .. REACH away."""
    steps = np.arange(-REACH, REACH + 1)
    below, above = inside[..., None] + (-steps - 1) * width, (steps * width) - inside[..., None]
    with np.errstate(over="ignore"):
        return np.where(steps < 0, below, np.where(steps > 0, above, 0.0)) ** 2


def visit_order(cost: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """(moves, costs) of the ``visits`` cheapest buckets of each row, cheapest first; ``moves`` is (rows, visits, m).

    Projections are added one by one and the cheapest partial sums kept: costs are never negative, so a bucket among the
    cheapest has all its prefixes among the cheapest prefixes.
    """
    rows, m, options = cost.shape
    total, moves = np.zeros((rows, 1)), np.zeros((rows, 1, 0), np.int8)
    for j in range(m):
        wide = (total[:, :, None] + cost[:, None, j, :]).reshape(rows, -1)
        keep = np.argpartition(wide, visits - 1, axis=1)[:, :visits] if wide.shape[1] > visits else np.arange(wide.shape[1])[None].repeat(rows, 0)
        total = np.take_along_axis(wide, keep, 1)
        before = np.take_along_axis(moves, (keep // options)[..., None], 1)
        moves = np.concatenate([before, (keep % options - REACH)[..., None].astype(np.int8)], axis=2)
    rank = np.argsort(total, axis=1, kind="stable")
    return np.take_along_axis(moves, rank[..., None], 1), np.take_along_axis(total, rank, 1)


def _keys(slots: np.ndarray, table: int, dim: int) -> np.ndarray:
    """A 64-bit number for a bucket; should two buckets share one, their rows are compared in vain, not missed."""
    key = np.full(slots.shape[:-1], (table * 0x632BE59BD9B4E019 + dim * 0xD6E8FEB86659FD93 + 1) % 2**64, np.uint64)
    for j in range(slots.shape[-1]):
        key = (key ^ slots[..., j].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, from the differences; scaled where squares leave the range of doubles."""
    diff = q - x
    with np.errstate(over="ignore", under="ignore"):
        d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    odd = np.flatnonzero(~np.isfinite(d) | (d < 1e-140))
    if len(odd):
        part = diff[odd]
        top = np.abs(part).max(axis=1)
        part = part / np.where(top > 0, top, 1)[:, None]
        d[odd] = top * np.sqrt(np.einsum("ij,ij->i", part, part))
    return d


def nearest_in(q: np.ndarray, x: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, distance): the k nearest rows of x for each row of q, by distance and then by ``order``.

    A matrix product finds the rows that can be among them; their distances are then taken from the differences.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    with np.errstate(over="ignore", invalid="ignore"):
        xx, step = np.einsum("ij,ij->i", x, x), max(1, (1 << 20) // max(1, len(x)))
        for at in range(0, len(q), step):
            part = q[at:at + step]
            qq = np.einsum("ij,ij->i", part, part)
            if k < len(x):
                near = qq[:, None] + xx - 2 * (part @ x.T)
                slack = 1e-9 * (qq + xx.max())
                far = np.partition(near, k - 1, axis=1)[:, k - 1]
                i, j = np.nonzero(~(near > (far + slack)[:, None]))  # what isn't a number stays in
            else:
                i, j = np.indices((len(part), len(x))).reshape(2, -1)
            for cut_at in range(0, len(i), 1 << 16):
                a, b = i[cut_at:cut_at + (1 << 16)], j[cut_at:cut_at + (1 << 16)]
                out.append((a + at, b, distances(part[a], x[b])))
    i, j, d = (np.concatenate(z) for z in zip(*out))
    rank = np.lexsort((order[j], d, i))
    i, j, d = i[rank], j[rank], d[rank]
    start = np.searchsorted(i, np.arange(len(q)))
    kept = np.arange(len(i)) - start[i] < k
    return i[kept], j[kept], d[kept]


def _by_length(batch: pa.RecordBatch, col: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch whose vectors have the same length, with their matrix."""
    sizes = np.diff(batch.column(col).offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        part = batch.filter(pa.array(sizes == dim))
        yield part, _matrix(part.column(col))


def _dealt(batches: Iterator[pa.RecordBatch], s: Settings, role: int) -> Iterator[pa.RecordBatch]:
    """(key, role, node, rep, v): a row per table, or per visited bucket."""
    for big in batches:
        for at in range(0, big.num_rows, 256):
            for part, x in _by_length(big.slice(at, 256), 2):
                for t in range(s.tables):
                    slots, inside = places(x, t, s)
                    if role == PROBE:
                        moves, _ = visit_order(move_costs(inside, s.width), s.visits)
                        slots = slots[:, None, :] + moves
                    key = _keys(slots, t, x.shape[1])
                    who = pa.array(np.repeat(np.arange(len(x)), key[0].size)) if role == PROBE else pa.array(np.arange(len(x)))
                    n = len(who)
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.full(n, role, np.int32)), *[part.column(c).take(who) for c in (0, 1, 2)]],
                                                     names=["key", "role", "node", "rep", "v"])


def _compared(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(q, node, rep, d): for each query of each cell the k nearest of the cell's index rows."""
    for t in runs(batches, 1 << 13):
        t = t.combine_chunks()
        role, node, rep = (t.column(c).to_numpy() for c in ("role", "node", "rep"))
        vectors = t.column("v").combine_chunks()
        sizes = np.diff(vectors.offsets.to_numpy())
        found = []
        for s, e in large_groups(group_ids(t), 1):
            split = s + int(np.searchsorted(role[s:e], PROBE))  # index rows come first
            if split in (s, e):
                continue
            for dim in np.unique(sizes[s:e]).tolist():
                ix, pr = s + np.flatnonzero(sizes[s:split] == dim), split + np.flatnonzero(sizes[split:e] == dim)
                if len(ix) and len(pr):
                    x, q = _matrix(vectors.take(pa.array(ix))), _matrix(vectors.take(pa.array(pr)))
                    i, j, d = nearest_in(q, x, rep[ix], k)
                    found.append((node[pr[i]], node[ix[j]], rep[ix[j]], d))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in zip(*found)], names=["q", "node", "rep", "d"])


def candidates(index: DataFrame, probes: DataFrame, s: Settings, k: int, block: int) -> DataFrame:
    """``(q, node, rep, d)``: the k nearest classes that each query meets in the buckets it visits, best first cut per query.

    ``index`` and ``probes`` are tables (node, rep, v). A bucket is cut into cells of about ``block`` index rows by
    PROBE_BLOCK visits; a row goes to one block of its own role and meets all blocks of the other.
    """
    kind = index.schema["v"].dataType.simpleString()
    dealt = None
    for role, side in ((INDEX, index), (PROBE, probes)):
        part = side.select("node", "rep", "v").mapInArrow(partial(_dealt, s=s, role=role), f"key long, role int, node long, rep long, v {kind}")
        dealt = part if dealt is None else dealt.unionByName(part)
    met = F.col("n_i") * F.col("n_p") > 0
    sizes = cut(dealt.groupBy("key").agg(F.count(F.when(F.col("role") == INDEX, 1)).alias("n_i"), F.count(F.when(F.col("role") == PROBE, 1)).alias("n_p"))
                .where(met & ((F.col("n_i") > block) | (F.col("n_p") > PROBE_BLOCK)))
                .select("key", F.ceil(F.col("n_i") / block).cast("int").alias("g_i"), F.ceil(F.col("n_p") / PROBE_BLOCK).cast("int").alias("g_p")))
    own = F.xxhash64(F.lit(7), "node")
    cells = (F.when(F.col("g_i").isNull(), F.array(F.lit(0)))
             .when(F.col("role") == INDEX, F.transform(F.sequence(F.lit(0), F.col("g_p") - 1), lambda p: F.pmod(own, F.col("g_i")).cast("int") * F.col("g_p") + p))
             .otherwise(F.transform(F.sequence(F.lit(0), F.col("g_i") - 1), lambda i: i * F.col("g_p") + F.pmod(own, F.col("g_p")).cast("int"))))
    placed = dealt.join(small(sizes, HOT_KEYS), "key", "left").withColumn("cell", F.explode(cells)).select(*dealt.columns, "cell")
    found = placed.repartition("key", "cell").sortWithinPartitions("key", "cell", "role").mapInArrow(partial(_compared, k=k), "q long, node long, rep long, d double")
    return best(found.dropDuplicates(["q", "node"]), k)


def best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query by distance, smallest id and class; tasks cut their own rows before the shuffle."""
    first = Window.partitionBy("q").orderBy("d", "rep", "node")
    return found.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k).drop("_at")


def _truth(batches: Iterator[pa.RecordBatch], queries: list[tuple[int, np.ndarray]], k: int) -> Iterator[pa.RecordBatch]:
    """(q, node, rep, d, v): the k rows of the task nearest to each sampled query, itself left out."""
    kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field(2).type
        for part, x in _by_length(batch, 2):
            node, rep = part.column(0).to_numpy(), part.column(1).to_numpy()
            same = [(n, v) for n, v in queries if len(v) == x.shape[1]]
            if not same:
                continue
            i, j, d = nearest_in(np.array([v for _, v in same]), x, rep, k + 1)
            for at, (n, _) in enumerate(same):
                own = j[(i == at) & (node[j] != n)]
                new = (node[own], rep[own], d[(i == at) & (node[j] != n)], part.column(2).take(pa.array(own)))
                if n in kept:
                    old = kept[n]
                    new = (*[np.concatenate([a, b]) for a, b in zip(old[:3], new[:3])], pa.concat_arrays([old[3], new[3]]))
                order = np.lexsort((new[1], new[2]))[:k]
                kept[n] = (*[a[order] for a in new[:3]], new[3].take(pa.array(order)))
    for n, (node, rep, d, v) in kept.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), n)), pa.array(node), pa.array(rep), pa.array(d), v.cast(kind)], names=["q", "node", "rep", "d", "v"])


def fit(classes: DataFrame, n: int, n_queries: int, k: int, recall: float) -> Settings:
    """The cheapest settings that find ``recall`` of the true neighbours of a sample of at most SAMPLE_QUERIES queries.

    ``classes`` is a written table (node, rep, v, is_query). The queries' neighbours are exact and come from all rows; the
    share of rows a setting compares is estimated on SAMPLE_ROWS rows. Both samples are the smallest hashes of the class.
    """
    mixed = F.xxhash64(F.lit(SEED), "node"), F.col("node")
    queries = [(r.node, np.array(r.v, float)) for r in classes.where("is_query").orderBy(*mixed).limit(SAMPLE_QUERIES).select("node", "v").collect()]
    kind = classes.schema["v"].dataType.simpleString()
    near = best(classes.select("node", "rep", "v").mapInArrow(partial(_truth, queries=queries, k=k), f"q long, node long, rep long, d double, v {kind}"), k).collect()
    sample = [np.array(r.v, float) for r in classes.orderBy(*mixed).limit(SAMPLE_ROWS).select("v").collect()]
    scale = float(np.median([r.d for r in near])) if near else 0.0
    work: dict[Settings, float] = {}
    if not np.isfinite(scale) or scale <= 0:
        return EXHAUSTIVE  # no query has a neighbour, or distances leave the range of doubles
    for width in (1.0, 1.5, 2.5):
        cheapest = np.inf
        for m in range(1, 25):
            least = np.inf
            pair_found, row_met = _visited(queries, near, sample, Settings(TABLES[-1], m, width * scale, VISITS[-1]))
            for t in TABLES:
                first = np.minimum.accumulate(pair_found, axis=0)[t - 1]
                for visits in VISITS:
                    if (first < visits).mean() >= recall:
                        share = (row_met[:t] < visits).mean() * t
                        cost = t * ROW_COST * (n / n_queries + visits) + share * n
                        work[Settings(t, m, width * scale, visits)] = cost
                        least = min(least, cost)
                        break
            cheapest = min(cheapest, least)
            if least > 1.5 * cheapest or (np.min(pair_found, axis=0) < VISITS[-1]).mean() < recall:
                break  # finer buckets only cost or miss more
    return min(work, key=work.get, default=EXHAUSTIVE)


def _visited(queries: list[tuple[int, np.ndarray]], near: list, sample: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Per table, at which visit each pair (query, true neighbour) and (query, sampled row) meets; VISITS[-1] if never."""
    never = VISITS[-1]
    pairs, rows = np.full((s.tables, len(near)), never), np.full((s.tables, len(queries), len(sample)), never)
    for dim in {len(v) for _, v in queries}:
        own = [i for i, (_, v) in enumerate(queries) if len(v) == dim]
        q, sides = np.array([queries[i][1] for i in own]), []
        for vectors in ([np.array(r.v, float) for r in near], sample):
            which = np.array([i for i, v in enumerate(vectors) if len(v) == dim], int)
            sides.append((which, np.array([vectors[i] for i in which]).reshape(len(which), dim)))
        asked = np.array([near[i].q for i in sides[0][0]])
        for t in range(s.tables):
            slots, inside = places(q, t, s)
            cost = move_costs(inside, s.width)
            order = visit_order(cost, never)[1]
            found, met = (places(y, t, s)[0] for _, y in sides)
            for a, i in enumerate(own):
                mine = asked == queries[i][0]
                pairs[t, sides[0][0][mine]] = _visit_of(found[mine] - slots[a], cost[a], order[a])
                rows[t, i, sides[1][0]] = _visit_of(met - slots[a], cost[a], order[a])
    return pairs, rows


def _visit_of(move: np.ndarray, cost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The visit in which a query comes to the buckets ``move`` away from its own."""
    total = cost[np.arange(move.shape[1]), np.clip(move, -REACH, REACH) + REACH].sum(axis=1)
    visit = np.searchsorted(order, total * (1 - 1e-12))
    return np.where((np.abs(move) <= REACH).all(axis=1) & (visit < len(order)), visit, VISITS[-1])


def _classes(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(classes: node, cls, rep, v, ids, is_query; queries: vec_id, cls), written tables.

    ``ids`` holds the k + 1 smallest different ids of the class, as many as any query can need.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    if kind not in INTEGERS:
        raise ValueError(f"{id_col} must be an integer column")
    narrow = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    v = F.col(vector_col) if narrow else F.col(vector_col).cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), is_query.alias("is_query"), v.alias("v"), good.alias("good")).where("good")
    keyed = rows.select("vec_id", F.coalesce("is_query", F.lit(False)).alias("is_query"), "v", F.unhex(F.sha2(F.col("v").cast("string"), 256)).alias("cls"))
    ids = cut(keyed.select("vec_id", "is_query", "cls"))
    first = Window.partitionBy("cls").orderBy(F.col("vec_id").asc_nulls_last())
    least = (ids.withColumn("_at", F.dense_rank().over(first)).where(F.col("_at") <= k + 1)
             .groupBy("cls").agg(F.array_sort(F.collect_set(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id"))).alias("ids")))
    units = keyed.groupBy("cls").agg(F.first("v").alias("v"), F.max("is_query").alias("is_query"))
    rep = F.coalesce(F.col("ids")[0]["vec_id"].cast("long"), F.lit(NO_ID))
    classes = cut(units.join(least, "cls").select(F.monotonically_increasing_id().alias("node"), "cls", rep.alias("rep"), "v", F.col("ids.vec_id").alias("ids"), "is_query"))
    return classes, ids.where("is_query").select("vec_id", "cls").distinct()


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.97,
            settings: Settings | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` holds its k nearest other rows found, rank 1 first.

    score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id, null last. All
    other rows are candidates, queries among them; a query has fewer than k rows only if there are fewer. ``recall`` is the
    share of true neighbours aimed at when the settings are fitted (``settings`` skips that). A vector that is null, empty,
    zero or holds a null or non-finite component takes no part; vectors of different lengths never meet. Repeated rows (same
    id and vector) count once; rows with the id of a query are never its neighbours. The id column must be of an integer
    type; columns other than the two named are ignored; an empty table gives an empty result.
    """
    kind = vectors.schema[id_col].dataType
    classes, asked = _classes(vectors, is_query, id_col, vector_col, k)
    counts = classes.agg(F.count("*").alias("n"), F.count(F.when(F.col("is_query"), 1)).alias("q"), F.max(F.size("v")).alias("dim")).first()
    index, probes = classes.select("node", "rep", "v"), classes.where("is_query").select("node", "rep", "v")
    s = EXHAUSTIVE
    if counts["q"]:
        s = settings or fit(classes, counts["n"], counts["q"], k, recall)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an eighth of a task's rows, so that a large bucket is spread; at most 32 MB of vectors
    block = min(max(256, counts["n"] * s.tables // (8 * parts)), max(256, (1 << 22) // (counts["dim"] or 1)))
    found = cut(candidates(index, probes, s, k + 1, block))
    named = found.join(classes.select("node", F.explode("ids").alias("vec_id")), "node")
    order = Window.partitionBy("q").orderBy("d", F.col("vec_id").asc_nulls_last())
    lists = cut(named.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k + 1).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), "vec_id", "d"))).alias("near")))
    if s != EXHAUSTIVE:
        few = cut(probes.join(lists.where(F.size("near") > k), probes["node"] == F.col("q"), "left_anti"))
        if few.limit(1).count():
            rest = candidates(index, few, EXHAUSTIVE, k + 1, block).join(classes.select("node", F.explode("ids").alias("vec_id")), "node")
            again = rest.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k + 1).groupBy("q").agg(
                F.array_sort(F.collect_list(F.struct(F.col("_at").alias("at"), "vec_id", "d"))).alias("near"))
            lists = lists.where(F.size("near") > k).unionByName(again)
    owner = classes.where("is_query").select("cls", F.col("node").alias("q"))
    rows = asked.join(owner.join(lists, "q").select("cls", "near"), "cls")
    mine = F.slice(F.filter("near", lambda x: ~x["vec_id"].eqNullSafe(F.col("vec_id"))), 1, k)
    return (rows.select(F.col("vec_id").alias("query_id"), F.posexplode(mine).alias("_rank", "_near"))
            .select("query_id", (F.col("_rank") + 1).cast("int").alias("rank"), F.col("_near.vec_id").cast(kind).alias("vec_id"), F.col("_near.d").alias("score")))
