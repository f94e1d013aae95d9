"""Approximate nearest neighbours: NN-descent builds a graph, greedy search walks it.

Equal vectors are one node, so copies cost nothing. The first neighbours come from blocks of nodes that lie
together along random directions. Each round then joins every node with its neighbours, in both directions,
and compares these with each other: a neighbour of a neighbour is kept where it is nearer than the farthest
neighbour so far. Queries walk the graph together, one join for a step of all of them: of the nearest nodes
seen, those not yet visited send their neighbours, until the ``beam`` nearest are all visited. The nearest
found are scored again on the vectors as they are.

Nodes are dealt to tasks by hash into buckets of bounded size; graph, vectors and requests meet there as
arrays. Vectors travel in single precision, which is how embeddings are stored, and are brought to length 1
in the task: graph and walk compare in double precision, so that nearly equal vectors stay apart. No table
of vectors is sent to the driver or all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.rows import ROW, with_rows
from corpusloom.session import materialize

NEIGHBOURS = 24
REVERSE = 24  # of a node's reverse neighbours, as many take part in a round
DIRECTIONS = 3
BLOCK = 512
ROUNDS = 4
BEAM = 256
STEPS = 24  # a bound on the walk, which ends by itself long before
BUCKET = 1_024 * 64  # components of the vectors of a bucket
FINAL = 32  # nearest found nodes whose scores are computed on the vectors as they are

_EDGES = "a long, b long, s double"
_PACKED = "bucket int, a binary, b binary, s binary"


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def cosine(a: str, b: str) -> Column:
    """In double precision on the vectors themselves."""

    def dot(x: str, y: str) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0).cast("double"), lambda s, v: s + v)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _bucket(col: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _hash_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a node inside a task; nodes keep it as their own column."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(buckets)).astype(np.int64)


def _coded(vectors: np.ndarray) -> np.ndarray:
    """Each vector by its largest component, so that none is too large or too small for single precision."""
    return (vectors / np.abs(vectors).max(axis=1, keepdims=True)).astype("<f4")


def _directions(codes: bytes, n: int) -> np.ndarray:
    """The vectors of length 1 of ``n`` codes."""
    held = np.frombuffer(codes, "<f4").reshape(n, -1).astype(np.float64)
    return held / np.linalg.norm(held, axis=1, keepdims=True)


def _units(blobs: list[bytes]) -> np.ndarray:
    return _directions(b"".join(blobs), len(blobs))


def _best(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each ``a`` the ``k`` nearest different ``b``."""
    order = np.lexsort((-s, b, a))
    a, b, s = a[order], b[order], s[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, s = a[first], b[first], s[first]
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    start = np.flatnonzero(np.diff(a, prepend=a[0] - 1)) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    keep = place < k
    return a[keep], b[keep], s[keep]


def _packed(a: np.ndarray, b: np.ndarray, s: np.ndarray, buckets: int) -> pa.Table:
    """Edges as one row of arrays for each bucket of ``a``."""
    to = _hash_bucket(a, buckets)
    order = np.argsort(to, kind="stable")
    to, a, b, s = to[order], a[order], b[order], s[order]
    edges = np.flatnonzero(np.diff(to, prepend=-1))
    spans = list(zip(edges, [*edges[1:], len(to)]))
    return pa.table(
        {
            "bucket": pa.array([int(to[i]) for i, _ in spans], pa.int32()),
            "a": pa.array([a[i:j].astype("<i8").tobytes() for i, j in spans], pa.binary()),
            "b": pa.array([b[i:j].astype("<i8").tobytes() for i, j in spans], pa.binary()),
            "s": pa.array([s[i:j].astype("<f8").tobytes() for i, j in spans], pa.binary()),
        }
    )


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = []
    for name, kind in (("a", "<i8"), ("b", "<i8"), ("s", "<f8")):
        blobs = table.column(name).to_pylist()
        out.append(np.frombuffer(b"".join(blobs), kind))
    return out[0], out[1], out[2]


def _table(schema: str, *arrays: np.ndarray) -> pa.Table:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.table({n: pa.array(x) for n, x in zip(names, arrays)})


def nodes_of(rows: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """(``node``, ``bucket``, ``code``, ``vec``) of the distinct vectors, their number and the buckets."""
    distinct = rows.groupBy(F.col(vector).alias("vec")).agg(F.min(ROW).alias("node"))
    distinct = materialize(distinct, "vectors")
    count = distinct.count()
    length = distinct.agg(F.max(F.size("vec"))).first()[0] or 1
    buckets = max(8, -(-count * length // BUCKET))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            n = len(vectors)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(_hash_bucket(ids, buckets).astype(np.int32)),
                    pa.array([row.tobytes() for row in _coded(flat)], pa.binary()),
                ],
                ["node", "bucket", "code"],
            )

    coded = distinct.select("node", "vec").mapInArrow(code, "node long, bucket int, code binary")
    return materialize(coded, "codes"), distinct, buckets


def _first_neighbours(nodes: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Edges between nodes of a block, blocks being runs of nodes along random directions."""

    def project(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units = _units(batch.column(1).to_pylist())
                direction = np.random.default_rng(seed + number).standard_normal(units.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array((units @ direction).astype(np.float64))],
                    ["node", "code", "along"],
                )

        return run

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                ids, units = part.column(0).to_numpy(), _units(part.column(1).to_pylist())
                k = min(NEIGHBOURS, len(ids) - 1)
                if k < 1:
                    continue
                s = units @ units.T
                np.fill_diagonal(s, -2)
                found = np.argpartition(-s, k - 1, axis=1)[:, :k]
                near_s = np.take_along_axis(s, found, 1)
                parts.append((np.repeat(ids, k), ids[found.ravel()], near_s.ravel()))
            if parts:
                yield from _packed(*map(np.concatenate, zip(*parts)), buckets).to_batches()

    out = None
    for number in range(DIRECTIONS):
        placed = nodes.select("node", "code").mapInArrow(
            project(number), "node long, code binary, along double"
        )
        edges = (
            materialize(placed, "along")
            .repartitionByRange("along", "node")
            .sortWithinPartitions("along", "node")
            .select("node", "code")
            .mapInArrow(near, _PACKED)
        )
        out = edges if out is None else out.unionByName(edges)
    return out


def _kept(graph: DataFrame | None, packed: DataFrame) -> DataFrame:
    """The nearest neighbours of each node among the graph's edges and the new ones."""

    def merge(table: pa.Table) -> pa.Table:
        return _table(_EDGES, *_best(*_unpacked(table), NEIGHBOURS))

    if graph is not None:
        packed = packed.unionByName(graph)
    return packed.groupBy("bucket").applyInArrow(merge, _EDGES)


def _repacked(graph: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s = (batch.column(i).to_numpy() for i in range(3))
            yield from _packed(a, b, s, buckets).to_batches()

    return graph.select("a", "b", "s").mapInArrow(run, _PACKED)


def _round(nodes: DataFrame, graph: DataFrame, buckets: int, number: int) -> DataFrame:
    """One round of NN-descent: neighbours of neighbours become candidates."""
    back = graph.select(F.col("b").alias("v"), F.col("a").alias("u")).withColumn(
        "r", F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("u", F.lit(number)), "u"))
    )
    around = (
        graph.select(F.col("a").alias("v"), F.col("b").alias("u"))
        .unionByName(back.where(F.col("r") <= REVERSE).select("v", "u"))
        .distinct()
    )
    farthest = graph.groupBy(F.col("a").alias("node")).agg(
        F.when(F.count("*") >= NEIGHBOURS, F.min("s")).otherwise(F.lit(-2.0)).cast("double").alias("far")
    )
    known = nodes.join(farthest, "node").select(F.col("node").alias("u"), "code", "far")

    def compare(table: pa.Table) -> pa.Table:
        v = table.column("v").to_numpy()
        order = np.argsort(v, kind="stable")
        v = v[order]
        u, far = table.column("u").to_numpy()[order], table.column("far").to_numpy()[order]
        units = _units(table.column("code").to_pylist())[order]
        start = np.flatnonzero(np.diff(v, prepend=v[0] - 1))
        parts = []
        for i, j in zip(start, [*start[1:], len(v)]):
            s = units[i:j] @ units[i:j].T
            np.fill_diagonal(s, -3)
            x, y = np.nonzero(s > far[i:j, None])
            parts.append((u[i:j][x], u[i:j][y], s[x, y]))
        a, b, s = map(np.concatenate, zip(*parts))
        # a pair may meet at several nodes of the bucket: once is enough, and no more than fit
        return _packed(*_best(a, b, s, NEIGHBOURS), buckets)

    met = around.join(known, "u").withColumn("here", _bucket("v", buckets))
    packed = met.groupBy("here").applyInArrow(compare, _PACKED)
    return _kept(_repacked(graph, buckets), packed)


def build_graph(nodes: DataFrame, buckets: int, seed: int = 7, rounds: int = ROUNDS) -> DataFrame:
    """(``a``, ``b``, ``s``): each node's nearest neighbours found and their nearness."""
    graph = materialize(_kept(None, _first_neighbours(nodes, buckets, seed)), "graph")
    for number in range(rounds):
        graph = materialize(_round(nodes, graph, buckets, number), "graph")
    return graph


_STATE = "bucket int, q long, code binary, ids binary, s binary, seen binary, open boolean"


def _walk(nodes: DataFrame, graph: DataFrame, queries: DataFrame, buckets: int, beam: int) -> DataFrame:
    """(``q``, ``ids``, ``s``): the nearest nodes found for each query node."""
    coded = graph.join(nodes.select(F.col("node").alias("b"), "code"), "b")

    def pack(table: pa.Table) -> pa.Table:
        """A node's neighbours and their codes, as one row."""
        a = table.column("a").to_numpy()
        order = np.argsort(a, kind="stable")
        a, b = a[order], table.column("b").to_numpy()[order]
        codes = np.array(table.column("code").to_pylist(), dtype=object)[order]
        start = np.flatnonzero(np.diff(a, prepend=a[0] - 1))
        spans = list(zip(start, [*start[1:], len(a)]))
        return pa.table(
            {
                "bucket": pa.array(_hash_bucket(a[start], buckets).astype(np.int32)),
                "a": pa.array(a[start]),
                "ids": pa.array([b[i:j].astype("<i8").tobytes() for i, j in spans], pa.binary()),
                "codes": pa.array([b"".join(codes[i:j]) for i, j in spans], pa.binary()),
            }
        )

    index = materialize(
        coded.withColumn("here", _bucket("a", buckets))
        .groupBy("here")
        .applyInArrow(pack, "bucket int, a long, ids binary, codes binary"),
        "index",
    )
    requests = "bucket int, q long, code binary, wanted binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The unvisited of the nearest nodes of each query, by bucket."""
        for batch in batches:
            rows = []
            for q, code, ids, s, seen in zip(*(batch.column(i).to_pylist() for i in range(5))):
                i, x = np.frombuffer(ids, "<i8"), np.frombuffer(s, "<f8")
                new = i[np.argsort(-x, kind="stable")[:beam]]
                new = np.setdiff1d(new, np.frombuffer(seen, "<i8"))
                to = _hash_bucket(new, buckets)
                for bucket in np.unique(to):
                    rows.append((int(bucket), q, code, new[to == bucket].astype("<i8").tobytes()))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "q", "code", "wanted"]
            )

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        """For each request, the neighbours of the wanted nodes and their nearness."""
        where = {a: i for i, a in enumerate(held.column("a").to_pylist())}
        ids, codes = held.column("ids").to_pylist(), held.column("codes").to_pylist()
        out: list[tuple] = []
        for q, code, wanted in zip(*(asked.column(n).to_pylist() for n in ("q", "code", "wanted"))):
            places = [where[w] for w in np.frombuffer(wanted, "<i8").tolist() if w in where]
            if not places:
                continue
            b = np.frombuffer(b"".join([ids[p] for p in places]), "<i8")
            block = np.frombuffer(b"".join([codes[p] for p in places]), "<f4").reshape(len(b), -1)
            b, first = np.unique(b, return_index=True)
            s = _directions(block[first].tobytes(), len(b)) @ _units([code])[0]
            other = b != q
            out.append((q, b[other].astype("<i8").tobytes(), s[other].astype("<f8").tobytes()))
        columns = list(zip(*out)) if out else [[], [], []]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("q", "ids", "s"), columns, kinds)})

    def merge(state: pa.Table, answers: pa.Table) -> pa.Table:
        """Take in the answers, of all queries of a bucket."""
        came: dict[int, list[tuple[bytes, bytes]]] = {}
        for q, i, s in zip(*(answers.column(n).to_pylist() for n in ("q", "ids", "s"))):
            came.setdefault(q, []).append((i, s))
        out = []
        fields = ("bucket", "q", "code", "ids", "s", "seen")
        for bucket, q, code, ids, s, seen in zip(*(state.column(n).to_pylist() for n in fields)):
            i, x, v = np.frombuffer(ids, "<i8"), np.frombuffer(s, "<f8"), np.frombuffer(seen, "<i8")
            asked = np.setdiff1d(i[np.argsort(-x, kind="stable")[:beam]], v)
            v = np.union1d(v, asked)
            more = came.get(q, [])
            i = np.concatenate([i, *[np.frombuffer(m[0], "<i8") for m in more]])
            x = np.concatenate([x, *[np.frombuffer(m[1], "<f8") for m in more]])
            i, first = np.unique(i, return_index=True)
            x = x[first]
            order = np.argsort(-x, kind="stable")[: 2 * beam]  # what is farther can never be visited
            i, x = i[order], x[order]
            left = len(np.setdiff1d(i[:beam], v)) > 0
            out.append(
                (bucket, q, code, i.astype("<i8").tobytes(), x.astype("<f8").tobytes(), v.astype("<i8").tobytes(), left)
            )
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_())
        columns = list(zip(*out)) if out else [[] for _ in kinds]
        return pa.table({n: pa.array(c, k) for n, c, k in zip((*fields, "open"), columns, kinds)})

    begin = graph.join(queries.select(F.col("node").alias("a")), "a", "left_semi")

    def start(table: pa.Table) -> pa.Table:
        a, b, s = (table.column(n).to_numpy() for n in ("a", "b", "s"))
        order = np.argsort(a, kind="stable")
        a, b, s = a[order], b[order], s[order]
        first = np.flatnonzero(np.diff(a, prepend=a[0] - 1))
        spans = list(zip(first, [*first[1:], len(a)]))
        return pa.table(
            {
                "q": pa.array(a[first]),
                "ids": pa.array([b[i:j].astype("<i8").tobytes() for i, j in spans], pa.binary()),
                "s": pa.array([s[i:j].astype("<f8").tobytes() for i, j in spans], pa.binary()),
            }
        )

    own = begin.withColumn("here", _bucket("a", buckets)).groupBy("here").applyInArrow(
        start, "q long, ids binary, s binary"
    )
    state = materialize(
        own.join(nodes.select(F.col("node").alias("q"), "bucket", "code"), "q").select(
            "bucket", "q", "code", "ids", "s", F.lit(b"").alias("seen"), F.lit(True).alias("open")
        ),
        "walk",
    )
    done = []
    for _ in range(STEPS):
        going = state.where("open")
        if going.isEmpty():
            break
        asked = going.select("q", "code", "ids", "s", "seen").mapInArrow(ask, requests)
        answers = (
            index.groupBy("bucket")
            .cogroup(asked.groupBy("bucket"))
            .applyInArrow(answer, "q long, ids binary, s binary")
            .withColumn("bucket", F.pmod(F.xxhash64("q"), F.lit(buckets)).cast("int"))
        )
        own = going.withColumn("here", F.pmod(F.xxhash64("q"), F.lit(buckets)).cast("int"))
        state = materialize(
            own.groupBy("here").cogroup(answers.groupBy("bucket")).applyInArrow(merge, _STATE), "walk"
        )
        done.append(state.where(~F.col("open")))
    done.append(state.where("open"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("q", "ids", "s")


def _nearest_ids(rows: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """Of each distinct vector the ``k + 1`` smallest keys: as many as one query can return, and its own."""
    part = Window.partitionBy("vec", F.pmod(F.xxhash64(ROW), F.lit(64))).orderBy("key")
    whole = Window.partitionBy("vec").orderBy("key")
    keyed = rows.select(F.col(vector).alias("vec"), F.col(key).alias("key"), ROW).where("key is not null")
    few = keyed.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    return few.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1).select("vec", "key")


def search(
    vectors: DataFrame,
    query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    beam: int = BEAM,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(``query_id``, ``rank``, key, ``score``): the ``k`` nearest rows found for each row that is a query.

    Nearness is the largest cosine, ties go to the smaller key; a row is no neighbour of its own key. Rows
    whose vector is null, empty, zero or holds a null or non-finite component take no part, nor do rows
    without key or vectors of another length than most. With fewer candidates than ``k`` all are returned.
    Repeated rows count once. An empty table gives an empty table.
    """
    rows = vectors.where(usable(vector)).where(F.col(key).isNotNull())
    rows = rows.select(F.col(key), F.col(vector), query.alias("__query")).distinct()
    lengths = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = with_rows(rows.where(F.size(vector) == (lengths["n"] if lengths else 0)), "vectors")
    nodes, distinct, buckets = nodes_of(rows, vector)
    graph = build_graph(nodes, buckets, rounds=rounds)
    asking = materialize(
        rows.where("__query")
        .join(distinct, F.col(vector) == F.col("vec"))
        .select(F.col(key).alias("query_id"), "node"),
        "queries",
    )
    found = _walk(nodes, graph, asking.select("node").distinct(), buckets, beam)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, node = [], []
            for one, ids, s in zip(*(batch.column(i).to_pylist() for i in range(3))):
                i, x = np.frombuffer(ids, "<i8"), np.frombuffer(s, "<f8")
                best = i[np.argsort(-x, kind="stable")[: max(FINAL, 2 * k)]].tolist()
                q += [one] * len(best)
                node += best
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(node, pa.int64())], ["q", "node"])

    pairs = found.mapInArrow(nearest, "q long, node long")
    # equal vectors are as near as can be
    pairs = pairs.unionByName(asking.select(F.col("node").alias("q"), "node")).distinct()
    left = distinct.select(F.col("node").alias("q"), F.col("vec").alias("va"))
    right = distinct.select("node", F.col("vec").alias("vb"))
    scored = materialize(
        pairs.join(left, "q").join(right, "node").select("q", "vb", cosine("va", "vb").alias("score")), "scored"
    )
    members = _nearest_ids(rows, key, vector, k)
    candidates = (
        asking.join(scored, F.col("node") == F.col("q"))
        .join(members, F.col("vb") == F.col("vec"))
        .where(F.col("key") != F.col("query_id"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("key").alias(key), "score")
    )
