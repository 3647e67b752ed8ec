"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt by length (norm) into buckets of at most ``BUCKET`` vectors, longest first, and ``NEAR``
neighbouring buckets form a group; queries are dealt alike into blocks of at most ``BLOCK``.  A query starts with
a threshold, its k-th best score among the longest bucket (a bounded row, which is broadcast).  For a bucket with
longest norm l the query q needs a cosine of ``threshold / (|q| l)`` at least, its local threshold:

* above 1 no vector of the bucket can score enough, and the bucket is left out; where that holds for all queries
  of a block and all buckets of a group, the block isn't sent to the group at all;
* where the coordinates that hold most of a block's length leave so little of it and of the bucket's vectors that
  their remainders' product is at most ``SPARE`` of the local threshold, products are taken over those coordinates
  alone, and by Cauchy-Schwarz only pairs with ``partial + |q rest| |v rest| >= threshold`` are verified on the
  others (coordinate pruning);
* else candidates are the bucket's vectors that are long enough (length pruning).

Products of what is left are exact integers.  Thresholds rise while a worker goes through its buckets; the best
k of each worker are merged by query.  A group's buckets go to one task once and stay there while blocks of
queries stream past them, so a vector is shuffled once and a query once for each group that it may have a
neighbour in; no pair of a block and a bucket is ever a row.

Defined results: a null vector, or one with a null, NaN or infinite component, takes no part; vectors of other
dimension count as filled up with zeros; a null id takes no part.  Each row of ``queries`` is a query of its own,
with its own ranks; rows of equal ids are candidates one by one, and are all left out for queries with that id.
Ties go to the smaller id.  Components beyond the 64-bit range count as its ends; sums are exact however large, and
a score beyond the 64-bit range is given as its end.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import setting, stored

#: Vectors in a bucket, queries in a block, buckets in a group.
BUCKET, BLOCK, NEAR = 1024, 256, 16
#: Coordinate pruning pays if the remainders' product is expected to be at most this share of the local threshold.
SPARE = 0.55
#: Largest product sum that floating point holds exactly.
_EXACT = 2.0**53
#: Numbers that verification holds at once.
_AT_ONCE = 1 << 21
ROW = "id binary, vectors binary, dims int, rows int, longest double, part int, place int"


def _grouped(vectors: DataFrame, most: int, parts: int) -> DataFrame:
    """Rows of at most ``most`` vectors of like norm; ``vectors``: id, v (array<bigint>), norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def made(t: pa.Table) -> pa.RecordBatch:
            rows = t.num_rows
            lists = t.column("v").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            dims = int(sizes.max(initial=0))
            x = np.zeros((rows, dims), np.int64)
            x[np.arange(dims)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
            ids = t.column("id").to_numpy().astype("<i8")
            if rows and np.abs(x).max(initial=0) < 2**15:
                x = x.astype("<i2")
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([dims], pa.int32()), pa.array([rows], pa.int32()), pa.array([float(t.column("norm").to_numpy().max())]), pa.array([part], pa.int32()), pa.array([place], pa.int32())],
                ["id", "vectors", "dims", "rows", "longest", "part", "place"],
            )

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= most:
                t = pa.Table.from_batches(held)
                yield made(t.slice(0, most))
                place += 1
                held = t.slice(most).to_batches()
        t = pa.Table.from_batches(held) if held else None
        if t is not None and t.num_rows:
            yield made(t)

    dealt = vectors.repartitionByRange(parts, F.col("norm").desc(), F.xxhash64("id"), "id").sortWithinPartitions(F.col("norm").desc(), "id")
    return dealt.select("id", "v", "norm").mapInArrow(run, ROW)


def _matrix(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    rows, dims, data = row[prefix + "rows"], row[prefix + "dims"], row[prefix + "vectors"]
    kind = "<i2" if len(data) == 2 * rows * dims else "<i8"
    return np.frombuffer(row[prefix + "id"], "<i8"), np.frombuffer(data, kind).reshape(rows, dims).astype(np.int64)


class Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int) -> None:
        self.ids, self.x, self.k = ids, x, k
        self.norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        self.top: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, y: np.ndarray) -> tuple[int, int]:
        """A bucket's vectors.  Products that length leaves, and those of them verified in full."""
        d = min(self.x.shape[1], y.shape[1])
        x, y = self.x[:, :d], y[:, :d]
        real = y.astype(np.float64)
        norm = np.sqrt((real**2).sum(1))
        longest = norm.max(initial=0.0)
        slack = 1e-9
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(self.norm * longest > 0, self.floor / (self.norm * longest), np.where(self.floor > 0, np.inf, -np.inf))
        at = np.flatnonzero(need <= 1 + slack)
        if not len(at) or not len(ids):
            return 0, 0
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(self.norm[at] > 0, self.floor[at] / self.norm[at], -np.inf).min()
        kept = np.flatnonzero(norm >= least * (1 - slack)) if least > 0 else np.arange(len(norm))
        bound = float(np.abs(x[at]).max(initial=0)) * float(np.abs(y[kept]).max(initial=0)) * max(d, 1)
        if bound >= _EXACT:
            # floating point would not hold the sums; Python's integers hold any
            whole = (x[at] @ y[kept].T) if bound < 2.0**62 else x[at].astype(object) @ y[kept].T.astype(object)
            for i, q in enumerate(at):
                self._take(q, ids[kept], whole[i])
            return len(at) * len(kept), len(at) * len(kept)
        some, other = x[at].astype(np.float64), real[kept]
        order = np.argsort(-(some**2).sum(0), kind="stable")
        focus = self._focus(some[:, order], other[:, order], self.norm[at], float(need[at].min()))
        first, rest = order[:focus], order[focus:]
        scores = some[:, first] @ other[:, first].T
        floor = self.floor[at]
        if not len(rest):
            enough = scores >= floor[:, None]
        else:
            left = np.sqrt((some[:, rest] ** 2).sum(1)) * (1 + slack)
            enough = scores + left[:, None] * np.sqrt((other[:, rest] ** 2).sum(1))[None, :] >= floor[:, None] - slack * np.abs(floor)[:, None]
        i, j = np.nonzero(enough)
        if len(rest):
            u, v = some[:, rest], other[:, rest]
            step = max(1, _AT_ONCE // len(rest))
            for k in range(0, len(i), step):
                a, b = i[k : k + step], j[k : k + step]
                scores[a, b] += np.einsum("ij,ij->i", u[a], v[b])
        edge = np.searchsorted(i, np.arange(len(at) + 1))
        for n, q in enumerate(at):
            found = j[edge[n] : edge[n + 1]]
            if len(found):
                self._take(q, ids[kept[found]], scores[n, found].astype(np.int64))
        return len(at) * len(kept), len(i) if len(rest) else len(at) * len(kept)

    def _focus(self, x: np.ndarray, y: np.ndarray, norm: np.ndarray, need: float) -> int:
        """How many leading coordinates decide most pairs; all of them where the local threshold is too low for that."""
        d = x.shape[1]
        if not np.isfinite(need) or need <= 0:
            return d
        of_x = 1 - np.cumsum((x**2).sum(0)) / max((norm**2).sum(), 1.0)
        total = (y**2).sum()
        of_y = 1 - np.cumsum((y**2).sum(0)) / total if total > 0 else np.zeros(d)
        enough = np.flatnonzero(np.sqrt(np.maximum(of_x, 0) * np.maximum(of_y, 0)) <= SPARE * need)
        focus = int(enough[0]) + 1 if len(enough) else d
        return focus if 8 * focus <= 7 * d else d

    def _take(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = ids != self.ids[q]
        if len(self.top[q]) == self.k:
            good &= (scores >= self.top[q][-1][0] * -1).astype(bool)
        ids, scores = ids[good], scores[good]
        if not len(ids):
            return
        top = sorted([*self.top[q], *zip((-scores).tolist(), ids.tolist(), strict=True)])[: self.k]
        self.top[q] = top
        if len(top) == self.k:
            worst = -top[-1][0]
            self.floor[q] = max(self.floor[q], float(worst) if abs(worst) < _EXACT else np.nextafter(float(worst), -np.inf))


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best of ``vectors`` for each row of ``queries``.

    Components are taken as ``floor(scale * x)``.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def taken(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        good = df.select(F.col(key).cast("long").alias("id"), v.alias("x")).where("id is not null and x is not null and not exists(x, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
        v = F.transform("x", lambda c: F.floor(c * scale))
        return good.select("id", v.alias("v")).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))

    buckets = stored(_grouped(taken(vectors), BUCKET, parts))
    blocks = stored(_grouped(taken(queries), BLOCK, max(1, parts // 4)))
    first = buckets.orderBy(F.col("longest").desc(), "part", "place").limit(1).collect()
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seed = spark.sparkContext.broadcast(first[0].asDict())

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                best = Best(*_matrix(row), k)
                best.meet(*_matrix(seed.value))
                with np.errstate(divide="ignore", invalid="ignore"):
                    needed = np.where(best.norm > 0, best.floor / best.norm, -np.inf)
                out.append((best.floor.astype("<f8").tobytes(), float(needed.min(initial=np.inf))))
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a, pa.binary()), pa.array(b, pa.float64())], [*batch.schema.names, "floor", "needed"])

    # groups are numbered part by part: as many numbers here as there are partitions
    sizes = {r.part: r.n for r in buckets.groupBy("part").agg(F.max(F.floor(F.col("place") / NEAR) + 1).alias("n")).collect()}
    first_of, groups = {}, 0
    for part in sorted(sizes):
        first_of[part], groups = groups, groups + sizes[part]
    start = F.element_at(F.create_map(*(F.lit(int(x)) for pair in first_of.items() for x in pair)), F.col("part"))
    bucket = buckets.withColumn("group", (start + F.floor(F.col("place") / NEAR)).cast("int"))
    heads = bucket.groupBy("group").agg(F.max("longest").alias("group_longest"))
    block = stored(blocks.mapInArrow(floors, ROW + ", floor binary, needed double"))
    sent = block.select("part", "place", "needed", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).join(heads, "group").where(F.col("group_longest") * (1 + 1e-9) >= F.col("needed")).select("part", "place", "group")
    names = ["group", "kind", *buckets.columns, "floor"]
    asked = block.join(sent, ["part", "place"]).withColumn("kind", F.lit(1)).select(names)
    held = bucket.withColumns({"kind": F.lit(0), "floor": F.lit(None).cast("binary")}).select(names)
    met = held.union(asked).repartition("group").sortWithinPartitions("group", "kind", "part", "place")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a group's buckets are held, at most NEAR of them; a block's results are given out when it has met them all
        at, of_group = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                if row["group"] != at:
                    at, of_group = row["group"], []
                if not row["kind"]:
                    of_group.append(_matrix(row))
                    continue
                best = Best(*_matrix(row), k)
                best.floor = np.frombuffer(row["floor"], "<f8").copy()
                for ids, y in of_group:
                    best.meet(ids, y)
                found = [(row["part"], row["place"], m, int(best.ids[m]), i, max(-(2**63), min(2**63 - 1, -s)), r) for m, top in enumerate(best.top) for r, (s, i) in enumerate(top)]
                columns = zip(*found, strict=True) if found else ((),) * 7
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["part", "place", "row", "query_id", "vec_id", "score", "r"])

    # a row here is a block or a bucket, up to some hundred KB: few of them go to Python at once
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "16"):
        found = stored(met.mapInArrow(meet, "part long, place long, row long, query_id long, vec_id long, score long, r long"))
    order = Window.partitionBy("part", "place", "row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_topk(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))


OP3_SQL = """
WITH taken AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM taken q JOIN taken c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
