"""Exact k-means of whole-number vectors with a vector approximation file.

Preparing writes every vector once, as a record of fixed width, into files in the shared folder, and saves a table of approximations:
file, place and the cell of each dimension in ``BITS`` bits. The borders of the cells are quantiles of a bounded sample of
``SAMPLE`` vectors; the least and greatest entry of each dimension come from all rows. A round reads the approximations only.
Lookup tables give, per dimension and cell, the least and greatest share of the distance to each centroid; added up they are an
interval of the distance. (The share that all centroids have in common, the vector's own distance to their mean, is left out;
this makes the intervals narrow.) Where one interval ends before all others begin, the vector is assigned; only where
intervals overlap are the vectors fetched, by range reads, and compared exactly, ties to the smaller number.

Sums of clusters are kept up to date by the vectors that changed their cluster, which are fetched too. A round is a function of the
approximations and of two sets of centroids, so it writes nothing and a lost task is simply run again. All sums are whole
numbers. The last assignment fetches every vector, because its distance is part of the result.

Defined results: rows whose vector is null, of other length, or holds null or non-finite entries are dropped. Repeated keys keep
a row each; rows without a key are clustered but give no first centroid. Of equal hashes (repeated keys) the smaller vector comes first.
Fewer vectors than centroids give fewer centroids. Entries whose whole number exceeds ``LARGEST`` are an error. An empty table
gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import finite_vectors, new_folder, saved, vectors_of
from riskframe.llm.token_frames import place

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 8, 10, 1024
BITS, SAMPLE, LARGEST, GAP = 6, 4096, 1 << 24, 16


def _whole(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    values = np.floor(vectors_of(batch, dims) * scale)
    if values.size and np.abs(values).max() > LARGEST:
        raise ValueError("an entry is too large")
    return values.astype(np.int32)


def first_centroids(rows: DataFrame, key: str, k: int, scale: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:key``, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    chosen = rows.filter(F.col(key).isNotNull()).orderBy(order, "vector").limit(k).collect()
    return np.array([[int(np.floor(x * scale)) for x in r["vector"]] for r in chosen], np.int64)


class Cells:
    """Borders of the cells of each dimension and the least and greatest entry that a cell may hold."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int):
        inner = np.quantile(sample, np.arange(1, 1 << bits) / (1 << bits), axis=0, method="lower").astype(np.int64)
        self.bits, self.borders = bits, inner.T.copy()  # a cell begins at its border
        self.low = np.concatenate([least[:, None], np.maximum(self.borders, least[:, None])], axis=1)
        self.high = np.maximum(self.low, np.concatenate([self.borders - 1, greatest[:, None]], axis=1))

    def pack(self, whole: np.ndarray) -> np.ndarray:
        """The cells of each vector, ``bits`` bits per dimension."""
        cells = np.empty(whole.shape, np.uint8)
        for j, borders in enumerate(self.borders):
            cells[:, j] = np.searchsorted(borders, whole[:, j], "right")
        return np.packbits(np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :].reshape(len(whole), -1), axis=1)

    def unpack(self, packed: np.ndarray, dims: int) -> np.ndarray:
        one = np.unpackbits(packed, axis=1)[:, : dims * self.bits].reshape(len(packed), dims, self.bits)
        return one @ (1 << np.arange(self.bits - 1, -1, -1))

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(dims, cells, centroids): bounds of a dimension's share of the distance, less the share common to all centroids."""
        middle = np.round(centroids.mean(axis=0)).astype(np.int64)
        own = (centroids - middle).T[:, None, :]
        ends = [own * own - 2 * own * (bound - middle[:, None])[:, :, None] for bound in (self.low, self.high)]
        return np.minimum(*ends), np.maximum(*ends)

    def intervals(self, cells: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of every vector to every centroid."""
        below, above = self.tables(centroids)
        low = np.zeros((len(cells), len(centroids)), np.int64)
        high = low.copy()
        for j in range(cells.shape[1]):
            low += below[j].take(cells[:, j], axis=0)
            high += above[j].take(cells[:, j], axis=0)
        return low, high


def nearest(whole: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance, in whole numbers."""
    distances = np.empty((len(whole), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        distances[:, c] = np.square(whole.astype(np.int64) - centroid).sum(axis=1)
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(best)), best]


class Fetcher:
    """Reads chosen records of the vector files; neighbouring records in one range."""

    def __init__(self, folder: str, dims: int):
        (self.system, self.path), self.dims, self.fetched = place(folder), dims, 0

    def __call__(self, files: np.ndarray, slots: np.ndarray) -> np.ndarray:
        out, width = np.empty((len(slots), self.dims), np.int32), 4 * self.dims
        self.fetched += len(slots)
        for name in np.unique(files):
            at = np.flatnonzero(files == name)
            at = at[np.argsort(slots[at], kind="stable")]
            wanted = slots[at]
            runs = np.split(np.arange(len(at)), np.flatnonzero(np.diff(wanted) > GAP) + 1)
            with self.system.open_input_file(f"{self.path}/{name}") as stream:
                for run in runs:
                    start, end = int(wanted[run[0]]), int(wanted[run[-1]]) + 1
                    records = np.frombuffer(stream.read_at((end - start) * width, start * width), "<i4").reshape(-1, self.dims)
                    out[at[run]] = records[wanted[run] - start]
        return out


def _read(batch: pa.RecordBatch, cells: Cells, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """File, place and cells of each vector of a batch."""
    file, slot, packed = (batch.column(batch.schema.get_field_index(c)) for c in ("file", "slot", "cells"))
    joined = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(packed), -1)
    return np.array(file.to_pylist(), object), slot.to_numpy(), cells.unpack(joined, dims)


class Store:
    """The vector files and the saved table of approximations (key, file, slot, cells)."""

    def __init__(self, rows: DataFrame, key: str, dims: int, scale: int, bits: int, sample: int):
        self.spark, self.key, self.dims, self.folder = rows.sparkSession, key, dims, new_folder(rows.sparkSession, "vectors")
        self.kind, folder = rows.schema[key].dataType.simpleString(), self.folder
        cells = self.cells = self.spark.sparkContext.broadcast(self._cells(rows, key, dims, scale, bits, sample))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, path = place(folder)
            system.create_dir(path, recursive=True)
            name, slot = f"part-{uuid.uuid4().hex}.vectors", 0  # a repeated task writes a file of its own
            with system.open_output_stream(f"{path}/{name}") as stream:
                for batch in batches:
                    whole = _whole(batch, dims, scale)
                    stream.write(whole.astype("<i4").tobytes())
                    packed = cells.value.pack(whole)
                    columns = [batch.column(0), pa.array([name] * len(whole)), pa.array(np.arange(slot, slot + len(whole))), pa.array([p.tobytes() for p in packed], pa.binary())]
                    slot += len(whole)
                    yield pa.RecordBatch.from_arrays(columns, names=[key, "file", "slot", "cells"])

        self.rows = saved(rows.mapInArrow(run, f"`{key}` {self.kind}, file string, slot bigint, cells binary"), "cells")

    @staticmethod
    def _cells(rows: DataFrame, key: str, dims: int, scale: int, bits: int, sample: int) -> Cells:
        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [(len(w), w.min(axis=0), w.max(axis=0)) for b in batches if len(w := _whole(b, dims, scale))]
            if found:
                n, low, high = sum(f[0] for f in found), np.min([f[1] for f in found], axis=0), np.max([f[2] for f in found], axis=0)
                columns = [pa.array(x.astype(np.int64)) for x in (np.arange(dims), np.full(dims, n), low, high)]
                yield pa.RecordBatch.from_arrays(columns, names=["pos", "n", "low", "high"])

        per_task = rows.select("vector").mapInArrow(ends, "pos bigint, n bigint, low bigint, high bigint")
        bounds = sorted(per_task.groupBy("pos").agg(F.sum("n"), F.min("low"), F.max("high")).collect())
        least, greatest = (np.array([b[i] for b in bounds], np.int64) for i in (2, 3))
        order, parts = F.xxhash64(F.lit(0), F.col(key), "vector"), 1 << 30
        drawn = rows.filter(F.pmod(order, F.lit(parts)) <= 4 * sample * parts // bounds[0][1])  # few rows are sorted
        drawn = [r["vector"] for r in drawn.orderBy(order, "vector").limit(sample).select("vector").collect()]
        return Cells(np.floor(np.array(drawn, float) * scale) if drawn else np.stack([least, greatest]), least, greatest, bits)

    def reassigned(self, before: np.ndarray | None, after: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """Sums (cluster, count, sums) of what came to each cluster less what left it, one row per task and cluster, and the
        number of vectors fetched. Without earlier centroids every vector comes new."""
        folder, sent, dims, k = self.folder, self.cells, self.dims, len(after)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fetch, counts, sums, rows = Fetcher(folder, dims), np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
            for batch in batches:
                files, slots, cells = _read(batch, sent.value, dims)
                rows += len(slots)
                sides = [c for c in (before, after) if c is not None]
                picks, open_ = [], np.full(len(slots), before is None)
                for centroids in sides:
                    low, high = sent.value.intervals(cells, centroids)
                    possible = low <= high.min(axis=1)[:, None]
                    picks.append(possible.argmax(axis=1))
                    open_ |= possible.sum(axis=1) > 1
                if before is not None:
                    open_ |= picks[0] != picks[1]
                at = np.flatnonzero(open_)
                whole = fetch(files[at], slots[at])
                chosen = [nearest(whole, c)[0] for c in sides]
                moved = np.ones(len(at), bool) if before is None else chosen[0] != chosen[1]
                for clusters, sign in zip(chosen[::-1], (1, -1), strict=False):
                    counts += sign * np.bincount(clusters[moved], minlength=k)
                    np.add.at(sums, clusters[moved], sign * whole[moved].astype(np.int64))
            columns = [pa.array(np.arange(k)), pa.array(counts), pa.array(list(sums), pa.list_(pa.int64())), pa.array(np.where(np.arange(k) == 0, fetch.fetched, 0)), pa.array(np.where(np.arange(k) == 0, rows, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "count", "sums", "fetched", "seen"])

        schema = "cluster bigint, count bigint, sums array<bigint>, fetched bigint, seen bigint"
        return self.rows.select("file", "slot", "cells").mapInArrow(run, schema)

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """(key, cluster, distance) of every vector."""
        folder, sent, key, dims = self.folder, self.cells, self.key, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fetch = Fetcher(folder, dims)
            for batch in batches:
                files, slots, cells = _read(batch, sent.value, dims)
                low, high = sent.value.intervals(cells, centroids)
                possible = low <= high.min(axis=1)[:, None]
                best, whole = possible.argmax(axis=1), fetch(files, slots)
                several = possible.sum(axis=1) > 1
                best[several] = nearest(whole[several], centroids)[0]
                distance = np.square(whole.astype(np.int64) - centroids[best]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], names=[key, "cluster", "distance"])

        return self.rows.mapInArrow(run, f"`{key}` {self.kind}, cluster int, distance bigint")


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS,
    scale: int = SCALE, seed: int = 3, bits: int = BITS, sample: int = SAMPLE, report: list | None = None,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector after ``rounds`` rounds.

    ``report`` gets, per round, the number of vectors and how many of them were fetched.
    """
    rows = finite_vectors(df, key, vector, dims)
    spark: SparkSession = df.sparkSession
    centroids = first_centroids(rows, key, k, scale, seed)
    kind = df.schema[key].dataType.simpleString()
    if not len(centroids):
        schema = f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    store, before = Store(rows, key, dims, scale, bits, sample), None
    counts, sums = np.zeros(len(centroids), object), np.zeros((len(centroids), dims), object)
    for _ in range(rounds):
        parts = store.reassigned(before, centroids)
        each = parts.select("cluster", "count", "fetched", "seen", F.posexplode("sums").alias("pos", "s"))
        merged = each.groupBy("cluster", "pos").agg(*[F.sum(c).alias(c) for c in ("count", "fetched", "seen", "s")])
        found = merged.collect()
        for r in found:
            sums[r["cluster"], r["pos"]] += r["s"]
            counts[r["cluster"]] += r["count"] if r["pos"] == 0 else 0
        if report is not None:
            report.append(tuple(sum(r[c] for r in found if r["pos"] == 0) for c in ("seen", "fetched")))
        before, centroids = centroids, centroids.copy()
        for c in range(len(centroids)):
            if counts[c]:
                centroids[c] = [s // counts[c] for s in sums[c]]
    done = saved(store.assigned(centroids), "clusters")
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = done.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = done.agg(F.sum("distance")).first()[0]
    mark = F.element_at(F.array(*[F.lit(m) for m in marks]), F.col("cluster") + 1)
    # At most one row per centroid is broadcast.
    return done.join(F.broadcast(inertia), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), mark.alias("centroid_sha256")
    )


def sql(k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = 3) -> str:
    """The same result in SQL over ``embeddings``, every distance computed."""
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})""",
        f"""c0 AS (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM (
          SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}))""",
        "long AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM kept)",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
              SELECT r, c, sum((long.x - c{i}.x) * (long.x - c{i}.x))::BIGINT AS d FROM long JOIN c{i} USING (pos) GROUP BY ALL) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c, pos, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{i} LEFT JOIN (
                  SELECT c, pos, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM long JOIN a{i} USING (r) GROUP BY ALL) USING (c, pos))"""
            )
    return f"""WITH {", ".join(steps)}, marks AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS mark FROM c{rounds} GROUP BY c)
      SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
        sum(d) OVER ()::BIGINT AS inertia, mark AS centroid_sha256 FROM a{rounds} JOIN kept USING (r) JOIN marks USING (c)"""
