"""Joins against summary tables whose size is checked before they are broadcast, and joins with very frequent keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from riskframe.session import materialize

BROADCAST_BYTES = 16 << 20
#: Counters of the frequent-item sketch; its error is a few rows in as many thousand.
TRACKED = 4096
#: Bytes of text that one task takes of rows dealt by key.
TASK_BYTES = 16 << 20
#: Rows that a task gets at least, and at most, of rows dealt evenly.
LEAST_ROWS, MOST_ROWS = 256, 1 << 19


def saved_bytes(saved: DataFrame) -> int:
    """Bytes of a saved table: fixed widths, and the measured length of texts and nested values."""
    sizes = []
    for name, kind in saved.dtypes:
        nested = kind.startswith(("array", "map", "struct"))
        text = F.to_json(F.struct(name)) if nested else F.col(name) if kind in ("string", "binary") else None
        sizes.append(F.lit(16) if text is None else F.coalesce(F.octet_length(text), F.lit(0)) + 24)
    return saved.agg(F.sum(sum(sizes, F.lit(16)).cast("long"))).first()[0] or 0


def lookup_join(
    big: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a large table with a per-key summary of it (one row per key).

    The summary is computed once and saved. When its rows take at most ``max_bytes`` it is broadcast, so
    the large side is not shuffled. Otherwise it is a ``skewed_join``.
    """
    saved = materialize(summary)
    if saved_bytes(saved) <= max_bytes:
        return big.join(F.broadcast(saved), keys, how)
    return skewed_join(big, saved, keys, how)


def _key_hash(keys: Sequence[str], types: dict[str, DataType]) -> Column:
    return F.xxhash64(*[F.col(k).cast(types[k]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None, tracked: int = TRACKED) -> list[tuple[int, int]]:
    """Hashes of the keys that hold more rows than a task gets on average, with the number of tasks each one fills.

    The counts come from a mergeable frequent-item sketch: one pass, ``tracked`` counters whatever the number of keys. At most ``tasks``
    keys can be so frequent, so the list is short.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = {k: df.schema[k].dataType for k in keys}
    hashed = df.select(_key_hash(keys, types).alias("_h"))
    top = F.expr(f"approx_top_k(_h, {min(tasks, tracked)}, {tracked})")
    found = hashed.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    mean = max(1, found["n"] // tasks)
    return [(r["item"], -(-r["count"] // mean)) for r in found["top"] or [] if r["count"] > mean]


@dataclass
class Dealing:
    """How rows are dealt by a key: over how many tasks, and the hashes of the keys that are too frequent for one."""

    key: str
    tasks: int
    hot: list[int]

    @classmethod
    def of(cls, df: DataFrame, key: str, size: Column, task_bytes: int = TASK_BYTES) -> Dealing:
        """As many tasks as keep the sum of ``size`` in one near ``task_bytes``; frequent keys as ``hot_keys`` says. ``df`` is read once."""
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hashed = df.select(_key_hash([key], {key: df.schema[key].dataType}).alias("_h"), size.cast("long").alias("_size"))
        top = F.expr(f"approx_top_k(_h, {TRACKED}, {TRACKED})")
        found = hashed.agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("bytes"), top.alias("top")).first()
        tasks = max(tasks, -(-int(found["bytes"] or 0) // task_bytes))
        mean = max(1, found["n"] // tasks)
        return cls(key, tasks, [r["item"] for r in found["top"] or [] if r["count"] > mean])

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The rows of the usual keys, all rows of a key in one task, and the rows of the others (None without any)."""
        if not self.hot:
            return df.repartition(self.tasks, self.key), None
        frequent = _key_hash([self.key], {self.key: df.schema[self.key].dataType}).isin(self.hot)  # at most one key per task
        return df.filter(~frequent).repartition(self.tasks, self.key), df.filter(frequent)


def dealt_by_key(df: DataFrame, key: str, size: Column, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the usual keys, all rows of a key in one task, and the rows of the keys that are too frequent for that (None without any).

    Grouping the first by the key and anything else, or a window over the key, needs no further shuffle. They are dealt over as many tasks
    as keep the sum of ``size`` in one near ``task_bytes``. ``df`` is read once more for the sizes and the frequent keys.
    """
    return Dealing.of(df, key, size, task_bytes).split(df)


def evenly(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores alike. For a fit of many passes, whose shuffles grow with the number of tasks: so no more tasks than
    cores, or whole rounds of them for very many rows. Other plans hand on few tasks for rows of few bytes, whatever a pass does with them.
    ``df`` is read once more to count it."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, -(-rows // (cores * MOST_ROWS)))
    return df.repartition(max(1, min(cores * rounds, rows // LEAST_ROWS)))


def skewed_join(
    big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", tasks: int | None = None
) -> DataFrame:
    """Equi-join whose ``big`` side may have keys with very many rows: ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    Only the frequent keys are salted on the one side and copied on the other, each over as many tasks as its rows fill. All other keys,
    and tables without frequent keys, are joined as usual. ``big`` is read twice.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a skewed join cannot be {how}")
    keys, spark = list(keys), big.sparkSession
    hot = hot_keys(big, keys, tasks)
    if not hot:
        return big.join(other, keys, how)
    table = F.broadcast(spark.createDataFrame(hot, "_h bigint, _copies int"))  # at most one row per task
    types = {k: big.schema[k].dataType for k in keys}
    spread = F.xxhash64(*[F.col(c) for c, t in big.dtypes if "map<" not in t])
    salted = big.withColumn("_h", _key_hash(keys, types)).join(table, "_h", "left")
    salted = salted.withColumn("_salt", F.coalesce(F.pmod(spread, F.col("_copies")), F.lit(0)).cast("int"))
    copied = other.withColumn("_h", _key_hash(keys, types)).join(table, "_h", "left")
    salts = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    copied = copied.withColumn("_salt", F.explode(salts)).drop("_h", "_copies")
    joined = salted.drop("_h", "_copies").join(copied, [*keys, "_salt"], how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in other.columns if c not in keys]
    return joined.select(*big.columns, *added)
