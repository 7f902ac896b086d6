"""Deterministic splits and samples."""

from __future__ import annotations

from riskframe.operators import split
from riskframe.plans.catalog.registry import query


def _ranked(table: str, key: str, label: str) -> str:
    return f"""
    SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat('42:', {key})), {key}) AS r,
      count(*) OVER (PARTITION BY {label}) AS n
    FROM {table}
    """


@query(
    "split_stratified",
    f"SELECT o_orderkey, o_orderstatus, r <= floor(n * 0.8) AS is_train FROM ({_ranked('orders', 'o_orderkey', 'o_orderstatus')}) x",
)
def split_stratified(v):
    return split.stratified_split(v.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


@query(
    "split_stratified_patients",
    f"SELECT patient_id, final_diagnosis, r <= floor(n * 0.8) AS is_train FROM ({_ranked('truth', 'patient_id', 'final_diagnosis')}) x",
)
def split_stratified_patients(v):
    return split.stratified_split(v.truth.select("patient_id", "final_diagnosis"), "final_diagnosis")


@query(
    "sample_per_class",
    f"SELECT o_orderkey, o_orderpriority FROM ({_ranked('orders', 'o_orderkey', 'o_orderpriority')}) x WHERE r <= 200",
)
def sample_per_class(v):
    return split.sample_per_class(v.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", 200, "o_orderkey")


_NUMBER = "('0x' || substr(md5(concat('42:', {key})), 1, 8))::BIGINT"


@query(
    "split_random",
    f"SELECT event_id, {_NUMBER.format(key='event_id')} < {int(0.8 * 2**32)} AS is_train FROM events",
)
def split_random(v):
    return split.random_split(v.events.select("event_id"), "event_id")


@query("fold_assignment", f"SELECT patient_id, CAST({_NUMBER.format(key='patient_id')} % 5 AS INT) AS fold FROM truth")
def fold_assignment(v):
    return split.with_fold(v.truth.select("patient_id"))
