"""Reports over written layouts and by other ways: a bucketed stage table, logs by month, logs that are not cut to the
parcels first. Their statements are those of the reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelspark.plans import backlog, cargo, claims
from parcelspark.sources import daylogs, stages
from parcelspark.sources.states import shared_folder
from registry.base import ALL_DAYS, AS_OF, ORACLES, QUERIES, comparable
from registry.job_cases import _SYSTEM_DATES, SHORT_DAYS
from registry.standins import Standins

# Hot bags of the given tables are small; the limit lets the largest take the way of hot ones.
BUCKETS, HOT_BAG = 16, 40
LOGS = {
    "waybill_waybill_line": "record_time",
    "dm_waybill_waybill_line": "record_time",
    "waybill_problem_piece": "operation_time",
    "waybill_return_bill": "return_record_time",
}


def same_as(report: str, name: str) -> Callable:
    def register(build: Callable[[Standins], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Standins.at(spark, sf_dir)))

        QUERIES[name], ORACLES[name] = run, ORACLES[report]
        return build

    return register


def _folder(s: Standins, kind: str) -> str:
    return f"{shared_folder(s.spark)}/{kind}-{uuid.uuid4().hex}"


def _system(s: Standins) -> stages.Stage:
    system = cargo.smu_system(s, AS_OF, **_SYSTEM_DATES)
    return cargo.stage_system(system, _folder(s, "system"), BUCKETS, HOT_BAG)


@same_as("d11_smu_system", "d11_staged")
def _(s):
    return cargo.smu_system_sorted(_system(s).rows())


@same_as("d9_smu_bag_level", "d9_staged")
def _(s):
    return cargo.smu_bag_level(cargo.smu_hub_names(s), _system(s))


@same_as("d12_smu_waybill_level", "d12_staged")
def _(s):
    return cargo.smu_waybill_level(s, _system(s))


@same_as("d2_backlog_ops", "d2_partitioned_logs")
def _(s):
    root = _folder(s, "logs")
    for name, ts in LOGS.items():
        daylogs.write_log(s[name], f"{root}/{name}", ts, "month")
    return backlog.backlog_ops(daylogs.with_logs(s, root, LOGS, "month"), AS_OF, days=ALL_DAYS)


@same_as("d6_everpro_claims", "d6_uncut_logs")
def _(s):
    return claims.everpro_claims(s, AS_OF, days=ALL_DAYS, scan_days=SHORT_DAYS, cut_logs=False)


@same_as("d7_mengantar_claims", "d7_uncut_logs")
def _(s):
    return claims.mengantar_claims(s, AS_OF, days=ALL_DAYS, cut_logs=False)
