"""Running whole layers: raw to bronze to silver to gold."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from kimberlite.plans import gold, silver
from kimberlite.sources.lake import BRONZE, GOLD, SILVER, Lake
from kimberlite.sources.raw import ingest, list_raw
from kimberlite.sources.scratch import staging

logger = logging.getLogger(__name__)

JOBS_AT_ONCE = 4


class LayerFailed(RuntimeError):
    """Some tables of a layer failed; the others were written."""

    def __init__(self, layer: str, failures: Mapping[str, str], rows: Mapping[str, int]):
        super().__init__(f"{layer}: {len(failures)} tables failed: {', '.join(sorted(failures))}")
        self.failures, self.rows = dict(failures), dict(rows)


@dataclass(frozen=True)
class Job:
    """One table to write, and the tables (``layer.table``) that it is built from."""

    layer: str
    name: str
    build: Callable[[], DataFrame]
    inputs: Sequence[str] = ()
    partition_by: Sequence[str] = ()

    @property
    def table(self) -> str:
        return f"{self.layer}.{self.name}"


class LakeTables:
    """Model inputs read from a lake."""

    def __init__(self, lake: Lake):
        self.spark = lake.spark
        self._lake = lake

    def silver(self, name: str) -> DataFrame:
        return self._lake.read(SILVER, name)

    def gold(self, name: str) -> DataFrame:
        return self._lake.read(GOLD, name)


def run_in_order(
    names: Sequence[str],
    needs: Mapping[str, Sequence[str]],
    run: Callable[[str], object],
) -> tuple[dict, dict[str, str]]:
    """Call ``run`` for every name as soon as its inputs are done, whatever else still runs.

    Returns the results and, for names that failed or whose input failed, the reason.
    """
    done: dict = {}
    failures: dict[str, str] = {}
    open_inputs = {n: set(needs.get(n, ())) for n in names}
    users: dict[str, list[str]] = {}
    for name, inputs in open_inputs.items():
        for i in inputs:
            users.setdefault(i, []).append(name)

    def fail(name: str, reason: str) -> None:
        if name not in failures:
            failures[name] = reason
            for user in users.get(name, ()):
                fail(user, "an input failed")

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = {pool.submit(run, n): n for n, inputs in open_inputs.items() if not inputs}
        while running:
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for job in ended:
                name = running.pop(job)
                if job.exception() is not None:
                    fail(name, str(job.exception()))
                    continue
                done[name] = job.result()
                for user in users.get(name, ()):
                    open_inputs[user].discard(name)
                    if not open_inputs[user] and user not in failures:
                        running[pool.submit(run, user)] = user
    waiting = [n for n in names if n not in done and n not in failures]
    if waiting:
        raise ValueError(f"inputs of {waiting} are not among the tables to run")
    return done, failures


def run_jobs(lake: Lake, jobs: Sequence[Job], what: str, run: str = "") -> dict[str, int]:
    """Write every table and return the row counts by ``layer.table``.

    A table that fails is logged and skipped with everything built on it; one
    error at the end names all of them. Inputs that are not among the jobs are
    read as the lake has them.

    With a name for the ``run``, a table whose newest commit was written under
    that name, from the commits of its inputs that count now, isn't written
    again: a load that is started again under its name goes on where it ended.
    """
    known = {j.table: j for j in jobs}

    def write(table: str) -> int:
        job = known[table]
        inputs = {}
        for i in job.inputs:
            commit = lake.newest(*i.split(".", 1))
            if commit is not None:
                inputs[i] = commit.number
        newest = lake.newest(job.layer, job.name) if run else None
        if newest is not None and newest.run == run and newest.inputs == inputs:
            logger.info("%s: %d rows, written before", table, newest.rows)
            return newest.rows
        with staging(lake.spark):
            rows = lake.overwrite(job.build(), job.layer, job.name, job.partition_by, run, inputs)
        logger.info("%s: %d rows", table, rows)
        return rows

    needs = {j.table: [i for i in j.inputs if i in known] for j in jobs}
    rows, failures = run_in_order(list(known), needs, inheritable_thread_target(lake.spark)(write))
    for table, reason in failures.items():
        logger.error("%s failed: %s", table, reason)
    if failures:
        raise LayerFailed(what, failures, rows)
    return rows


def _run_layer(lake: Lake, layer: str, jobs: Sequence[Job], run: str = "") -> dict[str, int]:
    """``run_jobs`` for one layer, with plain table names."""

    def plain(by_table: Mapping) -> dict:
        return {t.removeprefix(f"{layer}."): v for t, v in by_table.items()}

    try:
        return plain(run_jobs(lake, jobs, layer, run))
    except LayerFailed as failed:
        raise LayerFailed(layer, plain(failed.failures), plain(failed.rows)) from None


def run_layer(
    lake: Lake,
    layer: str,
    builders: Mapping[str, Callable[[], DataFrame]],
    needs: Mapping[str, Sequence[str]] | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    run: str = "",
) -> dict[str, int]:
    """Write every table of a layer, partitioned as ``partition_by`` says, and return its row counts."""
    jobs = [
        Job(layer, n, build, [f"{layer}.{i}" for i in (needs or {}).get(n, ())], (partition_by or {}).get(n, ()))
        for n, build in builders.items()
    ]
    return _run_layer(lake, layer, jobs, run)


def bronze_jobs(lake: Lake, raw_folder: str, pattern: str = "*.csv") -> list[Job]:
    files = list_raw(lake.spark, raw_folder, pattern)
    return [Job(BRONZE, n, lambda p=p: ingest(lake.spark, p, pattern=pattern)) for n, p in files.items()]


def silver_jobs(lake: Lake, entities: Sequence[silver.Entity] = silver.ENTITIES) -> list[Job]:
    return [
        Job(
            SILVER,
            e.name,
            lambda e=e: silver.build_entity(lake.read(BRONZE, e.source), e),
            [f"{BRONZE}.{e.source}"],
        )
        for e in entities
    ]


def gold_jobs(
    lake: Lake,
    models: Sequence[gold.Model] = gold.MODELS,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> list[Job]:
    tables = LakeTables(lake)
    return [
        Job(
            GOLD,
            m.name,
            lambda m=m: m.build(tables),
            [*(f"{SILVER}.{i}" for i in m.silver), *(f"{GOLD}.{i}" for i in m.gold)],
            (partition_by or {}).get(m.name, ()),
        )
        for m in models
    ]


def run_bronze(lake: Lake, raw_folder: str, run: str = "") -> dict[str, int]:
    return _run_layer(lake, BRONZE, bronze_jobs(lake, raw_folder), run)


def run_silver(
    lake: Lake, entities: Sequence[silver.Entity] = silver.ENTITIES, run: str = ""
) -> dict[str, int]:
    return _run_layer(lake, SILVER, silver_jobs(lake, entities), run)


def run_gold(
    lake: Lake,
    models: Sequence[gold.Model] = gold.MODELS,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    run: str = "",
) -> dict[str, int]:
    """The gold layer. A fact partitioned by ``order_date_key`` is read by period only."""
    return _run_layer(lake, GOLD, gold_jobs(lake, models, partition_by), run)


def run_all(
    spark: SparkSession,
    raw_folder: str,
    lake_root: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    run: str = "",
    pattern: str = "*.csv",
) -> dict[str, dict[str, int]]:
    """Full load of the three layers as one graph: a table is built as soon as its inputs are there.

    ``partition_by`` names partition columns of gold tables. A table that fails
    keeps back what is built on it and nothing else. Started again with the same
    ``run``, a load writes only what is missing. ``pattern`` tells raw files by their
    names; those that end in ``.gz`` are read as Hadoop reads them, each by one task.
    """
    lake = Lake(spark, lake_root)
    jobs = [*bronze_jobs(lake, raw_folder, pattern), *silver_jobs(lake), *gold_jobs(lake, partition_by=partition_by)]
    rows = run_jobs(lake, jobs, "load", run)
    layers: dict[str, dict[str, int]] = {BRONZE: {}, SILVER: {}, GOLD: {}}
    for job in jobs:
        layers[job.layer][job.name] = rows[job.table]
    return layers
