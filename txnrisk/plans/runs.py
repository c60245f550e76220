"""Which stages have to run: what each of them needs and makes, and a record of past runs.

After each stage a row is appended to a log: what the stage had read, which
settings it depends on, and what it left. A stage is stale if it never ended
well, if one of these is different now, or if a stage that makes its inputs is
stale. So a run that died goes on where it stopped, and a run over inputs that
did not change does nothing.

Inputs and layers are compared by fingerprints: a table with versions by its
number and folders, files by names, lengths and times. What has no fingerprint,
such as a table behind a connector, counts as changed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.plans import stages
from txnrisk.sources.files import path_exists
from txnrisk.sources.tables import Table, in_few_files
from txnrisk.sources.versions import Versioned

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("needs", T.StringType()),
        T.StructField("makes", T.StringType()),
        T.StructField("settings", T.StringType()),
        T.StructField("ended", T.TimestampType()),
        T.StructField("message", T.StringType()),
    ]
)
DONE, FAILED = "done", "failed"


@dataclass(frozen=True)
class Step:
    """A stage's inputs and layers by their names in ``Settings`` and ``Layers``."""

    run: Callable[[SparkSession, stages.Layers, stages.Settings], DataFrame]
    needs: tuple[str, ...]
    makes: tuple[str, ...]
    settings: tuple[str, ...] = ()
    # Layers that others add to as well: they only have to be there.
    shared: tuple[str, ...] = ()


STEPS = {
    "ingestion": Step(
        stages.ingest,
        ("logs", "payers", "payees"),
        ("raw", "dim_payers", "dim_payees"),
        ("csv_null_tokens", "further_fields"),
    ),
    "transform": Step(
        stages.transform,
        ("raw", "dim_payers", "dim_payees"),
        ("silver", "invalid", "gold", "quality"),
        ("accepted_failures",),
    ),
    "training": Step(
        stages.train, ("gold",), ("model", "metrics", "roc_curve", "class_report"), ("threshold", "hash_width")
    ),
    "inference": Step(
        stages.infer,
        ("gold", "model"),
        ("queue",),
        ("threshold", "score_first_when_none_wait", "replace_queue", "batch"),
        shared=("queue",),
    ),
}


def order(steps: dict[str, Step], given: set[str]) -> list[str]:
    """The steps such that each comes after those that make what it needs; ties as declared.

    What is neither ``given`` nor made, what two steps make, and steps that need
    each other are errors.
    """
    makers: dict[str, str] = {}
    for name, step in steps.items():
        for made in step.makes:
            if made in makers:
                raise ValueError(f"both {makers[made]} and {name} make {made}")
            makers[made] = name
    after = {}
    for name, step in steps.items():
        unknown = [n for n in step.needs if n not in makers and n not in given]
        if unknown:
            raise ValueError(f"nothing makes what {name} needs: {', '.join(unknown)}")
        after[name] = {makers[n] for n in step.needs if n in makers}
    found: list[str] = []
    while len(found) < len(steps):
        ready = [name for name in steps if name not in found and after[name] <= set(found)]
        if not ready:
            raise ValueError(f"these need each other: {', '.join(n for n in steps if n not in found)}")
        found.append(ready[0])
    return found


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, default=str).encode()).hexdigest()


def _files(spark: SparkSession, path: str | None) -> str | None:
    """Names, lengths and times of all files at a path; None if there are none."""
    if path is None or not path_exists(spark, path):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    found = []
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return _digest(sorted(found))


def _fingerprint(spark: SparkSession, layers: stages.Layers, settings: stages.Settings, name: str) -> str | None:
    """What an input or layer is now; None if it is not there or cannot be told."""
    if name in {f.name for f in fields(settings)}:
        value = getattr(settings, name)
        paths = value if isinstance(value, tuple) else (value,)
        # Of several places the first that exists counts.
        found = next((p for p in paths if p and path_exists(spark, p)), None)
        return _files(spark, found) if found else _digest(None)
    layer = getattr(layers, name)
    if isinstance(layer, str):
        return _files(spark, layer) or _files(spark, layers.second_model)
    if isinstance(layer, Versioned):
        commit = layer.commit(spark)
        return _digest([commit.number, commit.folders]) if commit else None
    if isinstance(layer, Table) and layer.path and not layer.name:
        return _files(spark, layer.path)
    # A view is as good as the tables that its maker reads.
    return _digest("view") if layer is None else None


def _now(spark, layers, settings, names: tuple[str, ...]) -> dict[str, str | None]:
    return {name: _fingerprint(spark, layers, settings, name) for name in names}


def _chosen(settings: stages.Settings, step: Step) -> str:
    return json.dumps({name: getattr(settings, name) for name in step.settings}, default=str)


def last_records(spark: SparkSession, log: Versioned) -> dict[str, T.Row]:
    """The latest row of each stage that ended well."""
    if not log.exists(spark):
        return {}
    latest = Window.partitionBy("stage").orderBy(F.desc("ended"))
    rows = log.read(spark, LOG_SCHEMA).filter(F.col("state") == DONE)
    rows = rows.withColumn("place", F.row_number().over(latest)).filter("place = 1")
    return {row["stage"]: row for row in rows.collect()}


@dataclass(frozen=True)
class Planned:
    stage: str
    stale: bool
    reason: str


def plan(
    spark: SparkSession, layers: stages.Layers, settings: stages.Settings, log: Versioned
) -> list[Planned]:
    """All stages in the order they would run, whether they are stale, and why."""
    given = {f.name for f in fields(settings)}
    records, found, made_by_stale = last_records(spark, log), [], set()
    for name in order(STEPS, given):
        reason = _why(spark, layers, settings, STEPS[name], records.get(name), made_by_stale)
        if reason:
            made_by_stale |= set(STEPS[name].makes)
        found.append(Planned(name, bool(reason), reason))
    return found


def _why(spark, layers, settings, step: Step, record: T.Row | None, made_by_stale: set[str]) -> str:
    """Why a step has to run; empty if it has not."""
    if record is None:
        return "never done"
    if record["settings"] != _chosen(settings, step):
        return "other settings"
    anew = [name for name in step.needs if name in made_by_stale]
    if anew:
        return f"made anew: {', '.join(anew)}"
    needed = json.loads(record["needs"])
    now = _now(spark, layers, settings, step.needs)
    changed = [n for n in step.needs if now[n] is None or now[n] != needed.get(n)]
    if changed:
        return f"changed: {', '.join(changed)}"
    left, now = json.loads(record["makes"]), _now(spark, layers, settings, step.makes)
    lost = [n for n in step.makes if now[n] is None or (n not in step.shared and now[n] != left.get(n))]
    return f"not as left: {', '.join(lost)}" if lost else ""


def plan_frame(spark: SparkSession, planned: list[Planned]) -> DataFrame:
    rows = [(p.stage, p.stale, p.reason) for p in planned]
    return spark.createDataFrame(rows, "stage string, stale boolean, reason string")


def run_stale(
    spark: SparkSession,
    layers: stages.Layers,
    settings: stages.Settings,
    log: Versioned,
    until: str | None = None,
) -> dict[str, DataFrame]:
    """Run the stages that are stale, in order, and record each; ``until`` is the last one looked at.

    What a stage needs is fingerprinted before it runs, so a change meanwhile
    makes it stale again. A failure is recorded and raised.
    """
    run, results = uuid.uuid4().hex, {}
    for planned in plan(spark, layers, settings, log):
        if planned.stale:
            step = STEPS[planned.stage]
            needs = _now(spark, layers, settings, step.needs)
            try:
                results[planned.stage] = step.run(spark, layers, settings)
            except Exception as error:
                _record(spark, log, run, planned.stage, FAILED, needs, {}, settings, str(error)[:1000])
                raise
            makes = _now(spark, layers, settings, step.makes)
            _record(spark, log, run, planned.stage, DONE, needs, makes, settings, planned.reason)
        if planned.stage == until:
            break
    return results


def _record(spark, log, run, stage, state, needs, makes, settings, message) -> None:
    row = (
        run, stage, state, json.dumps(needs), json.dumps(makes), _chosen(settings, STEPS[stage]),
        datetime.now(timezone.utc), message,
    )
    log.append(in_few_files(spark.createDataFrame([row], LOG_SCHEMA)))
