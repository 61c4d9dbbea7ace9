"""Tasks and stages: a registry of functions, and their runs over rows as batches or as one pipeline.

A task function takes a payload (dict) and returns a dict, or yields several. It runs in Python workers, Arrow batches
at a time; Spark's task slots bound how many run at once. An exception becomes a row, with what the task had yielded
before kept; results are a bag without order.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.session import cut

Task = Callable[[dict], Any]


class Registry:
    """Functions by name. ``unique``: a second registration is an error, else the last one counts."""

    def __init__(self, unique: bool = False):
        self.unique, self._by = unique, {}

    def register(self, name: str) -> Callable[[Task], Task]:
        def put(f: Task) -> Task:
            if self.unique and name in self._by:
                raise ValueError(f"{name} is registered already")
            self._by[name] = f
            return f

        return put

    def get(self, name: str) -> Task:
        if name not in self._by:
            raise (KeyError if self.unique else RuntimeError)(f"unknown: {name}; there are: {', '.join(self.available())}")
        return self._by[name]

    def build(self, name: str, *args: Any, **kwargs: Any) -> Any:
        return self.get(name)(*args, **kwargs)

    def available(self) -> list[str]:
        return sorted(self._by)


RESULT = "ok boolean, result string, error string"


def run(tasks: DataFrame, f: Task, payload: str = "payload", keep: Sequence[str] = (), timeout: float | None = None, at_once: int | None = None) -> DataFrame:
    """keep, ok, result (JSON), error: one row per result of ``f`` over the JSON payloads, and one per failure.

    Works on batches and streams alike. Payloads that aren't JSON objects fail. A task that takes longer than
    ``timeout`` seconds has failed and is left behind; ``at_once`` tasks run at once where the cluster has the slots.
    """
    kinds = {x.name: x.dataType.simpleString() for x in tasks.schema.fields}

    def items(p: str) -> Iterator[Any]:
        got = f(json.loads(p))
        yield from [got] if isinstance(got, dict) or got is None else got

    def within(p: str) -> list[Any]:
        done: list[Any] = []
        box: list[BaseException] = []

        def work() -> None:
            try:
                done.extend(items(p))
            except BaseException as e:  # noqa: BLE001
                box.append(e)

        t = threading.Thread(target=work, daemon=True)
        t.start()
        t.join(timeout)
        if t.is_alive():
            raise TimeoutError(f"more than {timeout} s")
        if box:
            raise box[0]
        return done

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                kept = [getattr(row, c) for c in keep]
                try:
                    for item in items(getattr(row, payload)) if timeout is None else within(getattr(row, payload)):
                        rows.append([*kept, True, json.dumps(item, sort_keys=True), None])
                except Exception as e:  # noqa: BLE001
                    rows.append([*kept, False, None, f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(rows, columns=[*keep, "ok", "result", "error"])

    head = "".join(f"{c} {kinds[c]}, " for c in keep)
    picked = tasks.select(*keep, payload)
    return (picked.repartition(at_once) if at_once else picked).mapInPandas(each, head + RESULT)


def summary(results: DataFrame) -> DataFrame:
    """done, ok, fail."""
    return results.agg(F.count("*").alias("done"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"))


def pipeline(tasks: DataFrame, stages: Sequence[Task], mode: str = "streaming", payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Stages over payloads; what fails is dropped before the next stage.

    ``staged``: each stage ends before the next begins (its results are written to the shared folder). ``streaming``:
    one plan, rows flow through all stages inside a task.
    """
    if mode not in ("staged", "streaming"):
        raise ValueError(f"mode is staged or streaming, not {mode}")
    at = tasks.select(*keep, F.col(payload).alias("payload"))
    for i, f in enumerate(stages):
        out = run(at, f, "payload", keep)
        if mode == "staged":
            out = cut(out)
        at = out if i == len(stages) - 1 else out.where("ok").select(*keep, F.col("result").alias("payload"))
    return at if stages else at.select(*keep, F.lit(True).alias("ok"), F.col("payload").alias("result"), F.lit(None).cast("string").alias("error"))


def stage_counts(tasks: DataFrame, stages: Sequence[tuple[str, Task]], payload: str = "payload") -> DataFrame:
    """stage, done, ok: what each stage of a pipeline gave, counted by observation while the rows flow through all of them."""
    at, seen = tasks.select(F.col(payload).alias("payload")), []
    for name, f in stages:
        watch = Observation(name)
        out = run(at, f).observe(watch, F.count("*").alias("done"), F.count_if("ok").alias("ok"))
        seen.append((name, watch))
        at = out.where("ok").select(F.col("result").alias("payload"))
    at.write.format("noop").mode("overwrite").save()
    return tasks.sparkSession.createDataFrame([(name, w.get["done"], w.get["ok"]) for name, w in seen], "stage string, done long, ok long")


def reduce(df: DataFrame, keys: Sequence[str], f: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """The aggregate surface: ``f`` over all rows of each key, one row each; a key's rows are one task's work."""
    kinds = {x.name: x.dataType.simpleString() for x in df.schema.fields}
    head = "".join(f"{k} {kinds[k]}, " for k in keys)
    return df.groupBy(*keys).applyInPandas(lambda k, pdf: pd.DataFrame([dict(zip(keys, k)) | f(pdf)]), head + schema)


def on_failure(results: DataFrame, tell: Callable[[Any], None]) -> int:
    """Calls ``tell`` with each failed row, one after another, and returns how many there were; the sound ones never reach the driver."""
    n = 0
    for row in results.where(~F.col("ok")).toLocalIterator():
        tell(row)
        n += 1
    return n


def present(params: Mapping[str, Any]) -> dict[str, Any]:
    """The parameters that are given."""
    return {k: v for k, v in params.items() if v is not None}


def fold(context: Mapping[str, Any], steps: Sequence[tuple[Callable[[dict], Any], Mapping[str, Any]]]) -> dict:
    """Driver steps in turn, each over the context and its own parameters; dict results are merged into the context."""
    out = dict(context)
    for f, params in steps:
        got = f(out | dict(params))
        if isinstance(got, dict):
            out |= got
    return out


def resources(profiles: Mapping[str, Mapping[str, float]], name: str) -> dict[str, float]:
    """The resources of a profile, else of ``default``, else one core."""
    return {"cpus": 1, "gpus": 0} | dict(profiles.get(name) or profiles.get("default") or {})


# The operations that take objects from sources, the setting that makes them do so (none: always), and the part of their parameters that names the source.
OBJECT_TAKERS = (
    ("object_replace", None, None),
    ("object_add", "spawn", None),
    ("object_move", "subject_source", "spawn_params"),
    ("object_scale", "subject_source", "spawn_params"),
    ("object_rotate", "subject_source", "spawn_params"),
)


def with_object_sources(edits: Mapping[str, Any], sources: Sequence[Mapping[str, Any]] | None) -> dict:
    """An edit configuration whose object takers draw on several sources at once; the one given stays as it is."""
    params = dict(edits.get("params") or {})
    several = {"provider": "composite", "provider_params": {"sources": list(sources or ())}}
    for op, setting, part in OBJECT_TAKERS if sources else ():
        own = dict(params.get(op) or {})
        if setting is None or own.get(setting):
            params[op] = own | ({part: dict(own.get(part) or {}) | several} if part else several)
    return dict(edits) | ({"params": params} if sources else {})
