"""Keep-latest state as a log: a base and deltas, merged when read.

Applying an increment writes the latest row of each of its own keys as one
delta and commits it, so the bytes written are in proportion to the increment,
however many keys and days the state holds (``plans.incremental`` rewrites the
whole buckets that an increment touches). Reading merges the base with the
deltas by the same keep-latest, one shuffle with a limit per key before it.
Compaction folds deltas into a new base once they number ``max_deltas``, so
reads stay in proportion to the state.

Every change is one commit (``sinks.commits``): a reader sees the base and the
deltas of one version, and a writer that stops leaves the last version. Folders
that no version since the last compaction names are removed by ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from aurum.operators.dedup import keep_latest
from aurum.session import child_names, delete_path
from aurum.sinks import commits, writers

#: Deltas that a read merges at most before the next append compacts.
MAX_DELTAS = 16
#: Increments that a compaction leaves as deltas: they may still be replaced.
KEEP_RECENT = 1


def _state(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    return commits.newest(spark, f"{path.rstrip('/')}/_versions")


def _commit(spark: SparkSession, path: str, version: int, state: dict) -> None:
    commits.commit(spark, f"{path.rstrip('/')}/_versions", version, state)


def _schema(state: dict) -> StructType:
    return StructType.fromJson(state["schema"])


def _merged(spark: SparkSession, path: str, state: dict, folders: Sequence[str]) -> DataFrame:
    parts = [spark.read.format(state["fmt"]).schema(_schema(state)).load(f"{path}/{f}") for f in folders]
    if not parts:
        return spark.createDataFrame([], _schema(state))
    return keep_latest(reduce(DataFrame.unionByName, parts), state["key"], state["order_col"], state["tiebreakers"])


def _folders(state: dict) -> list[str]:
    return ([state["base"]] if state["base"] else []) + [d["folder"] for d in state["deltas"]]


def append(spark: SparkSession, rows: DataFrame, path: str, increment_id: str, key: str = "ssn", order_col: str = "scan_date",
           tiebreakers: Sequence[str] = (), max_deltas: int = MAX_DELTAS, fmt: str = "parquet") -> int:
    """Apply an increment; returns the committed version.

    An id that is still a delta is replaced by the new rows. One that was
    folded into the base can't be taken out again and is an error, unless it is
    the last that was folded there or later: see ``KEEP_RECENT``. Rows must have
    the state's columns; key, order and tiebreakers are part of the state.
    """
    path = path.rstrip("/")
    version, state = _state(spark, path)
    rule = {"key": key, "order_col": order_col, "tiebreakers": list(tiebreakers), "fmt": fmt}
    if state is None:
        state = {**rule, "schema": rows.schema.jsonValue(), "base": None, "deltas": [], "folded": []}
    elif {k: state[k] for k in rule} != rule:
        raise ValueError(f"{path} keeps the latest by { {k: state[k] for k in rule} }, not {rule}")
    names = _schema(state).fieldNames()
    if sorted(names) != sorted(rows.columns):
        raise ValueError(f"{path} has columns {names}, not {rows.columns}")
    if str(increment_id) in state["folded"]:
        raise ValueError(f"increment {increment_id} is part of the base of {path} already")
    folder = f"delta-{uuid.uuid4().hex}"
    latest = keep_latest(rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in _schema(state).fields]), key, order_col, tiebreakers)
    writers.write_table(latest, f"{path}/{folder}", fmt, mode="errorifexists")
    others = [d for d in state["deltas"] if d["id"] != str(increment_id)]
    state = {**state, "deltas": [*others, {"id": str(increment_id), "folder": folder}]}
    _commit(spark, path, version + 1, state)
    return compact(spark, path) if len(state["deltas"]) > max_deltas else version + 1


def read(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every key over all increments of the newest version."""
    path = path.rstrip("/")
    _, state = _state(spark, path)
    if state is None:
        raise ValueError(f"no committed version in {path}")
    return _merged(spark, path, state, _folders(state))


def compact(spark: SparkSession, path: str, keep_recent: int = KEEP_RECENT) -> int:
    """Fold all deltas but the ``keep_recent`` newest into a new base; returns
    the committed version. What is read before and after is the same."""
    path = path.rstrip("/")
    version, state = _state(spark, path)
    fold = state["deltas"][:max(0, len(state["deltas"]) - keep_recent)] if state else []
    if not fold:
        return version
    base = f"base-{uuid.uuid4().hex}"
    whole = _merged(spark, path, state, ([state["base"]] if state["base"] else []) + [d["folder"] for d in fold])
    writers.write_table(whole, f"{path}/{base}", state["fmt"], mode="errorifexists", bloom=[state["key"]])
    _commit(spark, path, version + 1, {**state, "base": base, "deltas": state["deltas"][len(fold):],
                                       "folded": state["folded"] + [d["id"] for d in fold]})
    return version + 1


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the folders that the newest version doesn't name; returns how
    many. Only when no reader of an earlier version and no writer is at work."""
    path = path.rstrip("/")
    _, state = _state(spark, path)
    named = set(_folders(state)) if state else set()
    gone = [f for f in child_names(spark, path) if f.startswith(("base-", "delta-")) and f not in named]
    for f in gone:
        delete_path(spark, f"{path}/{f}")
    return len(gone)
