"""Tables written between the steps of one operator, in a folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This process's own folder inside the one that driver and executors share: spark.checkpoint.dir of the session.

    Only a session in local mode (tests) may name none; it gets a temporary folder. Elsewhere each executor would write
    such a folder to its own disk, so a missing setting is an error.
    """
    context = spark.sparkContext
    known = _RUNS.get(context.applicationId)
    if known:
        return known
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="quillspark-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        found = f"file://{local}"
    _RUNS[context.applicationId] = f"{found.rstrip('/')}/quillspark-{uuid.uuid4().hex}"
    atexit.register(finish, spark)
    return _RUNS[context.applicationId]


#: The folder of each application of this process.
_RUNS: dict[str, str] = {}


def finish(spark: SparkSession) -> None:
    """Delete all tables that settle has written in this session. Results that haven't been read yet are lost."""
    with contextlib.suppress(Exception):  # at the end of a process the session may be gone
        found = _RUNS.pop(spark.sparkContext.applicationId, None)
        if found:
            _delete(spark, found)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back: later steps restart from files, not from its lineage.

    With `by` the files lie in a folder for each value of those columns, so that a filter on them reads its folders only.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[id(out)] = (weakref.ref(out, lambda _, key=id(out): _PLACES.pop(key, None)), path)
    return out


#: Where the tables lie that settle has written, as long as they are in use.
_PLACES: dict[int, tuple[weakref.ref, str]] = {}


def release(*tables: DataFrame) -> None:
    """Delete the files of tables from settle that nothing still to run reads; the others go with finish."""
    for df in tables:
        found = _PLACES.pop(id(df), None)
        if found:
            _delete(df.sparkSession, found[1])


def same(left: DataFrame, right: DataFrame, names: Sequence[str], right_names: Sequence[str] | None = None) -> Column:
    """A join's condition: equal in all of `names`, null equal to null."""
    from functools import reduce

    pairs = zip(names, right_names or names, strict=True)
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])
