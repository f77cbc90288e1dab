"""Session set-up, shared storage and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 512  # rows of whole texts in one Arrow batch; bounds a worker's memory


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (for the rest of the session), a checkpoint folder, and this package on the workers."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    shared_dir(spark)
    if not getattr(sc, "_claimcheck_shipped", False):
        sc.addPyFile(_package_zip())
        sc._claimcheck_shipped = True
    return spark


def _package_zip() -> str:
    root = Path(__file__).resolve().parents[1]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    out = Path(tempfile.mkdtemp(prefix="claimcheck-")) / "claimcheck_pkg.zip"
    out.write_bytes(buf.getvalue())
    return str(out)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it; only where that is unset and Spark runs
    in one process (tests) is a temporary folder taken.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None and not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or "file://" + tempfile.mkdtemp(prefix="claimcheck-shared-"))
    return configured or os.path.dirname(sc.getCheckpointDir())


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh URI below the shared folder."""
    base = shared_dir(spark)
    if "://" not in base:
        base = base if base.startswith("file:") else "file://" + base
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder; a lost executor loses nothing."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Dealt by ``cols`` to all shuffle partitions, for work that costs more than its bytes tell: few are not merged."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def give_back() -> None:
    """Gives what this Python worker has freed back to the system, as it will run other stages' tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run: Callable) -> Callable:
    """A function for mapInArrow that gives freed memory back when its partition ends."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def _settled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node reachable from each."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while (up[x] != up[y]).any():
        np.minimum.at(up, np.maximum(up[x], up[y]), np.minimum(up[x], up[y]))
        while (up != up[up]).any():
            up = up[up]
    return nodes, nodes[up]


def _in_one_task(pairs: DataFrame) -> DataFrame:
    """``components`` of few edges."""

    def run(batches):
        held = [(t.column("a").to_numpy(), t.column("b").to_numpy()) for t in batches if t.num_rows]
        if held:
            found = _settled(*map(np.concatenate, zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["node", "component"])

    return cut(pairs.coalesce(1).mapInArrow(run, "node long, component long"))


def components(edges: DataFrame, a: str = "a", b: str = "b", small: int = 0) -> DataFrame:
    """(node, component): the smallest node reachable from each node of an edge.

    Minimum over neighbours, then a pointer jump, until nothing changes; each
    round is a few equi-joins and map-side combined minima, and its labels are
    cut off in the shared folder.  Edges never leave the executors.  Empty
    input gives an empty result.  At most ``small`` edges, of which a round
    costs many times the work, are settled in one task.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    if small:
        pairs = cut(pairs.selectExpr("cast(a as long) a", "cast(b as long) b"))
        if pairs.count() <= small:
            return _in_one_task(pairs)
    sym = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(sym.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("c")))
    while True:
        near = (
            sym.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("c").alias("m"))
        )
        lower = labels.join(near, "node").select("node", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        root = labels.select(F.col("node").alias("c"), F.col("c").alias("up"))
        step = cut(lower.join(root, "c", "left").select("node", "old", F.least("c", F.coalesce("up", "c")).alias("c")))
        labels = step.select("node", "c")
        if step.where("c <> old").limit(1).count() == 0:
            return labels.withColumnRenamed("c", "component")
