"""Session set-up, lineage cuts and size-checked broadcast joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest number of rows, and of bytes, a side may have to be broadcast by `join_bounded`.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def get_session(master: str | None = None, app: str = "tablewright",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators rely on.

    AQE stays on so shuffle partition counts and join strategies are re-planned
    at run time; the UI stays off.  On a cluster pass ``master=None`` and let
    the launcher decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring it only when unset.

    Clusters name it in ``spark.checkpoint.dir``; that value always wins.  Only
    when nothing is configured a folder under the SQL warehouse directory is
    used: always for a local session (tests), on a cluster only when the
    warehouse is not on a machine-local ``file:`` path.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        wh = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        if not sc.master.startswith("local") and (wh.startswith("file:") or wh.startswith("/")):
            raise RuntimeError("spark.checkpoint.dir is not set and the warehouse folder is "
                               f"machine-local ({wh}); name a shared checkpoint folder")
        conf = wh.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have an existing working folder deleted when the session's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return a frame reading it.

    Used for small fitted artefacts (encoder mappings, offsets) that several
    later plans read: it cuts lineage, so a lost executor never re-runs the
    fit, and makes the row count known before deciding on a broadcast.  The
    files go when the session ends.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # the folder that Spark made for this session's checkpoints alone
    delete_at_exit(spark, spark.sparkContext.getCheckpointDir())
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def join_bounded(left: DataFrame, right: DataFrame, on, how: str = "left",
                 max_rows: int = DEFAULT_BROADCAST_ROWS,
                 right_rows: int | None = None) -> DataFrame:
    """Join with ``right`` broadcast only if its rows and bytes are within bounds.

    ``right_rows`` may be passed when the caller already knows the count of a
    side of fixed-width columns (for example a bound that holds by
    construction); otherwise the right side is measured, so it should be a
    materialized or cheap frame.  Above either bound the join is left to the
    planner (shuffle join, or AQE's own runtime broadcast decision).
    """
    if fits_broadcast(right, max_rows, right_rows):
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None) -> bool:
    """Whether ``df`` is small enough, in rows and in bytes, to be broadcast; it is measured unless ``rows`` tell."""
    fixed, wide = _row_width(df)
    if rows is not None and not wide:
        n, size = rows, rows * fixed
    else:
        n, extra = df.agg(F.count(F.lit(1)), F.sum(sum(wide, F.lit(0))) if wide else F.lit(0)).first()
        size = n * fixed + (extra or 0)
    return n <= max_rows and size <= DEFAULT_BROADCAST_BYTES


def _row_width(df: DataFrame) -> tuple[int, list[Column]]:
    """Bytes of the fixed part of a row, and the sizes of its variable columns."""
    kinds = dict(df.dtypes)
    wide = [c for c, k in kinds.items() if k in ("string", "binary") or k.startswith(("array", "struct", "map"))]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`") if kinds[c] in ("string", "binary")
                                       else F.col(f"`{c}`").cast("string")), F.lit(0)) for c in wide]
    return 16 + 8 * len(kinds), sizes


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame (an ungrouped aggregate) to every row.

    The row becomes a scalar subquery: Spark computes it once before the
    outer plan and inlines the value (``ReusedSubquery`` for each further
    field), so there is no join and nothing grows with ``df``.  A second row
    is an error, never a silent product.
    """
    cols = one_row.columns
    s = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_row")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in cols])


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullsafe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner",
                  broadcast_right: bool = False) -> DataFrame:
    """Equi-join on same-named key columns where null matches null.

    The right side's keys are renamed first, so frames derived from the same
    source can be joined without ambiguous references.  With no keys the
    right side must be a single row (an ungrouped aggregate); its columns are
    then attached by ``attach_row``, without any join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        return attach_row(left, right)
    ren = {k: f"_rk{i}" for i, k in enumerate(keys)}
    r = right.withColumnsRenamed(ren)
    r = F.broadcast(r) if broadcast_right else r
    cond = [F.col(k).eqNullSafe(F.col(ren[k])) for k in keys]
    return left.join(r, cond, how).drop(*ren.values())
