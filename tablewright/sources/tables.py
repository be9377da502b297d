"""Reading tables, writing prediction files, saving and loading models."""

from __future__ import annotations

from collections.abc import Sequence

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import checkpoint_dir, delete_at_exit, join_bounded, materialize

# The words that pandas reads as missing by default.
PANDAS_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _nan_to_null(df: DataFrame) -> DataFrame:
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not fl:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fl})


# How pandas spells whole numbers, decimals and truth values in text.
WHOLE = r"\A[ \t]*[+-]?[0-9]+[ \t]*\z"
DECIMAL = r"(?i)\A[ \t]*[+-]?(?:[0-9]+\.?[0-9]*(?:e[+-]?[0-9]+)?|\.[0-9]+(?:e[+-]?[0-9]+)?|inf(?:inity)?)[ \t]*\z"
TRUTH = r"\A(?:True|TRUE|true|False|FALSE|false)\z"


def _known(c: str, null_words: Sequence[str]) -> Column:
    x = F.col(f"`{c}`")
    return F.when(~x.isin(list(null_words)), x) if null_words else x


def infer_types(text: DataFrame, null_words: Sequence[str] = PANDAS_NULLS) -> T.StructType:
    """The narrowest type of every text column that holds all its values: bigint, double, boolean or string.

    Each value narrows what its column can be (whole number, decimal, truth
    value); the verdicts merge by AND, so one aggregate over one scan infers
    all columns, and one row comes back.  ``null_words`` say nothing.  A
    column without any value is double, as in pandas.
    """
    checks = []
    for i, c in enumerate(text.columns):
        v = _known(c, null_words)
        whole = F.rlike(v, F.lit(WHOLE)) & F.trim(v).try_cast("bigint").isNotNull()
        checks += [F.count(v).alias(f"n{i}"), F.bool_and(F.when(v.isNotNull(), whole)).alias(f"l{i}"),
                   F.bool_and(F.rlike(v, F.lit(DECIMAL))).alias(f"d{i}"), F.bool_and(F.rlike(v, F.lit(TRUTH))).alias(f"b{i}")]
    r = text.agg(*checks).first() if checks else {}

    def kind(i: int) -> T.DataType:
        if r[f"l{i}"]:
            return T.LongType()
        if r[f"d{i}"] or not r[f"n{i}"]:
            return T.DoubleType()
        return T.BooleanType() if r[f"b{i}"] else T.StringType()
    return T.StructType([T.StructField(c, kind(i)) for i, c in enumerate(text.columns)])


def _typed(text: DataFrame, want: T.StructType, null_words: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    def cast(f: T.StructField) -> Column:
        v = _known(f.name, null_words)
        return (v if isinstance(f.dataType, T.StringType) else F.trim(v).try_cast(f.dataType)).alias(f.name)
    return text.select(*[cast(f) for f in want], *also)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None, header: bool = True, nan_to_null: bool = False,
               columns: Sequence[str] | None = None, multiline: bool = False,
               null_words: Sequence[str] = (), row_id: bool | str = False) -> DataFrame:
    """Read a CSV (header row) or Parquet table.

    CSV types come from ``schema`` when given; otherwise they are inferred,
    which costs one more pass over the file: by Spark, or, with ``null_words``,
    by ``infer_types``.  ``columns`` renames the columns in order (e.g. native
    headers to identifiers).  ``nan_to_null`` turns floating NaN into SQL null.
    In CSV a doubled quote inside quotes is a quote; ``multiline`` allows line feeds
    inside quotes (such a file is not split, so use it only where needed);
    ``null_words`` (see PANDAS_NULLS) are read as null in every column.
    ``row_id`` adds the row's position, 0 first, over all files in the order of
    their paths, under the name ``row_id`` or the one given (see ``with_file_position``).
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "csv":
        r = (spark.read.option("header", str(header).lower()).option("quote", '"').option("escape", '"')
             .option("multiLine", str(multiline).lower()))
        if null_words:
            if schema is None:
                text = r.csv(path)
                want = infer_types(text, null_words)
            else:
                want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
                text = r.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in want])).csv(path)
        else:
            r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
            text, want = r.csv(path), None
    else:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        text, want = r.format(fmt).load(path), None
    name = "row_id" if row_id is True else row_id
    df = with_file_position(text, name, fmt) if name else text
    if want is not None:
        df = _typed(df, want, null_words, [name] if name else [])
    if columns:
        df = df.toDF(*columns, *([name] if name else []))
    return _nan_to_null(df) if nan_to_null else df


def with_file_position(df: DataFrame, name: str = "row_id", fmt: str = "parquet") -> DataFrame:
    """Add every row's position over the files of a freshly read ``df``, in the order of their paths.

    No key and no sort of the rows: a row's position is the number of rows in
    the files and splits before its own plus its place there.  Parquet tells
    the place in the file; only the counts per file are gathered.  Other
    formats do not, and a second scan may cut the files differently, so they
    are parsed once into the checkpoint folder, where each row keeps its split
    and its place, and the counts are taken from there.  Either way one
    row a split is summed up in order and joined back, broadcast if small.
    """
    path = F.col("_metadata.file_path").alias("_path")
    if fmt == "parquet":
        placed = df.select("*", path, F.lit(0).cast("long").alias("_start"), F.col("_metadata.row_index").alias("_place"))
        counts = df.select(path, F.lit(0).cast("long").alias("_start")).groupBy("_path", "_start").agg(
            F.count("*").alias("_n"), F.lit(0).cast("long").alias("_first"))
    else:
        spark = df.sparkSession
        at = f"{checkpoint_dir(spark).rstrip('/')}/parsed-{uuid.uuid4().hex}"
        once = df.select("*", path, F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_place"))
        spark._jvm.org.apache.hadoop.fs.Path(at).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(at))
        delete_at_exit(spark, at)
        once.write.mode("overwrite").parquet(at)
        placed = spark.read.schema(once.schema).parquet(at)
        counts = placed.groupBy("_path", "_start").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    # one row a split: the running sum is one small task
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(counts.select("_path", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")))
    out = join_bounded(placed, splits, ["_path", "_start"], "inner")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_shift") + F.col("_place")).alias(name))


def write_predictions(df: DataFrame, path: str, row_id: str = "row_id", c: str = "target",
                      fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write one integer column (truncated toward zero), header, in ``row_id`` order.

    The global sort range-partitions the rows, so the part files hold
    consecutive row ranges and read back in order; no single task gathers
    the whole result.
    """
    out = (df.select(row_id, F.col(c).cast("bigint").alias(c))
             .orderBy(row_id).select(c))
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
