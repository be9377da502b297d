"""The fitted preparation and the forest as pipeline stages, saved as one object.

Each stage is an Estimator whose model keeps what it learned and writes it
next to its metadata: tables as Parquet (label mappings and grown trees have
no bound), lists as JSON.  ``Pipeline(stages).fit(train)`` gives a
PipelineModel that saves, loads in a new session and predicts raw rows.

    Pipeline(stages=[FillText(["a"]), LabelCodes(["a"]), OneHotLevels(["b"]),
                     Conform(), WholeTrees("y", "id")])
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from tablewright.operators import encode
from tablewright.operators.align import conform_to
from tablewright.operators.deep_forest import DeepForest, fit_deep_forest
from tablewright.session import materialize


class _Writer(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"state": json.dumps(self.stage.state)})
        for name, table in self.stage.tables().items():
            table.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.kind._restored(json.loads(meta["state"]), spark, f"{path}/tables")
        stage._resetUid(meta["uid"])
        return stage


class _Stored(MLWritable, MLReadable):
    """A stage whose ``state`` (JSON) and ``tables`` are all there is to know."""

    state: dict

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def tables(self) -> dict[str, DataFrame]:
        return {}

    @classmethod
    def _restored(cls, state: dict, spark: SparkSession, tables: str):
        return cls(**state)


class FillText(Transformer, _Stored):
    """Nulls of text columns become ``value``."""

    def __init__(self, cols: Sequence[str], value: str = "NULL"):
        super().__init__()
        self.state = {"cols": list(cols), "value": value}

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.fillna(self.state["value"], subset=[c for c in self.state["cols"] if c in df.columns])


class LabelCodes(Estimator):
    """Label codes of the training values; see ``encode.label_fit``."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> LabelCodesModel:
        return LabelCodesModel(self.cols, encode.label_fit(df, self.cols))


class LabelCodesModel(Model, _Stored):
    """Columns by their codes; each value that training lacks gets a code of its own after the fitted ones."""

    def __init__(self, cols: Sequence[str], mapping: DataFrame):
        super().__init__()
        self.state, self.mapping = {"cols": list(cols)}, mapping

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.state["cols"]
        return encode.label_transform(df, encode.label_extend(self.mapping, df, cols), cols)

    def tables(self) -> dict[str, DataFrame]:
        return {"mapping": self.mapping}

    @classmethod
    def _restored(cls, state, spark, tables):
        return cls(state["cols"], materialize(spark.read.parquet(f"{tables}/mapping")))


class OneHotLevels(Estimator):
    """One 0/1 column for each training level; see ``encode.one_hot``."""

    def __init__(self, cols: Sequence[str], drop_first: bool = False):
        super().__init__()
        self.cols, self.drop_first = list(cols), drop_first

    def _fit(self, df: DataFrame) -> OneHotLevelsModel:
        return OneHotLevelsModel({c: encode.levels(df, c) for c in self.cols}, self.drop_first)


class OneHotLevelsModel(Model, _Stored):
    """Levels of the training table; other values and nulls give zeros."""

    def __init__(self, levels: dict[str, list], drop_first: bool = False):
        super().__init__()
        self.state = {"levels": levels, "drop_first": drop_first}

    def _transform(self, df: DataFrame) -> DataFrame:
        levels = self.state["levels"]
        return encode.one_hot(df, list(levels), values=levels, drop_first=self.state["drop_first"])


class Conform(Estimator):
    """Remembers the columns of the training table, without ``drop`` (say, the label)."""

    def __init__(self, drop: Sequence[str] = (), fill=0):
        super().__init__()
        self.drop, self.fill = list(drop), fill

    def _fit(self, df: DataFrame) -> ConformModel:
        return ConformModel([c for c in df.columns if c not in self.drop], self.drop, self.fill)


class ConformModel(Model, _Stored):
    """The training table's columns in their order: missing ones are ``fill``, others go; ``keep`` stay where they are present."""

    def __init__(self, columns: Sequence[str], keep: Sequence[str] = (), fill=0):
        super().__init__()
        self.state = {"columns": list(columns), "keep": list(keep), "fill": fill}

    def _transform(self, df: DataFrame) -> DataFrame:
        return conform_to(df, [*self.state["columns"], *[c for c in self.state["keep"] if c in df.columns]], self.state["fill"])


class WholeTrees(Estimator):
    """A forest on all columns but ``label``, ``key`` and ``without``; see ``fit_deep_forest``."""

    def __init__(self, label: str, key: str, without: Sequence[str] = (), **options):
        super().__init__()
        self.label, self.key, self.without, self.options = label, key, list(without), options

    def _fit(self, df: DataFrame) -> WholeTreesModel:
        features = [c for c in df.columns if c not in (self.label, self.key, *self.without)]
        return WholeTreesModel(fit_deep_forest(df, features, self.label, self.key, **self.options))


class WholeTreesModel(Model, _Stored):
    """Adds the column ``prediction``."""

    def __init__(self, forest: DeepForest):
        super().__init__()
        self.state, self.forest = {}, forest

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.forest.predict(df)

    def tables(self) -> dict[str, DataFrame]:
        return {"tops": self.forest.heads(), "parts": self.forest.parts}

    @classmethod
    def _restored(cls, state, spark, tables):
        return cls(DeepForest.load(spark, tables))
