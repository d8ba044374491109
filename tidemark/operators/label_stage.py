"""Label maps as a stage of Spark ML pipelines, with maps of any size.

Spark ML's own string indexer gathers every column's labels on the driver and writes them into the
model. Here a fitted stage holds a table (column, label, n, index): it is ranked, saved and loaded as
Parquet and applied by join (``LabelMaps``), and only sizes reach the driver, one number a column,
besides the labels of maps of at most ``INLINE_LABELS``. The order is the same: most frequent first,
ties by label; null and unseen values get the map's size.

A loaded model reads its table where it was saved, so it cannot be saved over its own folder.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.labels import LabelMaps
from tidemark.session import write_table


class LabelMapIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns one label map per input column in one pass over the table."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LabelMapModel:
        maps = LabelMaps.fit(dataset, self.getInputCols())
        maps.table = write_table(maps.table, "label-maps")
        return self._copyValues(LabelMapModel(maps))


class LabelMapModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """``inputCols`` to their labels' indexes as ``outputCols``."""

    def __init__(self, maps: LabelMaps | None = None):
        super().__init__()
        self.maps = maps
        self.source: str | None = None  # where the table is read from, if loaded

    @property
    def table(self) -> DataFrame:
        """(column, label, n, index)."""
        return self.maps.table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for name, made in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            out = self.maps.transform(out, suffix="", cols=[name], out={name: made})
        return out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(DefaultParamsWriter):
    def save(self, path: str) -> None:
        if self.instance.source == path:
            raise ValueError("a loaded model cannot be saved over the folder that holds its maps")
        super().save(path)

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.parquet(f"{path}/maps")


class _Reader(DefaultParamsReader):
    def __init__(self):
        super().__init__(LabelMapModel)

    def load(self, path: str) -> LabelMapModel:
        model = super().load(path)
        table = SparkSession.active().read.parquet(f"{path}/maps")
        model.maps, model.source = LabelMaps.of(table, model.getInputCols()), path
        return model
