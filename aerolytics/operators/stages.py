"""Persistable pipeline stages: calendar, text codes, padding, profile assignment, projection.

Everything that turns raw columns into model features is a stage of the saved
``PipelineModel``, with the values learned in training (dictionary, feature list, means)
as parameters. A job that loads the pipeline scores raw rows as training saw them and
fits nothing. The stages are column expressions: no joins, no Python in tasks.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolytics.functions.calendar import CALENDAR_NAMES, calendar_columns
from aerolytics.operators import clusters

MAX_VALUES = 10_000


def _param(name: str, doc: str, converter):
    return Param(Params._dummy(), name, doc, typeConverter=converter)


def _column(df: DataFrame, name: str):
    return F.col(f"`{name}`")


class CalendarStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the calendar and cyclical columns that the rows lack, from their time (text is
    parsed, unparsable: NULL). Rows without a time column pass unchanged."""

    timeCol = _param("timeCol", "time column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, timeCol: str = "datetime"):
        super().__init__()
        self._set(**self._input_kwargs)
        if not self.isSet(self.timeCol):
            self._set(timeCol=timeCol)

    def inputs(self) -> list[str]:
        return [self.getOrDefault(self.timeCol)]

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.timeCol)
        if name not in df.columns:
            return df
        t = _column(df, name)
        if df.schema[name].dataType.simpleString() == "string":
            t = t.try_cast("timestamp_ntz")
        new = [c.alias(n) for n, c in zip(CALENDAR_NAMES, calendar_columns(t)) if n not in df.columns]
        return df.select("*", *new)


class TextCoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Text to its place in the sorted dictionary; NULL counts as ``nullAs``. A text that training
    did not have takes the code of ``nullAs``, or NULL (which padding fills) without one."""

    inputCol = _param("inputCol", "text column", TypeConverters.toString)
    outputCol = _param("outputCol", "code column", TypeConverters.toString)
    nullAs = _param("nullAs", "text that stands for NULL, '' for none", TypeConverters.toString)
    values = _param("values", "sorted dictionary", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, nullAs: str = "", values=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if not self.isSet(self.nullAs):
            self._set(nullAs=nullAs)

    def inputs(self) -> list[str]:
        return [self.getOrDefault(self.inputCol)]

    def _transform(self, df: DataFrame) -> DataFrame:
        name, null = self.getOrDefault(self.inputCol), self.getOrDefault(self.nullAs)
        if name not in df.columns:
            return df
        values = self.getOrDefault(self.values)
        known = F.array(*[F.lit(v) for v in values]).cast("array<string>")
        text = _column(df, name).cast("string")
        if null:
            text = F.coalesce(text, F.lit(null))
        at = F.array_position(known, text).cast("int")
        other = F.lit(values.index(null) if null in values else None).cast("int")
        return df.withColumn(self.getOrDefault(self.outputCol), F.when(text.isNull(), F.lit(None).cast("int"))
                             .when(at > 0, at - 1).otherwise(other))


class TextCoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the dictionary of a text column with few values (an error beyond ``MAX_VALUES``;
    :func:`aerolytics.operators.clean.label_encode` has no such limit)."""

    inputCol = TextCoderModel.inputCol
    outputCol = TextCoderModel.outputCol
    nullAs = TextCoderModel.nullAs

    @keyword_only
    def __init__(self, *, inputCol: str = "wd", outputCol: str = "wd_encoded", nullAs: str = ""):
        super().__init__()
        for k, v in (("inputCol", inputCol), ("outputCol", outputCol), ("nullAs", nullAs)):
            self._set(**{k: v})

    def _fit(self, df: DataFrame) -> TextCoderModel:
        null = self.getOrDefault(self.nullAs)
        text = _column(df, self.getOrDefault(self.inputCol)).cast("string")
        if null:
            text = F.coalesce(text, F.lit(null))
        rows = df.select(text.alias("v")).where("v IS NOT NULL").distinct().limit(MAX_VALUES + 1).collect()
        if len(rows) > MAX_VALUES:
            raise ValueError(f"{self.getOrDefault(self.inputCol)} has more than {MAX_VALUES} values")
        return TextCoderModel(inputCol=self.getOrDefault(self.inputCol), outputCol=self.getOrDefault(self.outputCol),
                              nullAs=null, values=sorted(r["v"] for r in rows))


class PadStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The feature list: every feature as a double, its default where it is absent or NULL;
    other columns stay. The default of a cosine is 1, of anything else 0."""

    features = _param("features", "feature list in model order", TypeConverters.toListString)
    fills = _param("fills", "default of each feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, features=None, fills=None):
        super().__init__()
        if features is not None:
            self._set(features=list(features), fills=list(fills) if fills is not None else default_fills(features))

    def _transform(self, df: DataFrame) -> DataFrame:
        names, fills = self.getOrDefault(self.features), self.getOrDefault(self.fills)
        kept = [_column(df, c) for c in df.columns if c not in names]
        return df.select(*kept, *[
            (F.coalesce(_column(df, c).try_cast("double"), F.lit(f)) if c in df.columns else F.lit(f)).alias(c)
            for c, f in zip(names, fills)])


def default_fills(features) -> list[float]:
    return [1.0 if c.endswith("_cos") else 0.0 for c in features]


class ProfileAssigner(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Cluster of raw profile rows (H20): absent or NULL columns count as 0, then the training
    statistics standardise, then the nearest centre (ties: the smaller number)."""

    features = PadStage.features
    mean = _param("mean", "training means", TypeConverters.toListFloat)
    std = _param("std", "training deviations", TypeConverters.toListFloat)
    centres = _param("centres", "centres, one after the other", TypeConverters.toListFloat)
    outputCol = TextCoderModel.outputCol

    @keyword_only
    def __init__(self, *, features=None, mean=None, std=None, centres=None, outputCol: str = "cluster"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if not self.isSet(self.outputCol):
            self._set(outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        names, flat = self.getOrDefault(self.features), self.getOrDefault(self.centres)
        centres = [flat[i:i + len(names)] for i in range(0, len(flat), len(names))]
        cluster = clusters.nearest_of(centres, df, names, self.getOrDefault(self.mean), self.getOrDefault(self.std))
        return df.withColumn(self.getOrDefault(self.outputCol), cluster)


class ProjectionStage(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Projection of raw rows on the trained principal components; a row with a NULL in its
    features has none."""

    features = PadStage.features
    mean = ProfileAssigner.mean
    std = ProfileAssigner.std
    components = _param("components", "loadings, one component after the other", TypeConverters.toListFloat)
    outputCols = _param("outputCols", "names of the projections", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, features=None, mean=None, std=None, components=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        names, flat = self.getOrDefault(self.features), self.getOrDefault(self.components)
        z = [(_column(df, c).cast("double") - m) / (s or 1.0)
             for c, m, s in zip(names, self.getOrDefault(self.mean), self.getOrDefault(self.std))]
        out = []
        for k, name in enumerate(self.getOrDefault(self.outputCols)):
            w = flat[k * len(names):(k + 1) * len(names)]
            out.append(sum((x * F.lit(v) for x, v in zip(z, w)), F.lit(0.0)).alias(name))
        return df.select("*", *out)


def standard_stats(df: DataFrame, cols) -> tuple[list[float], list[float]]:
    """Means and population deviations with NULL as 0, as :func:`clean.scale_standard` uses them."""
    z = [F.coalesce(_column(df, c).cast("double"), F.lit(0.0)) for c in cols]
    row = df.agg(*[F.avg(x) for x in z], *[F.stddev_pop(x) for x in z]).first()
    return [float(v or 0.0) for v in row[:len(z)]], [float(v or 0.0) for v in row[len(z):]]
