"""Preparation of columns with very many categories.

``TabularPrep`` carries its categories in the model and compares a value with each
of them. Here they are a table in the shared folder (column, value, position) that
is built by a grouped count and a range sort and never reaches the driver. Rows find
their positions by a join per column, and become sparse vectors, so their size does
not depend on the number of categories.

Semantics are those of ``TabularPrep``: numeric columns first (median imputation and
optional scaling), then a 0/1 position per sorted training category of each column; a
NULL takes the column's mode (ties: smallest), an unseen value sets no position. A
column without any value has no positions. Rows and other columns pass through.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.cache import passes_over
from ridgeline.operators.prepare import TabularPrepModel, _c, _PrepParams, fit_statistics
from ridgeline.operators.profile import _long_values, best_values, ranked_values
from ridgeline.session import scratch_path

ENTRIES = "value string, n long, position int, ordinal int"
VECTOR = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


class DictionaryPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scale=False, outputCol="features", approxQuantiles=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DictionaryPrepModel:
        num, cat = self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols)
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, f"dictionary/{uuid.uuid4().hex}")
        sizes, modes = {x: 0 for x in cat}, {x: None for x in cat}
        with passes_over(dataset, list(dict.fromkeys([*num, *cat]))) as rows:
            stats = fit_statistics(rows, num, [], self.getOrDefault(self.approxQuantiles))
            if cat:
                counts = _long_values(rows, cat).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
                ordinal = F.array_position(F.array(*map(F.lit, cat)), F.col("column")).cast("int") - 1
                (ranked_values(counts).select("value", "n", (F.col("value_rank") - 1).cast("int").alias("position"), ordinal.alias("ordinal"))
                 .write.partitionBy("ordinal").parquet(path))
                entries = spark.read.schema(ENTRIES).parquet(path).withColumn("column", F.col("ordinal"))
                # one row per column
                for r in entries.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect():
                    sizes[cat[r["column"]]] = r["n"]
                for r in best_values(entries).collect():
                    modes[cat[r["column"]]] = r["mode"]
        stats.update(sizes=sizes, modes=modes)
        return DictionaryPrepModel(numericCols=num, categoricalCols=cat, scale=self.getOrDefault(self.scale),
                                   outputCol=self.getOrDefault(self.outputCol), statistics=json.dumps(stats), dictionary=path)


class DictionaryPrepModel(Model, _PrepParams, MLReadable, MLWritable):
    """``dictionary`` names the table of categories, a part of the model: saving
    copies it beside the parameters."""

    statistics = Param(Params._dummy(), "statistics", "fitted statistics (JSON)", TypeConverters.toString)
    dictionary = Param(Params._dummy(), "dictionary", "folder of the table of categories", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scale=False, outputCol="features", statistics="{}",
                 dictionary="", approxQuantiles=False):
        super().__init__()
        self._setDefault(statistics="{}", dictionary="")
        self._set(**self._input_kwargs)

    @property
    def stats(self) -> dict:
        return json.loads(self.getOrDefault(self.statistics))

    def entries(self, spark: SparkSession) -> DataFrame:
        """The table of categories: value, n, position in its column, ordinal of the column."""
        return spark.read.schema(ENTRIES).parquet(self.getOrDefault(self.dictionary))

    def offsets(self) -> dict[str, int]:
        """First vector position of each categorical column, and of what follows (key '')."""
        at, out, sizes = len(self.getOrDefault(self.numericCols)), {}, self.stats["sizes"]
        for x in self.getOrDefault(self.categoricalCols):
            out[x] = at
            at += sizes[x]
        if at > 2**31 - 1:
            raise ValueError(f"{at} positions do not fit a vector")
        return {**out, "": at}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, st, offsets = dataset.sparkSession, self.stats, self.offsets()
        num, cat = self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols)
        taken = {x.lower() for x in dataset.columns}

        def fresh(name: str) -> str:
            while name.lower() in taken:
                name += "_"
            return name

        numbers, places, value = fresh("_numbers"), fresh("_places"), fresh("_value")
        position = [fresh(f"_position{i}") for i in range(len(cat))]
        out = dataset
        for i, x in enumerate(cat):
            if not st["sizes"][x]:
                out = out.withColumn(position[i], F.lit(None).cast("int"))
                continue
            words = self.entries(spark).where(F.col("ordinal") == i).select(
                F.col("value").alias(value), (F.col("position") + offsets[x]).alias(position[i]))
            out = out.join(words, F.coalesce(_c(x).cast("string"), F.lit(st["modes"][x])) == words[value], "left").drop(value)
        numeric = TabularPrepModel(numericCols=num, categoricalCols=[], scale=self.getOrDefault(self.scale),
                                   statistics=json.dumps(st)).feature_exprs()
        out = out.select(*map(_c, dataset.columns), F.array(*numeric).cast("array<double>").alias(numbers),
                         F.array_compact(F.array(*map(F.col, position))).cast("array<int>").alias(places))
        name, kept = self.getOrDefault(self.outputCol), dataset.columns
        schema = T.StructType([*dataset.schema.fields, T.StructField(name, VectorUDT())])
        width, p = offsets[""], len(num)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = len(batch)
                ones = batch.column(places)
                sizes = np.diff(ones.offsets.to_numpy()) if rows else np.zeros(0, np.int64)
                ends = np.cumsum(sizes + p)
                one = np.ones(int(ends[-1]) if rows else 0, bool)  # not a numeric position
                first = (ends - sizes - p)[:, None] + np.arange(p)
                one[first.ravel()] = False
                indices, values = np.empty(len(one), np.int32), np.ones(len(one))
                indices[~one], indices[one] = np.tile(np.arange(p), rows), ones.flatten().to_numpy(zero_copy_only=False)
                values[~one] = batch.column(numbers).flatten().to_numpy(zero_copy_only=False)
                bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                vector = pa.StructArray.from_arrays(
                    [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)),
                     pa.ListArray.from_arrays(bounds, pa.array(indices)), pa.ListArray.from_arrays(bounds, pa.array(values))],
                    fields=list(VECTOR))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(kept))), vector], names=[*kept, name])

        return out.mapInArrow(run, schema)

    def write(self) -> DefaultParamsWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _Reader(cls)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.getOrDefault("categoricalCols"):
            self.instance.entries(self.sparkSession).write.partitionBy("ordinal").parquet(f"{path}/dictionary")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> DictionaryPrepModel:
        model = super().load(path)
        return model._set(dictionary=f"{path}/dictionary")
