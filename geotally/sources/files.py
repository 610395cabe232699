"""Sources that come as a file of their own: a CSV of regions and days, checked against the fields it should have."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from geotally.functions import tagtext
from geotally.model import POINT, STATIC_SCHEMA, TAG_SCHEMA, Dataset
from geotally.operators import filters, layout as L, tags
from geotally.sources import readers

#: Columns about the place or day of a row; they are neither expected nor unexpected fields.
PLACE_COLUMNS = ["fips", "date", "county", "state", "country", "aggregate_level", "location_id"]


@dataclass(frozen=True)
class FileSource:
    """A CSV with a row per fips and day; ``fields`` are the observations that are read from it."""

    name: str
    fields: list[str]
    url: str | None = None
    source_name: str | None = None
    first: datetime.date = datetime.date(2020, 1, 1)

    def load(self, spark: SparkSession, path: str, geo: DataFrame) -> tuple[Dataset, dict[str, filters.Report]]:
        """The dataset, and reports of the rows dropped as too old and as of an unknown place.

        Reports are filled by the first action on the dataset's observations; nothing is read twice for them.
        """
        header = readers._header(spark, path)
        kinds = {"date": T.DateType()} | {f: T.DoubleType() for f in self.fields}
        schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
        rows = readers.real_numbers(spark.read.schema(schema).csv(path, header=True, dateFormat="yyyy-MM-dd"))
        rows, old = filters.drop_old_dates_reported(rows, [*self.fields, "fips", "date"], PLACE_COLUMNS, self.first, self.name)
        located, unknown = filters.with_ids_reported(rows, geo.select("fips", "location_id"), "fips", f"{self.name}-places")
        present = [f for f in self.fields if f in header]
        empty = spark.createDataFrame([], TAG_SCHEMA)
        obs = L.to_long(located.withColumn("bucket", F.lit("all")), present).select(*POINT, "value") if present else spark.createDataFrame([], "location_id string, variable string, bucket string, date date, value double")
        content = tagtext.source_content(F.lit(self.name), F.lit(self.url).cast("string"), F.lit(self.source_name).cast("string"))
        ds = tags.tag_all_series(Dataset(obs, spark.createDataFrame([], STATIC_SCHEMA), empty), tagtext.SOURCE, content)
        return ds, {"old": old, "unknown": unknown}


TEST_AND_TRACE = FileSource("TestAndTrace", ["contact_tracers_count"])
