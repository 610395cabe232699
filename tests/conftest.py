import datetime
import math

import pytest
from pyspark.sql import SparkSession

from geotally import model
from geotally.model import OBS_SCHEMA, STATIC_SCHEMA, TAG_SCHEMA, Dataset

START = datetime.date(2020, 4, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(spec, start=START):
    """{location: {variable: [v0, v1, …] | {bucket: [...]}}} to observation rows; None is no observation."""
    for location, variables in spec.items():
        for variable, series in variables.items():
            for bucket, values in (series if isinstance(series, dict) else {"all": series}).items():
                for i, v in enumerate(values):
                    if v is not None:
                        yield location, variable, bucket, start + datetime.timedelta(days=i), float(v)


def make_obs(spark, spec, start=START):
    return spark.createDataFrame(list(rows(spec, start)), OBS_SCHEMA)


def make_dataset(spark, spec, static=None, tags=(), start=START):
    attrs = [
        (loc, a, None if isinstance(v, str) else float(v), v if isinstance(v, str) else None)
        for loc, d in (static or {}).items() for a, v in d.items()
    ]
    return Dataset(make_obs(spark, spec, start), spark.createDataFrame(attrs, STATIC_SCHEMA), spark.createDataFrame(list(tags), TAG_SCHEMA))


def series(obs, location="r", variable=None, bucket="all", n=None, start=START):
    """Values of one series as a list from the start date; missing days are None."""
    found = {
        r["date"]: r["value"] for r in obs.collect()
        if r["location_id"] == location and (variable is None or r["variable"] == variable) and r["bucket"] == bucket
    }
    last = max([(d - start).days for d in found], default=-1)
    return [found.get(start + datetime.timedelta(days=i)) for i in range(n if n is not None else last + 1)]


def near(a, b):
    return len(a) == len(b) and all((x is None and y is None) or (x is not None and y is not None and math.isclose(x, y, abs_tol=1e-9)) for x, y in zip(a, b))
