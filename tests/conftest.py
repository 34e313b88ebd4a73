import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docspark import settings  # noqa: E402
from docspark.model import DocModel, array_of, field, object_of  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        settings.builder("tests").master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def animal_model(**options):
    return DocModel("Animal", object_of(
        field("animalId", id=True, key=True, index=True),
        field("name", index=True, key=True),
        field("sex", enum=["male", "female", "unknown"]),
        field("isDog", "boolean", index=True),
        field("description", index=True),
        field("updatable"),
        field("loc", "geopoint", index=True),
        field("beds", array_of(object_of(field("bedId", index=True))), index=True, nested=True),
        field("age", "number"),
        field("found", "date"),
    ), index="animals", **options)


@pytest.fixture
def animals(spark):
    """Three animals with places, beds and routes."""
    d1, d2 = "a small quiet one", "Large, loud, and fond of trains"
    rows = [
        ("dog-charles-barkley-male", "Charles Barkley", True, "male", d1, (64.0, 56.0), ["couch", "mat"], "Charles"),
        ("opes-farm-dog-baloo", "Baloo", True, "male", d2, (75.0, 67.0), [], "Baloo"),
        ("data-dog-ein", "Ein", False, "female", d1, (84.0, 39.0), None, "Ein"),
    ]
    rows = [(*r[:6], None if r[6] is None else [(b,) for b in r[6]], r[7]) for r in rows]
    return spark.createDataFrame(
        rows,
        "animalId string, name string, isDog boolean, sex string, description string, "
        "loc struct<lon: double, lat: double>, beds array<struct<bedId: string>>, _routing string",
    )


@pytest.fixture
def found(spark):
    """Five animals with the day they were found and their age."""
    utc = dt.timezone.utc
    rows = [
        ("charles-1", "Charles", dt.datetime(2015, 1, 1, tzinfo=utc), 0.0),
        ("charles-2", "Charles", dt.datetime(2015, 1, 2, tzinfo=utc), 1.0),
        ("baloo", "Baloo", dt.datetime(2015, 1, 11, tzinfo=utc), 2.0),
        ("ein-1", "Ein", dt.datetime(2015, 2, 1, tzinfo=utc), 3.0),
        ("ein-2", "Ein", dt.datetime(2015, 2, 11, tzinfo=utc), 8.0),
    ]
    return spark.createDataFrame(rows, "animalId string, name string, found timestamp, age double")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    """Rows that the file scans of a frame gave out, after row groups were passed over; runs the frame."""
    df.collect()
    found, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif name == "FileSourceScanExec":
            found += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
    return found
