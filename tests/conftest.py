import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from embedlift.workspace import build_session

    session = build_session("tests", "8", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark, request):
    from embedlift.workspace import scratch_path

    return scratch_path(spark, request.node.name.replace("[", "-").replace("]", ""))


@pytest.fixture()
def records(spark):
    """``records([(id, vector, metadata_json), ...])`` as canonical records."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "id string, vector array<float>, m string")
        return df.withColumn("metadata", F.parse_json("m")).drop("m")
    return make


@pytest.fixture()
def metadata_of():
    """Collected metadata as Python values by id."""
    import json

    from pyspark.sql import functions as F

    def read(df):
        return {r["id"]: json.loads(r["j"]) if r["j"] is not None else None
                for r in df.select("id", F.to_json("metadata").alias("j")).collect()}
    return read
