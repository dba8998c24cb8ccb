import re

import pytest
from pyspark.sql import functions as F

from embedlift.llm import secrets
from llm.fixtures import awkward, frame

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(w,) for w in ("open", "the", "and", "from", "that", "path", "file", "your", "example")], "part string")


def test_held_out_accuracy(spark, words):
    labelled = secrets.described(secrets.labelled_findings(spark), words)
    split = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    forest = secrets.train(labelled.where(~split))
    got = secrets.scored(labelled.where(split), forest).select("is_secret", "label").collect()
    assert len(got) > 800 and sum(r.is_secret == bool(r.label) for r in got) > 0.98 * len(got)
    assert sum(r.label for r in got) > 300


def test_candidates_are_all_runs(spark):
    docs = frame(spark, [(1, f'token = "{HEX}" and sha256 {HEX}{HEX[:24]} in http://x/{HEX}?a={HEX[:20]}', None, "src", None), *awkward()[1:8]])
    rows = secrets.candidates(docs).collect()
    want = [v for v in re.findall("[A-Za-z0-9+/_-]{16,}", docs.first().text) if re.search("[0-9]", v) and re.search("[A-Za-z]", v)]
    assert sorted(r.value for r in rows if r.doc == 1) == sorted(want)


def test_scan_keeps_secrets_and_drops_digests(spark):
    rows = [(1, f'here is token = "{HEX}" in it', "en", "src1", None), (2, f"the commit sha {HEX} was made", "en", "src1", None), *awkward(), (None, f'password = "{HEX}"', None, None, None)]
    docs = frame(spark, rows).withColumn("value", F.lit("theirs")).withColumn("score", F.lit("theirs"))
    found = secrets.scan(docs, secrets.labelled_findings(spark)).collect()
    verdict = {(r.doc_id, r.at): r.is_secret for r in found if r.value == HEX}
    assert verdict == {(1, 4): True, (2, 3): False, (None, 2): True}
    assert secrets.scan(docs.limit(0), secrets.labelled_findings(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = frame(spark, awkward())
    plan = secrets.scan(docs, secrets.labelled_findings(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
