"""Secrets in documents, with false positives removed by a random forest; column functions only.

Candidates are runs of 16 or more letters, digits and ``+/_-`` with both a letter and a digit,
inside words. Each is described by its length, shares and changes of character classes, how
much of it is made of dictionary words, its path (where the document comes from) and the words
beside it. The dictionary is the corpus: a part of a candidate is a word if it stands alone, in
any case, in at least ``DICTIONARY_DOCS`` documents. A random forest trained on labelled findings
(``MOST_LABELS`` at most are used, the documented bound of the sample) scores every candidate.

Defined cases: null and empty texts have no candidates; a null path is an empty one; repeated
rows give their findings once per row; a null doc_id is kept. A word of any length is searched whole.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from embedlift.workspace import fits, write_once

MOST_LABELS = 20_000
DICTIONARY_DOCS = 5
MOST_BROADCAST = 1_000_000
NEIGHBOURS = 3
_VALUE = "[A-Za-z0-9+/_-]{16,}"
_CHANGE = "(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
#: Kinds by form, the first that matches.
KINDS = (("aws_access_key", "^(AKIA|ASIA)[0-9A-Z]{16}$"), ("github_token", "^gh[pousr]_[A-Za-z0-9]{36,}$"), ("slack_token", "^xox[abprs]-"),
         ("jwt", "^eyJ[A-Za-z0-9_-]{10,}"), ("hex", "^([0-9a-f]{2}){16,}$|^([0-9A-F]{2}){16,}$"))
FEATURES = ("length", "digits", "upper", "vowels", "changes", "distinct", "dictionary", "named", "digest_named", "assigned", "quoted", "placeholder", "test_path")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc, at (word number), word, value, before and after (words beside it), path."""
    path = F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")) if path_col else F.lit("")
    words = docs.select(F.col(f"`{id_col}`").alias("doc"), path.alias("path"), F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"\s+").alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.length(F.get("words", i)) >= 16) & F.get("words", i).rlike("[0-9]") & F.get("words", i).rlike(_VALUE))
    found = words.select("doc", "path", F.explode(F.transform(at, lambda i: F.struct(
        i.alias("at"), F.get("words", i).alias("word"),
        F.array_join(F.slice("words", F.greatest(i - NEIGHBOURS, F.lit(0)) + 1, F.least(i, F.lit(NEIGHBOURS))), " ").alias("before"),
        F.array_join(F.slice("words", i + 2, NEIGHBOURS), " ").alias("after")))).alias("c")).select("doc", "path", "c.*")
    values = found.withColumn("value", F.explode(F.regexp_extract_all("word", F.lit(f"({_VALUE})"), F.lit(1))))
    return values.where(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))


def _share(part: str) -> Column:
    return F.regexp_count("value", F.lit(part)) / F.length("value")


def described(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``found`` (word, value, before, after, path) with the columns of ``FEATURES``."""
    parts = _parts(found.select("value").distinct())
    known = parts.join(dictionary.withColumn("known", F.lit(True)), "part", "left").groupBy("value").agg(
        F.sum(F.when(F.col("known"), F.col("n") * F.length("part")).otherwise(0)).alias("covered"))
    near = F.concat_ws(" ", "before", "word")
    return (found.join(known, "value", "left")
            .withColumn("length", F.length("value").cast("double")).withColumn("digits", _share("[0-9]")).withColumn("upper", _share("[A-Z]"))
            .withColumn("vowels", _share("[AEIOUaeiou]")).withColumn("changes", _share(_CHANGE))
            .withColumn("distinct", F.size(F.array_distinct(F.split("value", ""))) / F.length("value"))
            .withColumn("dictionary", F.coalesce("covered", F.lit(0)) / F.length("value"))
            .withColumn("named", near.rlike("(?i)token|key|secret|passw|auth|credential|api|bearer").cast("double"))
            .withColumn("digest_named", near.rlike("(?i)sha|commit|hash|checksum|md5|uuid|revision|version|https?:|www").cast("double"))
            .withColumn("assigned", (F.col("before").rlike("[=:]$") | F.col("word").rlike("[=:]")).cast("double"))
            .withColumn("quoted", F.col("word").rlike("[\"'`]").cast("double"))
            .withColumn("placeholder", F.col("value").rlike("(?i)example|your|xxx|dummy|sample|placeholder|changeme|000000|123456").cast("double"))
            .withColumn("test_path", F.col("path").rlike("(?i)test|example|sample|fixture|docs?/").cast("double")).drop("covered"))


def _parts(values: DataFrame) -> DataFrame:
    """value, part (run of three or more letters, in lower case) and how often it has it."""
    return (values.select("value", F.explode(F.regexp_extract_all(F.regexp_replace("value", "(?<=[a-z])(?=[A-Z])", " "), F.lit("([A-Za-z]{3,})"), F.lit(1))).alias("p"))
            .groupBy("value", F.lower("p").alias("part")).agg(F.count(F.lit(1)).alias("n")))


def dictionary_of(docs: DataFrame, values: DataFrame, text_col: str = "text") -> DataFrame:
    """The parts of ``values`` that are words of the corpus."""
    wanted = _parts(values).select("part").distinct()
    wanted = F.broadcast(wanted) if fits(wanted, MOST_BROADCAST) else wanted
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), "[^a-z]+"))
    return docs.select(F.explode(words).alias("part")).join(wanted, "part").groupBy("part").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= DICTIONARY_DOCS).select("part")


def labelled_findings(spark: SparkSession, n: int = 4000) -> DataFrame:
    """Labelled findings to train on: credentials in the places they leak, and what is mistaken for them."""
    rows = spark.range(0, n, 1, 4).withColumn("h", F.concat(F.md5(F.col("id").cast("string")), F.md5(F.concat(F.lit("x"), F.col("id"))))).withColumn("kind", F.col("id") % 10)
    b64 = F.regexp_replace(F.base64(F.unhex("h")), "[^A-Za-z0-9]", "q")
    name = F.element_at(F.array(*map(F.lit, ("token", "api_key", "secret", "password", "auth_token", "access_key", "credential", "bearer"))), (F.col("id") / 10 % 8 + 1).cast("int"))
    filler = F.element_at(F.array(*map(F.lit, ("the file of", "see page on", "and a new", "from that other", "was then of", "in section for"))), (F.col("id") / 10 % 6 + 1).cast("int"))
    quote = F.when(F.col("id") / 10 % 3 < 1, F.lit("'")).otherwise(F.lit('"'))
    words = F.concat_ws("-", F.lit("open"), F.lit("the"), F.substring("h", 1, 1), F.lit("and"), F.lit("from"), F.substring("h", 2, 2), F.lit("that"))
    value = (F.when(F.col("kind") == 0, F.substring("h", 1, 40)).when(F.col("kind") == 1, F.substring(b64, 1, 36))
             .when(F.col("kind") == 2, F.concat(F.lit("AKIA"), F.upper(F.substring(b64, 1, 16)))).when(F.col("kind") == 3, F.concat(F.lit("ghp_"), F.substring(b64, 1, 36)))
             .when(F.col("kind") == 4, F.substring("h", 5, 32)).when(F.col("kind") == 5, F.substring("h", 1, 40)).when(F.col("kind") == 6, F.substring("h", 1, 32))
             .when(F.col("kind") == 7, words).when(F.col("kind") == 8, F.concat(F.lit("YOUR_API_KEY_EXAMPLE"), F.substring("h", 1, 2)))
             .otherwise(F.concat(F.lit("path/to/the/file-"), F.substring("h", 1, 3))))
    secret = F.col("kind") < 5
    digest = F.element_at(F.array(*map(F.lit, ("commit sha", "sha256 checksum is", "md5 hash", "uuid of revision"))), (F.col("id") / 10 % 4 + 1).cast("int"))
    before = F.when(secret, F.concat(filler, F.lit(" "), name, F.lit(" ="))).when(F.col("kind") < 7, digest).when(F.col("kind") == 8, F.concat(name, F.lit(" ="))).otherwise(filler)
    word = F.when(secret | (F.col("kind") == 8), F.concat(quote, value, quote)).otherwise(value)
    path = F.when(~secret & (F.col("id") / 10 % 4 < 1), F.lit("tests/data")).otherwise(F.lit("src"))
    return rows.select("id", path.alias("path"), word.alias("word"), value.alias("value"), before.alias("before"), filler.alias("after"), secret.cast("int").alias("label"))


def train(labelled: DataFrame) -> Model:
    """A forest from described findings with ``label`` 0 or 1; at most ``MOST_LABELS`` of them, by hash of the value."""
    sample = labelled.orderBy(F.xxhash64("value"), "value").limit(MOST_LABELS)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("features", F.col("label").cast("double").alias("label"))
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=7, featuresCol="features", labelCol="label").fit(rows)


def scored(described_: DataFrame, forest: Model) -> DataFrame:
    """With ``score``, the share of the forest that takes the finding for a secret, and ``is_secret``."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(described_)
    out = forest.transform(rows).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return out.withColumn("is_secret", F.col("score") >= 0.5).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Every candidate of ``docs``: doc_id, at, value, kind, score, is_secret."""
    found = write_once(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    values = found.select("value").union(labelled.select("value")).distinct()
    dictionary = write_once(dictionary_of(docs, values, text_col), "secret-dictionary")
    forest = train(described(labelled, dictionary))
    kind = F.coalesce(*[F.when(F.col("value").rlike(form), F.lit(name)) for name, form in KINDS], F.lit("generic"))
    return scored(described(found, dictionary), forest).select(F.col("doc").alias(id_col), "at", "value", kind.alias("kind"), "score", "is_secret")
