"""Canonical record shape, vendor profiles and the fixed lookup tables.

A *record* is a row with ``id STRING``, ``vector ARRAY<FLOAT>`` and
``metadata VARIANT``. ``namespace STRING`` and ``sparse STRUCT`` are optional;
operators carry any further columns along unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_DDL = "id string, vector array<float>, metadata variant"
SPARSE_DDL = "struct<indices: array<bigint>, values: array<float>>"
RESERVED_FIELDS = ("id", "vector")


@dataclass(frozen=True)
class Profile:
    """What one store type can hold."""

    name: str
    vector_key: str
    metadata_key: str
    id_rule: str            # text | uuid | any
    nested: bool
    arrays: str             # strings | typed | any | json
    namespace: str          # namespace | tenant | partition | payload
    max_dims: int
    sparse: bool
    max_id_bytes: int | None = None
    max_metadata_bytes: int | None = None
    integers_as_double: bool = False


# ---- fixed values: vendor limits and names -------------------------------
PROFILES = {
    "pinecone": Profile("pinecone", "values", "metadata", "text", False, "strings", "namespace", 20000, True,
                        max_id_bytes=1024, max_metadata_bytes=40 * 1024, integers_as_double=True),
    "qdrant": Profile("qdrant", "vector", "payload", "any", True, "any", "payload", 65536, True),
    "weaviate": Profile("weaviate", "vector", "properties", "uuid", True, "typed", "tenant", 65535, False),
    "milvus": Profile("milvus", "embedding", "fields", "any", True, "json", "partition", 32768, True),
}

# logical type -> (pinecone, qdrant, weaviate, milvus)
TYPE_MATRIX = [
    ("string", "string", "keyword", "string", "VARCHAR"),
    ("int", "number", "integer", "int", "INT64"),
    ("float", "number", "float", "number", "FLOAT"),
    ("boolean", "boolean", "bool", "boolean", "BOOL"),
    ("string[]", "string[]", "array", "string[]", "JSON"),
    ("date", "string", "ISO string", "date", "VARCHAR"),
    ("text", "string", "text", "text", "VARCHAR"),
    ("object", "flattened", "JSON", "object", "JSON"),
]

# concept, value in plain words -> (pinecone, qdrant, weaviate, milvus); None = no counterpart
INDEX_MATRIX = [
    ("metric", "cosine", "cosine", "Cosine", "cosine", "COSINE"),
    ("metric", "dot", "dotproduct", "Dot", "dot", "IP"),
    ("metric", "euclidean", "euclidean", "Euclid", "l2-squared", "L2"),
    ("metric", "hamming", None, None, "hamming", None),
    ("metric", "manhattan", None, "Manhattan", None, None),
    ("max_connections", "", None, None, "maxConnections", "M"),
    ("search_depth", "", None, "hnsw_ef", "ef", "ef"),
    ("build_quality", "", None, None, "efConstruction", "efConstruction"),
]
INDEX_DEFAULTS = {
    ("max_connections", "weaviate"): 32, ("max_connections", "milvus"): 32,
    ("search_depth", "weaviate"): -1, ("search_depth", "qdrant"): 128, ("search_depth", "milvus"): 64,
    ("build_quality", "weaviate"): 128, ("build_quality", "milvus"): 128,
}

COMMON_FIELDS = [
    ("id", 1.0, "Primary identifier, direct mapping"),
    ("title", 0.95, "Common metadata field"),
    ("url", 0.95, "URL reference field"),
    ("content", 0.9, "Main content field"),
]
OTHER_FIELD = (0.7, "Auto-mapped by name - verify type compatibility")

PATH_CONFIDENCE = [
    ("pinecone", "qdrant", 0.9, ["Pinecone flat metadata will be flattened in Qdrant with dot notation"]),
    ("pinecone", "weaviate", 0.85, ["Weaviate requires schema definition before upsert",
                                    "Nested metadata not supported in Pinecone, but supported in Weaviate"]),
    ("qdrant", "pinecone", 0.85, ["Qdrant nested payloads must be flattened for Pinecone",
                                  "Use dot notation: author.name → author_name"]),
    ("weaviate", "pinecone", 0.8, ["Weaviate typed properties will become untyped in Pinecone",
                                   "Type information will be lost"]),
]
OTHER_PATH = (0.75, ["Generic migration path - review mappings carefully"])

MIGRATION_STATES = ("not_started", "in_progress", "completed", "rolled_back", "failed")
ALLOWED_TRANSITIONS = [
    ("not_started", "in_progress"),
    ("in_progress", "completed"),
    ("in_progress", "failed"),
    ("in_progress", "rolled_back"),
    ("failed", "rolled_back"),
    ("completed", "rolled_back"),
    # a failed run is resumed; a new run of a finished migration starts over
    ("failed", "in_progress"),
    ("completed", "not_started"),
    ("failed", "not_started"),
    ("rolled_back", "not_started"),
]

RPC_CODES = {
    "parse_error": -32700,
    "invalid_request": -32600,
    "internal_error": -32603,
    "missing_authorization": -32000,
    "invalid_api_key": -32001,
    "rate_limited": -32002,
}
SIMILARITY_THRESHOLD = 0.98
RATE_PER_MINUTE = 100
RATE_BURST = 20
# ---- end of fixed values -------------------------------------------------


def profile(name: str) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown database type: {name!r}; known: {', '.join(PROFILES)}")
    return PROFILES[name]


def profiles_frame(spark: SparkSession) -> DataFrame:
    """The vendor profiles as a table (one row per store type)."""
    rows = [(p.name, p.vector_key, p.metadata_key, p.id_rule, p.nested, p.arrays, p.namespace, p.max_dims,
             p.max_id_bytes, p.max_metadata_bytes) for p in PROFILES.values()]
    return spark.createDataFrame(
        rows, "profile string, vector_key string, metadata_key string, id_rule string, nested boolean, "
              "arrays string, namespace string, max_dims int, max_id_bytes int, max_metadata_bytes int")


def type_frame(spark: SparkSession) -> DataFrame:
    """The type matrix in long form: ``logical, profile, target_type``."""
    rows = [(logical, name, value)
            for logical, *cells in TYPE_MATRIX for name, value in zip(PROFILES, cells)]
    return F.broadcast(spark.createDataFrame(rows, "logical string, profile string, target_type string"))


def index_frame(spark: SparkSession) -> DataFrame:
    """The index matrix in long form: ``concept, logical, profile, name, default``."""
    rows = [(concept, logical, name, value, INDEX_DEFAULTS.get((concept, name)))
            for concept, logical, *cells in INDEX_MATRIX for name, value in zip(PROFILES, cells)]
    return F.broadcast(spark.createDataFrame(
        rows, "concept string, logical string, profile string, name string, default int"))


def path_frame(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(
        PATH_CONFIDENCE, "source_type string, target_type string, confidence double, warnings array<string>"))


def common_field_frame(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(
        COMMON_FIELDS, "source_field string, confidence double, notes string"))


def transition_frame(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(ALLOWED_TRANSITIONS, "prev_state string, state string"))
