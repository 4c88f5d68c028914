"""Small configuration tables: source registry, sampling profiles, baselines
and field contracts.  They are a few rows each, so joins against them are
broadcast (size bounded by the literals below)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: source registry ------------------------------------------
# (name, dataset id, category, split, config, max_samples, license, priority)
SOURCE_REGISTRY = [
    ("openhermes", "teknium/OpenHermes-2.5", "instruction", "train", None, None, "custom (open)", 1),
    ("ultrachat", "openbmb/UltraChat", "instruction", "train", None, 500_000, "MIT", 2),
    ("openorca", "Open-Orca/OpenOrca", "instruction", "train", None, 500_000, "MIT", 3),
    ("codesearchnet", "code-search-net/code_search_net", "coding", "train", "python", None, "custom (open)", 4),
    ("gsm8k", "openai/gsm8k", "math", "train", "main", None, "MIT", 5),
    ("humaneval", "openai/openai_humaneval", "evaluation", "test", None, None, "MIT", 6),
    ("mmlu", "cais/mmlu", "evaluation", "test", "all", None, "MIT", 7),
    ("gsm8k_eval", "openai/gsm8k", "evaluation", "test", "main", None, "MIT", 8),
]

# --- fixed values: sampling profiles -----------------------------------------
# (profile, source, weight, max_samples, category)
SAMPLING_PROFILES = [
    ("local", "openhermes", 1.0, 8_000, "instruction"),
    ("local", "ultrachat", 1.0, 4_000, "instruction"),
    ("local", "openorca", 1.0, 5_000, "instruction"),
    ("local", "codesearchnet", 1.0, 6_000, "coding"),
    ("local", "gsm8k", 1.0, 2_000, "math"),
    ("full", "openhermes", 1.0, None, "instruction"),
    ("full", "ultrachat", 1.0, 200_000, "instruction"),
    ("full", "openorca", 1.0, 200_000, "instruction"),
    ("full", "codesearchnet", 1.0, None, "coding"),
    ("full", "gsm8k", 3.0, None, "math"),
]
TRAIN_RATIO = 0.95
RANDOM_SEED = 42
MAX_SEQ_LENGTH = {"local": 2048, "full": 4096}
PROMPT_TOKEN_LIMIT = 3584

# --- fixed values: baseline scores (percent) -------------------------------
BASELINES = [("humaneval", 79.9), ("gsm8k", 82.6), ("mmlu", 74.2)]

# --- fixed values: required top-level keys per raw source -------------------
FIELD_CONTRACTS = [
    ("openhermes", ["conversations"]),
    ("ultrachat", ["data", "id"]),
    ("openorca", ["system_prompt", "question", "response"]),
    ("codesearchnet", ["func_code_string", "func_documentation_string", "language"]),
    ("gsm8k", ["question", "answer"]),
    ("humaneval", ["task_id", "prompt", "canonical_solution", "test"]),
    ("mmlu", ["question", "choices", "answer"]),
    ("gsm8k_eval", ["question", "answer"]),
]
TRAINING_SOURCES = ["openhermes", "ultrachat", "openorca", "codesearchnet", "gsm8k"]
# ---------------------------------------------------------------------------

REGISTRY_SCHEMA = ("name string, dataset_id string, category string, split string, config string, "
                   "max_samples bigint, license string, priority int")
SAMPLING_SCHEMA = "profile string, source string, weight double, max_samples bigint, category string"


def registry_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE_REGISTRY, REGISTRY_SCHEMA)


def registry_in_priority_order(spark: SparkSession) -> DataFrame:
    return registry_df(spark).orderBy("priority")


def sampling_config_df(spark: SparkSession, profile: str = "local", rows=None) -> DataFrame:
    rows = rows if rows is not None else [r for r in SAMPLING_PROFILES if r[0] == profile]
    return spark.createDataFrame(rows, SAMPLING_SCHEMA)


def baselines_df(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else BASELINES, "benchmark string, baseline double")


def contracts_df(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else FIELD_CONTRACTS,
                                 "name string, required array<string>")


def holdout_filter(df: DataFrame, registry: DataFrame, name_col: str = "source",
                   converters: list[str] | None = None) -> DataFrame:
    """Keep rows whose source is a training (non-evaluation) source that has a
    converter; evaluation sources never enter cleaning.  Converters are the
    given names, else the registry's non-NULL ``shape`` column.  The registry
    has one row per source, so it is broadcast."""
    allowed = registry.filter(F.col("category") != "evaluation")
    if converters is not None:
        allowed = allowed.filter(F.col("name").isin(list(converters)))
    else:
        allowed = allowed.filter(F.col("shape").isNotNull())
    return df.join(F.broadcast(allowed.select(F.col("name").alias(name_col))), name_col, "left_semi")


def load_baselines(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Baselines from a JSON document ``{"benchmark": score, ...}``; the
    built-in table when no path is given; empty when the file is missing."""
    if path is None:
        return baselines_df(spark)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return baselines_df(spark, [])
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.explode(F.from_json(F.to_json(F.struct(*doc.columns)), "map<string,double>"))
                      .alias("benchmark", "baseline"))
