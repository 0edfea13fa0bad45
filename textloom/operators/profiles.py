"""Model profiles: settings looked up by the name of the base model, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE_SCHEMA = """
    profile string, attn_implementation string, trust_remote_code boolean,
    use_fast_tokenizer boolean, inject_special_tokens boolean, resize_embeddings boolean,
    vision boolean, lora_r int, lora_alpha int, lora_targets array<string>,
    modules_to_save array<string>, grad_accum int, learning_rate double,
    safe_serialization boolean, enable_input_grads boolean
"""
# ---- fixed values, in the order in which names are tried ------------------------------------
_TARGETS = ["q_proj", "k_proj", "v_proj", "o_proj"]
PROFILES = [
    ("phi-2", "sdpa", False, False, True, True, False, 16, 32, _TARGETS, None, 16, 2e-5, True, False),
    ("phi-3-vision", "eager", True, True, False, False, True, 16, 32, _TARGETS, ["lm_head"], 8, 1e-5, False, True),
    ("phi-3", "sdpa", True, True, False, False, False, 16, 32, _TARGETS, ["lm_head"], 8, 1e-5, False, True),
]
DEFAULT = ("default", "sdpa", True, True, False, False, False, 16, 32, _TARGETS, ["lm_head"], 8, 2e-5, False, True)
# ---- end of fixed values --------------------------------------------------------------------


def profile_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*PROFILES, DEFAULT], PROFILE_SCHEMA)


def profile_key(model_path: Column) -> Column:
    """The first profile whose name occurs in the last part of the path, else `default`."""
    name = F.lower(F.element_at(F.split(model_path, "/"), -1))
    out = F.lit(DEFAULT[0])
    for profile in reversed(PROFILES):
        out = F.when(name.contains(profile[0]), profile[0]).otherwise(out)
    return out


def profile_lookup(models: DataFrame, model_path: str) -> DataFrame:
    """Each row with the settings of its profile: a broadcast join with four rows."""
    keyed = models.withColumn("profile", profile_key(F.col(model_path)))
    return keyed.join(F.broadcast(profile_table(models.sparkSession)), "profile")
