"""Which training mode a table fits, and which of its columns plays which role.

Works on a catalog of many tables: one row (table_name, position, column_name) per column. The
alias list is fixed and small, so every lookup is an expression on the column name, and a single
partially aggregated pass per table answers detection and mapping for all modes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: mode -> role -> column names in order of preference ----------------------

ALIASES = {
    "sft": {
        "chosen": ["response", "chosen", "answer", "answers", "completion",
                   "output", "solution", "expected_answer", "long_answer", "messages", "summary"],
        "question": ["instruction", "question", "prompt", "input",
                     "query", "context", "problem", "document"],
    },
    "causal": {"chosen": ["prompt", "text"]},
    "chat": {"question": ["messages"]},
    "multimodal": {
        "image": ["image", "img", "pixel", "photo", "image_path", "picture"],
        "chosen": ["answer", "response", "chosen", "caption", "completion",
                   "output", "description", "label"],
        "question": ["question", "prompt", "instruction", "query", "text"],
    },
}
REQUIRED = {"sft": ["chosen"], "causal": ["chosen"], "chat": ["question"],
            "multimodal": ["image", "chosen"]}
ROLES = ["image", "question", "chosen", "rejected"]

# ---- end of fixed values --------------------------------------------------------------------


def catalog_of(df: DataFrame, table_name: str) -> DataFrame:
    """The catalog rows of one DataFrame; reads its schema only."""
    spark = df.sparkSession
    rows = [(table_name, i, c) for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string")


def _found(mode: str, role: str) -> Column:
    """Aggregate: the column that plays a role, by alias order; among equal names the last."""
    names = ALIASES[mode].get(role, [])
    if not names:
        return F.lit(None).cast("string")
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.lower("column_name"))
    best = F.min(F.when(rank > 0, F.struct(
        rank.alias("rank"), (-F.col("position")).alias("late"), F.col("column_name").alias("name"))))
    return best["name"]


def _all_found(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("table_name").agg(*[
        _found(mode, role).alias(f"{mode}_{role}") for mode in ALIASES for role in ALIASES[mode]])


def _fits(mode: str) -> Column:
    out = F.lit(True)
    for role in REQUIRED[mode]:
        out = out & F.col(f"{mode}_{role}").isNotNull()
    return out


def _detected() -> Column:
    """First mode with all required roles. Multimodal needs an image column, so it can go first."""
    out = F.lit(None).cast("string")
    for mode in reversed(["multimodal", *[m for m in ALIASES if m != "multimodal"]]):
        out = F.when(_fits(mode), mode).otherwise(out)
    return out


def detect_mode(catalog: DataFrame) -> DataFrame:
    """table_name, mode; null where no mode fits."""
    return _all_found(catalog).select("table_name", _detected().alias("mode"))


def map_roles(catalog: DataFrame, forced_mode: str | None = None) -> DataFrame:
    """table_name, mode and the column of each role (null if none)."""
    found = _all_found(catalog).withColumn("mode", F.lit(forced_mode) if forced_mode else _detected())

    def role_column(role: str) -> Column:
        out = F.lit(None).cast("string")
        for mode in ALIASES:
            if role in ALIASES[mode]:
                out = F.when(F.col("mode") == mode, F.col(f"{mode}_{role}")).otherwise(out)
        return out

    return found.select("table_name", "mode", *[role_column(r).alias(r) for r in ROLES])


def resolve_role(catalog: DataFrame, role: str, mode: str) -> DataFrame:
    return catalog.groupBy("table_name").agg(_found(mode, role).alias("column_name"))


def role_summary(mapped: DataFrame) -> DataFrame:
    """One row per mapped role, in the order image, question, chosen, rejected."""
    pairs = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(r).alias("role"), F.col(r).alias("column_name"))
                      for i, r in enumerate(ROLES)])
    return (mapped.select("table_name", F.explode(pairs).alias("p")).select("table_name", "p.*")
            .where("column_name IS NOT NULL"))


def table_roles(columns: list[str], forced_mode: str | None = None) -> dict[str, str | None]:
    """The same answer for the column names of one table, on the driver; raises if no mode fits."""
    by_name = {c.lower(): c for c in columns}

    def pick(mode: str, role: str) -> str | None:
        return next((by_name[a] for a in ALIASES[mode].get(role, []) if a in by_name), None)

    order = [forced_mode] if forced_mode else ["multimodal", "sft", "causal", "chat"]
    for mode in order:
        if forced_mode or all(pick(mode, r) for r in REQUIRED[mode]):
            return {"mode": mode, **{r: pick(mode, r) for r in ROLES}}
    raise ValueError(f"no training mode fits the columns {columns}")


def check_schema(spark, path: str) -> str:
    """Pre-flight: the mode of a parquet table from its footer; raises if no mode fits."""
    return table_roles(spark.read.parquet(path).columns)["mode"]
