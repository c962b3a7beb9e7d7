"""Numbers and structure out of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .missing import finite

# Fixed value: a signed decimal with an optional exponent.
NUMBER = r"([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)"
# A whole text that is one number.
WHOLE_NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
# Step names recognised in a printed model, longest alternatives as listed.
STEP_NAMES = (
    "StandardScaler|MinMaxScaler|Normalizer|RobustScaler|MaxAbsScaler|"
    "SelectFromModel|SelectPercentile|SelectFwe|RFE|VarianceThreshold|"
    "FeatureUnion|Binarizer|ColumnOrdinalEncoder|EstimatorTransformer|"
    "LGBMRegressor|ExtraTreesRegressor|HistGradientBoostingRegressor|"
    "RandomForestRegressor|XGBRegressor|Passthrough"
)
# Fixed value: one printed row of a search history (index, score, parents, variation,
# "...", evaluation error, front, instance).
HISTORY_LINE = (
    r"^\s*(\d+)\s+(-?\d+(?:\.\d+)?)\s+(NaN|\([^)]+\))\s+(.*?)\s+\.\.\.\s+(.*?)\s+"
    r"(NaN|-?\d+(?:\.\d+)?)\s+(.*)$"
)


def decimal_comma(column: Column) -> Column:
    """Double of text that may use a decimal comma; other text, "NaN", "5d" and numbers beyond
    a double among it, gives null."""
    plain = F.replace(F.trim(column), F.lit(","), F.lit("."))
    return F.when(plain.rlike(WHOLE_NUMBER), finite(plain.try_cast("double")))


def upper_key(column: Column) -> Column:
    return F.upper(F.trim(column))


def lower_key(column: Column) -> Column:
    return F.lower(F.trim(column))


def first_number(column: Column) -> Column:
    """First number in a text, with a comma read as a decimal point."""
    found = F.regexp_extract(F.replace(column.cast("string"), F.lit(","), F.lit(".")), NUMBER, 1)
    return found.try_cast("double")


def field_number(text: Column, field: str) -> Column:
    """Number after ``field`` in a printed record."""
    return F.regexp_extract(text, field + r"\s+(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def field_text(text: Column, field: str) -> Column:
    """Rest of the line after ``field`` in a printed record."""
    found = F.regexp_extract(text, field + r"\s+([^\n]+)", 1)
    return F.nullif(F.trim(found), F.lit(""))


def parse_best_text(df: DataFrame, text_col: str) -> DataFrame:
    """Columns of the best individual out of its printed record; others are dropped."""
    t = F.col(text_col)
    score = field_number(t, "root_mean_squared_error")
    return df.withColumns(
        {
            "indice": F.regexp_extract(t, r"Name:\s*(\d+)", 1).try_cast("long"),
            "Generation": field_number(t, "Generation"),
            "root_mean_squared_error": score,
            "RMSE": F.abs(score),
            "Parents": field_text(t, "Parents"),
            "Variation_Function": field_text(t, "Variation_Function"),
            "Pareto_Front": field_number(t, "Pareto_Front"),
            "Instance": field_text(t, "Instance"),
            "origem": F.lit("melhor_individuo"),
        }
    ).where(F.col("root_mean_squared_error").isNotNull())


def parse_history_text(df: DataFrame, text_col: str) -> DataFrame:
    """One row per readable line of a printed search history."""
    line = F.col("_line")
    trimmed = F.trim(line)
    readable = (
        (trimmed != "")
        & ~trimmed.startswith("[")
        & ~trimmed.startswith("..")
        & ~(line.contains("root_mean_squared_error") & line.contains("Parents"))
        & line.rlike(HISTORY_LINE)
    )

    def part(i: int) -> Column:
        return F.regexp_extract(line, HISTORY_LINE, i)

    def part_or_null(i: int) -> Column:
        return F.nullif(F.trim(part(i)), F.lit("NaN"))

    score = part(2).try_cast("double")
    lines = df.withColumn("_line", F.explode(F.split(F.rtrim(F.col(text_col)), r"\r?\n")))
    return (
        lines.where(readable)
        .withColumns(
            {
                "indice": part(1).try_cast("long"),
                "root_mean_squared_error": score,
                "RMSE": F.abs(score),
                "Parents": part_or_null(3),
                "Variation_Function": part_or_null(4),
                "Eval_Error": F.trim(part(5)),
                "Pareto_Front": part_or_null(6).try_cast("double"),
                "Instance": F.trim(part(7)),
                "origem": F.lit("search_history_visivel"),
            }
        )
        .drop("_line")
    )


def ordered_names(column: Column, pattern: str) -> Column:
    """Distinct matches of ``pattern`` in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(column, F.lit(f"({pattern})"), F.lit(1)))


def summarize_steps(
    column: Column, limit: int = 120, top: int = 8, pattern: str = STEP_NAMES
) -> Column:
    """First ``top`` step names joined by arrows; text without any is cut to ``limit``."""
    text = column.cast("string")
    cut = F.concat(
        F.substring(text, 1, limit), F.when(F.length(text) > limit, "...").otherwise("")
    )
    # The join runs over the names once; no names give an empty text.
    joined = F.array_join(F.slice(ordered_names(text, pattern), 1, top), " → ")
    return F.coalesce(F.nullif(joined, F.lit("")), cut)


def expand_steps(df: DataFrame, steps_col: str, pattern: str = STEP_NAMES) -> DataFrame:
    """One row per ``[name, object]`` step, numbered from 1.

    ``steps_col`` is an array of structs with two string fields.
    """
    name, detail = df.schema[steps_col].dataType.elementType.names
    keep = [c for c in df.columns if c != steps_col]
    numbered = df.select(*keep, F.posexplode(steps_col).alias("_at", "_step"))
    return numbered.select(
        *keep,
        (F.col("_at") + 1).alias("ordem"),
        F.col(f"_step.{name}").alias("etapa"),
        summarize_steps(F.col(f"_step.{detail}"), pattern=pattern).alias("resumo"),
        F.col(f"_step.{detail}").alias("detalhe"),
    )
