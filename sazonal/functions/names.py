"""Column-name and text normalisation."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Latin letters with marks that occur in Portuguese names, and
# their plain forms, for use inside column expressions.
MARKED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"


def normalize_name(name: str) -> str:
    """ASCII, lower case, runs of other characters become one underscore."""
    ascii_only = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
    return "_".join(re.findall(r"[a-z0-9]+", ascii_only.lower()))


def unique_names(names: list[str]) -> list[str]:
    """Normalised names; a repeated name takes ``_1``, ``_2``, … and an empty one ''."""
    seen: dict[str, int] = {}
    out = []
    for raw in names:
        name = normalize_name(raw or "")
        count = seen.get(name, 0)
        seen[name] = count + 1
        out.append(f"{name}_{count}" if name and count else name)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def fold_accents(column: Column) -> Column:
    """Lower-case text with accents removed, as a column expression."""
    return F.translate(F.lower(column), MARKED, PLAIN)


def slug(column: Column, default: str = "automl") -> Column:
    """Folder-safe name: lower case, other characters become one underscore."""
    joined = F.regexp_replace(F.lower(column), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.btrim(joined, F.lit("_")), F.lit("")), F.lit(default))


def slug_text(text: str | None, default: str = "automl") -> str:
    """``slug`` for a plain string, used when naming an output folder."""
    return "_".join(re.findall(r"[a-z0-9]+", (text or "").lower())) or default


def strip_prefixes(df: DataFrame, prefixes=("onehot__", "remainder__")) -> DataFrame:
    """Remove encoder prefixes from column names."""
    names = df.columns
    for prefix in prefixes:
        names = [n.replace(prefix, "") for n in names]
    return df.toDF(*names)
