"""Cell-level cleaning: null tokens and type coercion, chosen by column name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustledger.functions import columns as C


def present(df: DataFrame, names) -> list[str]:
    """The names that the frame has, in the order given."""
    return [n for n in names if n in df.columns]


def clean_null_tokens(df: DataFrame, tokens: tuple[str, ...] = C.NULL_TOKENS) -> DataFrame:
    """Null tokens and blanks become NULL in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: C.null_tokens(n, tokens) for n in text})


def coerce_instant(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: C.to_instant(F.col(n)) for n in present(df, names)})


def coerce_numbers(df: DataFrame, pattern: str = "^val_|^flg_") -> DataFrame:
    """Columns whose name matches become double; what is no number becomes NULL."""
    fields = [f for f in df.schema.fields if re.search(pattern, f.name)]
    out = {}
    for f in fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = C.no_nan(F.col(f.name).cast("double"))
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = F.col(f.name).cast("double")
        else:
            out[f.name] = C.to_double(F.col(f.name))
    return df.withColumns(out)
