"""Column roles: id / excluded / target / numeric / categorical.

Roles are derived from the schema only (no data pass), in file order:
features = every column that is not an id, an excluded column or the
target; categorical = the override list (intersected with the features) or
else every string / boolean / date feature; numeric = the remaining
numeric features. Integer 0/1 flags therefore stay numeric.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATEGORICAL_TYPES = (T.StringType, T.BooleanType, T.DateType)
NUMERIC_TYPES = (T.NumericType,)


@dataclass(frozen=True)
class FeatureSpec:
    target: str
    features: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    id_cols: tuple[str, ...] = field(default=())
    exclude_cols: tuple[str, ...] = field(default=())

    @property
    def profile_columns(self) -> list[str]:
        """Numeric features plus the target (the described columns)."""
        return list(self.numeric) + [self.target]


def validate(df: DataFrame, required: list[str] | tuple[str, ...]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Required column(s) not found in data: {missing}")


def detect_roles(
    df: DataFrame,
    target: str,
    id_cols: tuple[str, ...] | list[str] = (),
    exclude_cols: tuple[str, ...] | list[str] = (),
    categorical_override: tuple[str, ...] | list[str] = (),
) -> FeatureSpec:
    validate(df, [target])
    cols = df.columns
    drop = [c for c in list(id_cols) + list(exclude_cols) + [target] if c in cols]
    features = [c for c in cols if c not in drop]
    types = {f.name: f.dataType for f in df.schema.fields}
    if categorical_override:
        categorical = [c for c in categorical_override if c in features]
    else:
        categorical = [c for c in features if isinstance(types[c], CATEGORICAL_TYPES)]
    numeric = [
        c for c in features
        if c not in categorical and isinstance(types[c], NUMERIC_TYPES)
    ]
    # timestamps and other non-numeric, non-categorical columns are not features
    features = [c for c in features if c in numeric or c in categorical]
    return FeatureSpec(
        target=target,
        features=tuple(features),
        numeric=tuple(numeric),
        categorical=tuple(categorical),
        id_cols=tuple(c for c in id_cols if c in cols),
        exclude_cols=tuple(c for c in exclude_cols if c in cols),
    )


def role_table(spark: SparkSession, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row per column: name, Spark type, role and position (schema metadata,
    bounded by the table width)."""
    rows = []
    for i, f in enumerate(df.schema.fields):
        if f.name == spec.target:
            role = "target"
        elif f.name in spec.id_cols:
            role = "id"
        elif f.name in spec.exclude_cols:
            role = "excluded"
        elif f.name in spec.numeric:
            role = "numeric"
        elif f.name in spec.categorical:
            role = "categorical"
        else:
            role = "unused"
        rows.append((f.name, f.dataType.simpleString(), role, i))
    return spark.createDataFrame(
        rows, "column string, dtype string, role string, ordinal int"
    )
