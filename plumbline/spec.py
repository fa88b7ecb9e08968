"""Declaration of a labelled table: target, categories, columns to drop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .functions.columns import is_numeric, require

TARGET_TYPES = ("numerical", "categorical")


@dataclass(frozen=True)
class TableSpec:
    """One target, a list of categorical columns; all other columns are numeric.

    ``key`` names the columns that identify a row. They are never predictors;
    splits and first-appearance orders use them.
    """

    target: str
    target_type: str
    categorical: tuple[str, ...] = ()
    drop_cols: tuple[str, ...] = ()
    use_cols: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    fmt: str = "parquet"
    perc: float = 95.0

    def __post_init__(self):
        if self.target_type not in TARGET_TYPES:
            raise ValueError(f"target_type must be one of {TARGET_TYPES}")
        for name in ("categorical", "drop_cols", "use_cols", "key"):
            object.__setattr__(self, name, tuple(getattr(self, name)))

    @property
    def numerical_target(self) -> bool:
        return self.target_type == "numerical"

    def predictors(self, df: DataFrame) -> list[str]:
        """Predictor columns in frame order."""
        require(df, [self.target])
        if self.use_cols:
            return [c for c in require(df, self.use_cols) if c != self.target]
        out = {self.target, *self.drop_cols, *self.key}
        return [c for c in df.columns if c not in out]

    def categories(self, df: DataFrame) -> list[str]:
        """Categorical predictors, in the order they were declared."""
        have = self.predictors(df)
        return [c for c in self.categorical if c in have]

    def numerics(self, df: DataFrame) -> list[str]:
        """Numeric predictors; an undeclared column of another type is an error."""
        cols = [c for c in self.predictors(df) if c not in self.categorical]
        wrong = [c for c in cols if not is_numeric(df, c)]
        if wrong:
            raise ValueError(f"columns {wrong} are neither numeric nor declared categorical")
        return cols
