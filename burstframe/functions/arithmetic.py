"""One set of names for model formulas on Spark columns and on numpy arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


class Columns:
    """What a model may use, on Spark columns."""

    col, pow, exp, ln = staticmethod(F.col), staticmethod(F.pow), staticmethod(F.exp), staticmethod(F.ln)

    @staticmethod
    def when(c: Column, yes, no) -> Column:
        return F.when(c, yes).otherwise(no)

    @staticmethod
    def clip(lo: float, hi: float, v: Column) -> Column:
        return F.greatest(F.lit(lo), F.least(F.lit(hi), v))


SPARK = Columns()


class Arrays:
    """The same on arrays; ``null`` collects where Spark has null (a null input, a logarithm of what is not positive)."""

    def __init__(self, columns: dict[str, np.ndarray], nulls: dict[str, np.ndarray]):
        self.columns, self.nulls, self.null = columns, nulls, np.False_

    def col(self, c: str) -> np.ndarray:
        if c in self.nulls:
            self.null = self.null | self.nulls[c]
        return self.columns[c]

    pow, exp, when = staticmethod(np.power), staticmethod(np.exp), staticmethod(np.where)

    def ln(self, v: np.ndarray) -> np.ndarray:
        self.null = self.null | (v <= 0)
        return np.log(v)

    @staticmethod
    def clip(lo: float, hi: float, v: np.ndarray) -> np.ndarray:
        return np.maximum(lo, np.fmin(hi, v))
