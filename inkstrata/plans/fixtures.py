"""Literal tables that exist in Spark and, as VALUES, in SQL; and helpers for typed SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SQL_TYPE = {"string": "varchar", "long": "bigint", "int": "bigint", "double": "double", "boolean": "boolean"}


@dataclass(frozen=True)
class Fixture:
    ddl: str
    rows: tuple

    def spark(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.ddl)

    def sql(self) -> str:
        cols = [c.split() for c in self.ddl.split(", ")]

        def one(v, t):
            x = "null" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
            return f"cast({x} as {_SQL_TYPE[t]})"

        body = ",\n".join("(" + ", ".join(one(v, c[1]) for v, c in zip(r, cols)) + ")" for r in self.rows)
        return f"(select * from (values {body}) t({', '.join(c[0] for c in cols)}))"


def wide(df: DataFrame) -> DataFrame:
    """Integers as long and floats as double, so both engines' types agree."""
    kinds = {"int": "long", "smallint": "long", "tinyint": "long", "float": "double"}
    return df.select(*[F.col(c).cast(kinds.get(t, t)).alias(c) for c, t in df.dtypes])


def typed(sql: str, cols: str) -> str:
    """The query's columns cast; cols as `name type, ...`."""
    parts = [c.split(" ", 1) for c in cols.split(", ")]
    return "select " + ", ".join(f"cast({n} as {t}) as {n}" for n, t in parts) + f" from ({sql}) typed_"
