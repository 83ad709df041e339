"""Views, functions and procedures, and errors a caller can act on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class DataError(Exception):
    """A refused operation, with a number and a state a caller can branch on."""

    def __init__(self, number: int, message: str, state: int = 1):
        super().__init__(f"{number}: {message} (state {state})")
        self.number, self.message, self.state = number, message, state


def require(df: DataFrame, condition: Column, number: int, message: str, state: int = 1) -> DataFrame:
    """``df``, or a DataError when the condition is FALSE for any row (NULL passes)."""
    if not df.where(~condition).isEmpty():
        raise DataError(number, message, state)
    return df


def raise_for_row(condition: Column, message: str, value: Column) -> Column:
    """``value``, but the running job fails with ``message`` on a row that breaks the condition."""
    return F.when(~condition, F.raise_error(F.lit(message))).otherwise(value)


def safe_divide(numerator: Column, denominator: Column, result: str, error: str) -> list[Column]:
    """The quotient, NULL on division by zero, and a column that names the error."""
    return [
        F.try_divide(numerator, denominator).alias(result),
        F.when(denominator == 0, "DIVIDE_BY_ZERO").alias(error),
    ]


def create_function(spark: SparkSession, signature: str, returns: str, body: str) -> None:
    """A SQL function: Catalyst inlines its expression, no Python runs per row."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")


def set_variable(spark: SparkSession, name: str, kind: str, query: str, **frames: DataFrame) -> None:
    """Store the single value of a query in a session variable."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    value = spark.sql(query, **frames).first()[0]
    spark.sql(f"SET VAR {name} = CAST(:value AS {kind})", args={"value": value})
