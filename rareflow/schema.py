"""Column names and the typed layout of the card-transaction table."""

from pyspark.sql import types as T

LABEL = "Class"
WEIGHT = "classWeightCol"


def card_schema() -> T.StructType:
    """Time, V1..V28, Amount as doubles and an integer 0/1 label."""
    numbers = ["Time", *(f"V{i}" for i in range(1, 29)), "Amount"]
    fields = [T.StructField(n, T.DoubleType()) for n in numbers]
    return T.StructType([*fields, T.StructField(LABEL, T.IntegerType())])
