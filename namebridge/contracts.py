"""Column contracts of the stages, checked where data enters a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Columns of the inputs.
CLIENT_UPLOAD = _strings("client_name", "country", "registration_number", "lei", "address")
CLIENT_RAW = _strings(
    "client_entity_id", "submitted_name", "country", "registration_number", "lei", "address"
)
INTERNAL_RAW = _strings(
    "internal_entity_id", "legal_name", "country", "address", "lei", "registration_number", "internal_rating",
    "business_owner",
)
REFERENCE_RAW = _strings("lei", "legal_name", "country", "registration_number", "address")


def check(df: DataFrame, contract: StructType, what: str) -> DataFrame:
    """Raise if a column of the contract is absent or of another type; further columns may follow."""
    types = dict(df.dtypes)
    wrong = [
        f"{f.name} {f.dataType.simpleString()} (found {types.get(f.name, 'nothing')})"
        for f in contract.fields
        if types.get(f.name) != f.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{what} needs {', '.join(wrong)}")
    return df
