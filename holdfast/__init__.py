"""Customer-retention analytics on Spark DataFrames."""

from holdfast.schema import CUSTOMER_SCHEMA, Roles

__all__ = ["CUSTOMER_SCHEMA", "Roles"]
