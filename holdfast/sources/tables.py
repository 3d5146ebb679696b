"""Reading, cleaning and storing customer tables; running SQL on them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.clean import label_strict, to_number_or_zero
from holdfast.functions.rules import with_segments
from holdfast.schema import CUSTOMER_SCHEMA, Roles
from holdfast.sources import storage

CORRUPT = "_corrupt_record"
_SQL_PIECE = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'"`;/-]+|.""", re.S)


def read_customers_csv(
    spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA,
    more: Mapping[str, T.DataType] | None = None, infer: bool = False,
) -> DataFrame:
    """A CSV file with a header, its columns found by name; no inference pass.

    The columns of ``schema`` come first, in its order, then all others of the file, as text or as the type that ``more``
    gives.  Columns that the file lacks are named in the error, and so is a file of the folder whose header differs.
    Rows that do not fit are kept, with their text in ``_corrupt_record`` (see ``split_rejects``).
    ``infer`` types the other columns by their values (see ``inferred``), which takes one pass over the file.
    """
    # the header line alone: all columns as text
    names = spark.read.option("header", True).csv(path).columns
    missing = [c for c in schema.fieldNames() if c not in names]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    types = {f.name: f.dataType for f in schema.fields}
    kinds = {n: types.get(n) or (more or {}).get(n) or T.StringType() for n in names}
    found = (
        spark.read.schema(T.StructType([T.StructField(n, k) for n, k in [*kinds.items(), (CORRUPT, T.StringType())]]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    own = set(types)
    if infer:
        told = inferred(found, [n for n in names if n not in own and n not in (more or {})])
        found = found.withColumns({n: F.expr(f"try_cast(nullif(trim(`{n}`), '') as {t.simpleString()})") for n, t in told.items()})
    return found.select(*(f"`{c}`" for c in [*types, *(n for n in names if n not in own), CORRUPT]))


def inferred(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """Types of text columns by their values: bigint or double where each value that is not blank is one, else none is given.

    One aggregation counts, for all columns at once, what can be cast. A column of blanks alone stays text.
    """
    aggs = []
    for i, c in enumerate(columns):
        text = f"nullif(trim(`{c}`), '')"
        whole = f"rlike({text}, '^[+-]?[0-9]+$') AND try_cast({text} AS BIGINT) IS NOT NULL"
        number = f"NOT rlike({text}, '[A-Za-z]$') AND try_cast({text} AS DOUBLE) IS NOT NULL"
        aggs += [F.expr(e).alias(f"{k}{i}") for k, e in
                 (("n", f"count({text})"), ("whole", f"count_if({whole})"), ("number", f"count_if({number})"))]
    row = df.agg(*aggs).first() if aggs else None
    kinds = {}
    for i, c in enumerate(columns):
        if row[f"n{i}"] and row[f"whole{i}"] == row[f"n{i}"]:
            kinds[c] = T.LongType()
        elif row[f"n{i}"] and row[f"number{i}"] == row[f"n{i}"]:
            kinds[c] = T.DoubleType()
    return kinds


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rows that do not) of ``read_customers_csv``; the first without the column of the reader."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def clean_customers(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Total as a number (blank or malformed: 0), label as strict 0/1."""
    out = df.withColumn(roles.total, to_number_or_zero(F.col(roles.total), "decimal(18,2)"))
    if isinstance(df.schema[roles.label].dataType, T.StringType):
        out = out.withColumn(roles.label, label_strict(F.col(roles.label)))
    return out


def write_table(df: DataFrame, path: str, if_exists: str = "replace") -> DataFrame:
    """Write as one plain Parquet folder, for any tool to read, and return it; 'skip' keeps one that is there.

    Who reads while it is replaced may fail; ``store_table`` keeps readers safe.
    """
    spark = df.sparkSession
    if if_exists not in ("replace", "skip"):
        raise ValueError("if_exists must be 'replace' or 'skip'")
    if if_exists == "replace" or not storage.path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def store_table(
    df: DataFrame, path: str, if_exists: str = "replace", keep: int = 2, verify: Callable[[], None] | None = None
) -> DataFrame:
    """Store in versions and return the stored one; 'skip' keeps one that is there. ``read_table`` finds the current version.

    Each write is a version of its own, in a folder below ``path``, and becomes the table when it is complete and ``verify`` has not
    raised. Readers of the version before go on; a write that fails leaves it in place.
    """
    spark = df.sparkSession
    if if_exists not in ("replace", "skip"):
        raise ValueError("if_exists must be 'replace' or 'skip'")
    if if_exists == "skip" and storage.current_version(spark, path):
        return read_table(spark, path)
    version = storage.new_version(path)
    try:
        df.write.parquet(version)
        if verify is not None:
            verify()
    except BaseException:
        storage.removed(spark, version)
        raise
    storage.make_current(spark, version, keep)
    return spark.read.schema(df.schema).parquet(version)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stored table."""
    version = storage.current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(version)


def feature_table(raw: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """The stored feature table: ten raw columns and the three derived segments."""
    return with_segments(raw.select(*roles.feature_table_columns()), roles)


SEGMENTS = ("tenure_bucket", "charge_tier", "risk_flag")


def training_frame(raw: DataFrame, derived: DataFrame | None = None, roles: Roles = Roles()) -> DataFrame:
    """All raw columns plus the derived segments.

    Without ``derived`` the segments are computed in place, which needs no join.
    With it, it is left-joined on the identifier, where NULL matches NULL. The identifier must be unique in ``derived``; see
    ``store_training_frame`` for a join that makes sure.
    """
    if derived is None:
        return with_segments(raw, roles)
    return _joined(raw, derived.select(roles.id, *SEGMENTS), roles)


def _joined(raw: DataFrame, segments: DataFrame, roles: Roles) -> DataFrame:
    other = segments.withColumnRenamed(roles.id, "__id")
    both = raw.join(other, F.col(f"`{roles.id}`").eqNullSafe(F.col("__id")), "left")
    return both.select(*(F.col(f"`{c}`") for c in raw.columns), *SEGMENTS)


def store_training_frame(raw: DataFrame, derived: DataFrame, path: str, roles: Roles = Roles()) -> DataFrame:
    """``training_frame`` of both tables, stored; identifiers that ``derived`` has more than once raise with their number.

    They are counted while the join runs, so ``derived`` is read once. What was written is dropped, and a table that was at
    ``path`` before stays.
    """
    if raw.isEmpty() or derived.isEmpty():  # Spark drops the join, and with it what it would count
        return store_table(training_frame(raw, derived, roles), path)
    seen = Observation("identifiers")
    once = (
        derived.groupBy(roles.id).agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(c) for c in SEGMENTS))
        .observe(seen, F.count_if(F.col("__n") > 1).alias("repeated"), F.coalesce(F.sum("__n") - F.count(F.lit(1)), F.lit(0)).alias("surplus"))
    )

    def verify() -> None:
        repeated, surplus = (seen.get[k] for k in ("repeated", "surplus"))
        if repeated:
            raise ValueError(f"{repeated} identifiers occur more than once in the derived table ({surplus} rows too many)")

    return store_table(_joined(raw, once.drop("__n"), roles), path, verify=verify)


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Identifiers that occur more than once, with their number of rows."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def member_filter(df: DataFrame, column: str, members: Iterable[object]) -> DataFrame:
    return df.where(F.col(column).isin(*members))


def register_views(
    raw: DataFrame, roles: Roles = Roles(), raw_name: str = "raw_data", feature_name: str = "churn_features"
) -> DataFrame:
    """Make the raw and the feature table visible to SQL; returns the feature table."""
    features = feature_table(raw, roles)
    raw.createOrReplaceTempView(raw_name)
    features.createOrReplaceTempView(feature_name)
    return features


def run_sql(spark: SparkSession, sql: str | Path) -> DataFrame:
    """Run the statements of a text or a file one after another; returns the last one's result."""
    text = sql.read_text(encoding="utf-8") if isinstance(sql, Path) else sql
    done = [spark.sql(s) for s in statements(text)]
    if not done:
        raise ValueError("no statement")
    return done[-1]


def statements(text: str) -> list[str]:
    """A script's statements: cut at semicolons outside strings, names in backticks and comments."""
    parts = [""]
    for piece in _SQL_PIECE.findall(text):
        if piece == ";":
            parts.append("")
        elif not piece.startswith(("--", "/*")):
            parts[-1] += piece
        else:
            parts[-1] += " "
    return [s.strip() for s in parts if s.strip()]
