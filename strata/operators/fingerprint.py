"""Set-based contract fingerprint (schema hash) for many contracts at once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.jsontext import json_quote
from strata.model import Contract

CONTRACT_COLUMNS_SCHEMA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("dtype", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)


def contracts_frame(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """Declared contracts as a long table: one row per (dataset, version, column)."""
    rows = [
        (c.name, c.version, col.name, col.dtype, col.nullable, i, col.description)
        for c in contracts
        for i, col in enumerate(c.columns)
    ]
    return spark.createDataFrame(rows, CONTRACT_COLUMNS_SCHEMA)


def contracts_from_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Contracts stored as JSON documents ({name, version, columns:[...]}), one per
    file or, with ``multi_line=False``, one per line -> long table."""
    doc_schema = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("version", T.StringType()),
            T.StructField(
                "columns",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("name", T.StringType()),
                            T.StructField("dtype", T.StringType()),
                            T.StructField("nullable", T.BooleanType()),
                            T.StructField("description", T.StringType()),
                        ]
                    )
                ),
            ),
        ]
    )
    docs = spark.read.schema(doc_schema).option("multiLine", str(multi_line).lower()).json(path)
    return docs.select(
        F.col("name").alias("dataset_name"),
        "version",
        F.posexplode("columns").alias("position", "c"),
    ).select(
        "dataset_name",
        "version",
        F.col("c.name").alias("column_name"),
        F.col("c.dtype").alias("dtype"),
        F.coalesce(F.col("c.nullable"), F.lit(False)).alias("nullable"),
        F.col("position").cast("int").alias("position"),
        F.coalesce(F.col("c.description"), F.lit("")).alias("description"),
    )


def schema_fingerprint(contract_columns: DataFrame) -> DataFrame:
    """(dataset_name, version) -> schema_hash, n_columns.

    The digest is SHA-256 of the canonical JSON text: keys sorted, columns
    sorted by name, only name/dtype/nullable per column. Column order and
    descriptions do not change it; a type, nullability or version change does.
    """
    entry = F.concat(
        F.lit('{"dtype": '),
        json_quote("dtype"),
        F.lit(', "name": '),
        json_quote("column_name"),
        F.lit(', "nullable": '),
        F.when(F.col("nullable"), F.lit("true")).otherwise(F.lit("false")),
        F.lit("}"),
    )
    per_contract = contract_columns.groupBy("dataset_name", "version").agg(
        F.sort_array(F.collect_list(F.struct(F.col("column_name"), entry.alias("entry")))).alias("cols"),
        F.count(F.lit(1)).alias("n_columns"),
    )
    doc = F.concat(
        F.lit('{"columns": ['),
        F.array_join(F.transform("cols", lambda x: x["entry"]), ", "),
        F.lit('], "name": '),
        json_quote("dataset_name"),
        F.lit(', "version": '),
        json_quote("version"),
        F.lit("}"),
    )
    return per_contract.select(
        "dataset_name", "version", F.sha2(doc, 256).alias("schema_hash"), "n_columns"
    )


def contract_hash_col(name_col: str, version_col: str, columns_by_version: dict) -> Column:
    """Schema hash per row when the column list is declared and only the
    dataset name and version vary by row: a projection (no aggregate, no join).

    ``columns_by_version`` maps a version string to its declared columns
    (``strata.model.Column``). The canonical column part is rendered once on
    the driver; rows whose version is not in the map get null.
    """
    out = None
    for version, cols in columns_by_version.items():
        body = ", ".join(
            json.dumps({"dtype": c.dtype, "name": c.name, "nullable": c.nullable}, sort_keys=True)
            for c in sorted(cols, key=lambda c: c.name)
        )
        doc = F.concat(
            F.lit('{"columns": [' + body + '], "name": '),
            json_quote(name_col),
            F.lit(', "version": '),
            json_quote(version_col),
            F.lit("}"),
        )
        cond = F.col(version_col) == F.lit(version)
        out = F.when(cond, F.sha2(doc, 256)) if out is None else out.when(cond, F.sha2(doc, 256))
    return out
