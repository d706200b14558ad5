"""XML as nested columns, checked against a schema (XSD) by Spark's own reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Where a row that can't be read, or doesn't fit the schema file, keeps its text.
FAULT = "fault_xml"


def _fields(schema: str | StructType) -> StructType:
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return StructType([*fields.fields]).add(FAULT, StringType())


def _options(xsd: str | None) -> dict[str, str]:
    """xsd: path of a schema file that the driver and all executors see. Its types, enumerations, required attributes and order of elements hold."""
    return {"columnNameOfCorruptRecord": FAULT, "mode": "PERMISSIVE", "attributePrefix": "_", **({"rowValidationXSDPath": xsd} if xsd else {})}


def read_elements(spark: SparkSession, path: str, tag: str, schema: str | StructType, xsd: str | None = None) -> DataFrame:
    """A row for each element of that name in the files of a folder, split within files: its attributes as _name, its children as columns, and fault_xml, the text of an element that doesn't fit."""
    return spark.read.format("xml").schema(_fields(schema)).options(rowTag=tag, recursiveFileLookup="true", **_options(xsd)).load(path)


def parsed(xml: Column, schema: str | StructType, xsd: str | None = None) -> Column:
    """A document's root as a struct with fault_xml; null for null."""
    return F.when(xml.isNotNull(), F.from_xml(xml, _fields(schema).simpleString(), _options(xsd)))


def checked(df: DataFrame, xml: str, schema: str | StructType, xsd: str) -> DataFrame:
    """df with `doc`, the document as a struct, null where it doesn't fit the schema file, and `is_valid`, null where there is no document."""
    doc = df.withColumn("doc", parsed(F.col(xml), schema, xsd))
    ok = F.col("doc").isNotNull() & F.col(f"doc.{FAULT}").isNull()
    return doc.withColumn("is_valid", F.when(F.col(xml).isNotNull(), ok)).withColumn("doc", F.when(F.col("is_valid"), F.col("doc").dropFields(FAULT)))
