"""Collections of JSON documents without a schema: types found over all rows, in one pass."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType, VariantType

from andesite.functions.semistructured import is_object, with_json

# A quoted name, or a type name where one may stand: first, behind a name, or as an element.
TOKEN = re.compile(r"`(?:[^`]|``)*`|(?:^|(?<=: )|(?<=ARRAY<))(?:OBJECT|VARIANT|VOID)\b")
SPARK_TYPES = {"OBJECT": "STRUCT", "VARIANT": "VARIANT", "VOID": "STRING"}


def merged_schema(documents: DataFrame, column: str = "doc") -> StructType:
    """The schema that all objects of a VARIANT column fit: one aggregation, no sample.

    Numbers widen to a common type.  A field that holds different kinds is VARIANT; one that is
    always null is text.  All fields are nullable.
    """
    objects = F.when(is_object(column), F.col(column))
    text = documents.agg(F.schema_of_variant_agg(objects)).first()[0]
    if not text.startswith("OBJECT<") or text == "OBJECT<>":
        return StructType([])
    ddl = TOKEN.sub(lambda m: SPARK_TYPES.get(m.group(), m.group()), text)
    return DataType.fromDDL(ddl)


def conflicts_as_text(t: DataType) -> DataType:
    """The type with text in place of VARIANT."""
    if isinstance(t, VariantType):
        return StringType()
    if isinstance(t, ArrayType):
        return ArrayType(conflicts_as_text(t.elementType), True)
    if isinstance(t, StructType):
        return StructType([StructField(f.name, conflicts_as_text(f.dataType), True) for f in t])
    return t


def ddl(t: DataType) -> str:
    """The type in SQL, every name quoted."""
    if isinstance(t, ArrayType):
        return f"ARRAY<{ddl(t.elementType)}>"
    if isinstance(t, StructType):
        names = [f.name.replace("`", "``") for f in t]
        return f"STRUCT<{', '.join(f'`{n}`: {ddl(f.dataType)}' for n, f in zip(names, t))}>"
    return t.simpleString()


def typed_documents(
    texts: DataFrame, column: str = "value", conflicts: str = "variant"
) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of JSON texts, one document each, typed by what all of them hold.

    ``conflicts="text"`` gives fields of different kinds as text.  A text that is no JSON object is
    an error row (error, text).  The texts are parsed twice: once for the types, once for the rows.
    """
    if conflicts not in ("variant", "text"):
        raise ValueError("conflicts are given as variant or as text")
    parsed = with_json(texts.select(F.col(column).alias("_text")), "_text", "_doc")
    schema = merged_schema(parsed, "_doc")
    if conflicts == "text":
        schema = conflicts_as_text(schema)
    read = F.try_variant_get("_doc", "$", ddl(schema)) if schema.names else F.struct()
    documents = parsed.filter(is_object("_doc")).select(read.alias("_fields")).select("_fields.*")
    reason: Column = F.when(F.col("_doc").isNull(), F.lit("malformed json")).otherwise(F.lit("document is not an object"))
    errors = parsed.filter(F.coalesce(~is_object("_doc"), F.lit(True))).select(reason.alias("error"), F.col("_text").alias("text"))
    return documents, errors
