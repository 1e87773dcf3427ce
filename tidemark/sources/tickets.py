"""Support-ticket input with remappable field names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICKET_SCHEMA = T.StructType(
    [
        T.StructField("ticket_id", T.StringType()),
        T.StructField("issue_created", T.TimestampNTZType()),
        T.StructField("first_response_at", T.TimestampNTZType()),
        T.StructField("issue_resolution_date", T.TimestampNTZType()),
        T.StructField("issue_status", T.StringType()),
        T.StructField("issue_priority", T.StringType()),
        T.StructField("queue_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("assigned_agent", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("first_response_sla_minutes", T.IntegerType()),
        T.StructField("resolution_sla_hours", T.IntegerType()),
        T.StructField("first_response_breached", T.BooleanType()),
        T.StructField("resolution_sla_breached", T.BooleanType()),
        T.StructField("first_response_time_minutes", T.DoubleType()),
        T.StructField("resolution_time_minutes", T.DoubleType()),
        T.StructField("reopen_count", T.LongType()),
        T.StructField("csat_score", T.DoubleType()),
        T.StructField("escalated_flag", T.BooleanType()),
        T.StructField("deleted_flag", T.BooleanType()),
    ]
)


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampNTZType)


def _read_type(field: T.StructField) -> T.DataType:
    """How a field is read from documents: times as they are written, numbers as doubles, which documents hold by default."""
    if _is_time(field):
        return T.StringType()
    return T.DoubleType() if isinstance(field.dataType, T.NumericType) else field.dataType


def _nested_schema(kinds: Mapping[str, T.DataType]) -> T.StructType:
    """The struct type whose dotted paths are the given ones."""
    groups: dict[str, dict[str, T.DataType]] = {}
    for path, kind in kinds.items():
        head, _, rest = path.partition(".")
        groups.setdefault(head, {})[rest] = kind
    fields = []
    for head, inner in groups.items():
        if "" in inner and len(inner) > 1:
            raise ValueError(f"{head} is mapped both as a value and as a document")
        fields.append(T.StructField(head, inner[""] if "" in inner else _nested_schema(inner)))
    return T.StructType(fields)


def _utc_wall_clock(instant: Column) -> Column:
    """An instant as UTC wall-clock time, by its distance from the epoch; no local time comes between."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _written_time(text: Column) -> Column:
    """A time as documents write it: text with or without a zone (then UTC), or ``{"$date": text or milliseconds}``."""
    date = F.get_json_object(text, "$['$date']")
    long = F.get_json_object(text, "$['$date']['$numberLong']")
    value = F.coalesce(long, date, text)
    zoned = F.when(value.rlike(r"(Z|UTC|[+-]\d{2}:?\d{2})\s*$"), value).otherwise(F.concat(F.trim(value), F.lit("Z")))
    instant = F.when(value.rlike(r"^-?\d{6,}$"), F.timestamp_millis(value.try_cast("bigint"))).otherwise(zoned.try_cast("timestamp"))
    return _utc_wall_clock(instant)


def read_tickets(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    mapping: Mapping[str, str] | None = None,
) -> DataFrame:
    """Tickets with the standard column names and types.

    ``mapping`` says which source field holds a standard column, for fields named differently at the source; a dotted path
    names a field of an inner document. A mapped field that no ticket of a non-empty source has raises an error, at the
    price of one pass over the source; fields that are not mapped and absent come out as NULL. Numbers may be written
    as whole or as fractional ones; counts are cut to whole ones. Instants become UTC wall-clock times, whatever the
    session zone; text without a zone is taken as UTC. ``fmt`` is json, csv (with a header) or parquet.
    """
    source_of = {field.name: (mapping or {}).get(field.name, field.name) for field in TICKET_SCHEMA}
    unknown = set(mapping or {}) - set(source_of)
    if unknown:
        raise ValueError(f"not ticket columns: {sorted(unknown)}")
    reader = spark.read
    if fmt == "json":
        reader = reader.schema(_nested_schema({source_of[field.name]: _read_type(field) for field in TICKET_SCHEMA}))
    elif fmt == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    source = reader.format(fmt).load(path)

    def raw(name: str) -> Column | None:
        kind: T.DataType = source.schema
        for part in name.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.names:
                return None
            kind = kind[part].dataType
        return F.col(".".join(f"`{part}`" for part in name.split(".")))

    absent = [name for name in (mapping or {}).values() if raw(name) is None]
    if mapping and not absent:
        seen = source.agg(F.count(F.lit(1)).alias("n"), *[F.count(raw(v)).alias(k) for k, v in mapping.items()]).first()
        absent = [v for k, v in mapping.items() if seen["n"] and not seen[k]]
    if absent:
        raise ValueError(f"mapped fields that the source lacks: {sorted(absent)}")

    def column(field: T.StructField) -> Column:
        value = raw(source_of[field.name])
        if value is None:
            return F.lit(None).cast(field.dataType)
        if not _is_time(field):
            return value.cast("double").cast(field.dataType) if isinstance(field.dataType, T.NumericType) else value.cast(field.dataType)
        kind = source.select(value.alias("v")).schema["v"].dataType
        if isinstance(kind, T.StringType):
            return _written_time(value)
        return _utc_wall_clock(value) if isinstance(kind, T.TimestampType) else value.cast(field.dataType)

    return source.select(*[column(field).alias(field.name) for field in TICKET_SCHEMA])


# How documents write typed numbers and identifiers, as an inner document with one such field.
_NUMBER_FORMS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")
_ID_FORM = "$oid"


def _path(name: str, *inner: str) -> str:
    """The variant path of a dotted field name and further fields in it."""
    return "$" + "".join(f"['{part}']" for part in (*name.split("."), *inner))


def _from_variant(field: T.StructField, name: str) -> Column:
    """A field of the document ``doc`` in whichever form it is written there; NULL where none of them can be read as the type."""

    def got(path: str, kind: str) -> Column:
        return F.try_variant_get("doc", path, kind)

    if _is_time(field):
        return _written_time(got(_path(name), "string"))
    if isinstance(field.dataType, T.NumericType):
        # Whole numbers go by decimals, so that none of 19 digits is lost.
        kind = "decimal(38,9)" if isinstance(field.dataType, T.IntegralType) else "double"
        written = [got(_path(name), "string"), *(got(_path(name, form), "string") for form in _NUMBER_FORMS)]
        return F.coalesce(*[F.trim(text).try_cast(kind) for text in written]).try_cast(field.dataType)
    if isinstance(field.dataType, T.BooleanType):
        return F.coalesce(got(_path(name), "boolean"), F.trim(got(_path(name), "string")).try_cast("boolean"))
    return F.coalesce(got(_path(name, _ID_FORM), "string"), got(_path(name), "string"))


def read_ticket_documents(spark: SparkSession, path: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Tickets from JSON documents whose fields change type from document to document.

    Every line is kept as a VARIANT, so a number, its text and a typed inner document (``{"$numberLong": "3"}``, ``{"$oid": ...}``,
    ``{"$date": ...}``) may stand in the same field of the same file and none is lost to a schema. ``mapping`` is as in ``read_tickets``; a
    field that a document lacks, or that holds something else, is NULL. Text fields that hold a document have its JSON.
    """
    unknown = set(mapping or {}) - set(TICKET_SCHEMA.fieldNames())
    if unknown:
        raise ValueError(f"not ticket columns: {sorted(unknown)}")
    documents = spark.read.option("singleVariantColumn", "doc").json(path)
    return documents.select(*[_from_variant(field, (mapping or {}).get(field.name, field.name)).alias(field.name) for field in TICKET_SCHEMA])


def document_schema(spark: SparkSession, path: str) -> DataFrame:
    """How many documents there are and the schema that covers them all, with VARIANT where a field changes type."""
    documents = spark.read.option("singleVariantColumn", "doc").json(path)
    return documents.agg(F.count(F.lit(1)).alias("documents"), F.schema_of_variant_agg("doc").alias("covering_schema"))
