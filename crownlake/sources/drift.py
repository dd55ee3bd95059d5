"""Schema audit of a landing: declared fields against the fields that landed.

The readers apply declared schemas, so a renamed field reads as null and an
added one is not read at all. The audit reads the records as text, parses each
into a VARIANT and lets ``schema_of_variant_agg`` merge their shapes: one
schema per landing day, reduced map-side. It is compared with the declared one
field by field, nested ones included; the rows are the differences:

* ``added``: landed, not declared;
* ``missing``: declared, in no record of that day;
* ``changed``: landed with a type that the declared one does not take in.

A field that is null in every record is there, but says nothing about its type:
no difference. The driver handles one schema text per landing day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownlake.sources.landing import LANDED_FILES
from crownlake.sources.raw import DAY_FROM_PATH

DRIFT = "ingestion_date date, field string, change string, declared string, landed string"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def fields_of(schema: T.DataType, prefix: str = "") -> dict[str, T.DataType]:
    """Every field by its path: ``a.b`` within structs, ``a[]`` for elements of arrays."""
    out: dict[str, T.DataType] = {}
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            out[path] = f.dataType
            out.update(fields_of(f.dataType, path))
    elif isinstance(schema, T.ArrayType):
        out.update(fields_of(schema.elementType, f"{prefix}[]"))
    return out


def _kind(t: T.DataType) -> str:
    return "object" if isinstance(t, T.StructType) else "array" if isinstance(t, T.ArrayType) else t.simpleString()


def takes(declared: T.DataType, landed: T.DataType) -> bool:
    """Whether a landed type reads as the declared one without loss of its kind."""
    if isinstance(landed, T.NullType):
        return True
    if isinstance(declared, (T.StructType, T.ArrayType)) or isinstance(landed, (T.StructType, T.ArrayType)):
        return _kind(declared) == _kind(landed)
    if isinstance(declared, T.StringType):
        return isinstance(landed, T.StringType)
    if isinstance(declared, WHOLE):
        # JSON numbers without a fraction; a decimal of scale 0 is one that is too long for the smaller types.
        return isinstance(landed, WHOLE) or (isinstance(landed, T.DecimalType) and landed.scale == 0)
    if isinstance(declared, (T.DoubleType, T.FloatType, T.DecimalType)):
        return isinstance(landed, (*WHOLE, T.DoubleType, T.FloatType, T.DecimalType))
    return _kind(declared) == _kind(landed)


def landed_schemas(spark: SparkSession, path: str | list[str], pattern: str = LANDED_FILES, multi_line: bool = False) -> DataFrame:
    """``ingestion_date, schema`` of the records under ``path``: the merged shape of each landing day."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .text(paths, wholetext=multi_line))
    day = F.to_date(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), DAY_FROM_PATH, 1), F.lit("")))
    records = lines.select(day.alias("ingestion_date"), F.try_parse_json("value").alias("record"))
    return records.groupBy("ingestion_date").agg(F.schema_of_variant_agg("record").alias("schema"))


def parsed(text: str) -> T.DataType:
    """A schema text of VARIANT values as a type; an array of records stands for its records."""
    if text in ("VOID", "VARIANT"):
        return T.NullType()
    kind = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    return kind.elementType if isinstance(kind, T.ArrayType) else kind


def schema_drift(spark: SparkSession, path: str | list[str], declared: T.StructType, pattern: str = LANDED_FILES,
                 multi_line: bool = False) -> DataFrame:
    """The differences of each landing day from ``declared``; none for a day without records."""
    want = fields_of(declared)
    rows = []
    for day in landed_schemas(spark, path, pattern, multi_line).collect():  # one row per landing day
        shape = parsed(day["schema"])
        if not isinstance(shape, T.StructType):
            continue
        have = fields_of(shape)
        for field in sorted({**want, **have}):
            parent = field.rsplit(".", 1)[0].removesuffix("[]") if "." in field else None
            if field not in want:
                # What lies within an added or changed field is that field's change.
                if parent is None or (parent in want and takes(want[parent], have[parent])):
                    rows.append((day["ingestion_date"], field, "added", None, _kind(have[field])))
            elif field not in have:
                known = parent is None or (parent in have and not isinstance(have[parent], T.NullType) and takes(want[parent], have[parent]))
                if known and not (parent is not None and isinstance(have[parent], T.ArrayType) and isinstance(have[parent].elementType, T.NullType)):
                    rows.append((day["ingestion_date"], field, "missing", _kind(want[field]), None))
            elif not takes(want[field], have[field]):
                rows.append((day["ingestion_date"], field, "changed", _kind(want[field]), _kind(have[field])))
    return spark.createDataFrame(rows, DRIFT)
