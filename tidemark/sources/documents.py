"""JSON and XML sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import null_if_in
from tidemark.lookups import JSON_NULL_TEXTS, XML_NULL_TEXTS
from tidemark.operators.quality import BAD, POSITION
from tidemark.schemas import text_schema
from tidemark.session import settled, written
from tidemark.sources.delimited import BYTEWISE
from tidemark.sources.position import opened, position
from tidemark.sources.ranges import RECORD, json_layout, pieces, records, xml_layout


def _flat(schema: T.StructType, root: Column | None = None, prefix: str = "") -> list[tuple[str, Column]]:
    """Leaf columns of nested structs under dotted names; lists become JSON text."""
    leaves: list[tuple[str, Column]] = []
    for field in schema:
        c = F.col(f"`{field.name}`") if root is None else root.getField(field.name)
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            leaves += _flat(field.dataType, c, name + ".")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            leaves.append((name, F.to_json(c)))
        else:
            leaves.append((name, c.cast("string")))
    return leaves


def _top(schema: T.StructType) -> list[tuple[str, Column]]:
    return [
        (f.name, F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
         else F.col(f"`{f.name}`").cast("string"))
        for f in schema
    ]


def read_json(
    spark: SparkSession,
    path: str | list[str],
    record_path: str | None = None,
    normalize: bool = True,
    encoding: str = "utf-8",
    columns: list[str] | None = None,
    lines: bool = False,
    keep_position: bool = False,
    keep_bad: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Objects, or a list of them, as text columns.

    Nested objects become dotted columns unless `normalize` is off; `record_path` names an inner list
    whose elements are the rows. Given `columns`, their names are the schema and no pass over the
    data is needed to find it. The objects of a list, however it is laid out, are cut by many tasks (see
    `ranges`); with a record path a file is one document and read by one. `lines` says that there is one object
    per line, which saves looking for them. An object that can't be parsed is an error, unless `keep_bad` asks
    for it as a row that has only `_bad_record`, its text. `seen` is told, by the job that reads the rows, the
    schema merged over all objects, also of fields that `columns` leaves out (see `leaf_fields`).
    """
    if record_path is None and encoding.lower() in BYTEWISE:
        if lines:
            text = opened(lambda: spark.read.option("encoding", encoding).text(path), path)
            records_ = text.where(F.trim("value") != "").select(position(), F.col("value").alias(RECORD))
        else:
            records_ = records(pieces(spark, path, "}", encoding), json_layout())
        if seen is not None:
            merged = F.schema_of_variant_agg(F.try_parse_json(F.regexp_replace(RECORD, _BEFORE, "")))
            records_ = records_.observe(seen, merged.alias("schema"))
        raw = _parsed_records(records_, columns, keep_bad)
        place = [F.col(POSITION)] if keep_position else []
        leaves = _flat(raw.drop(POSITION, BAD).schema) if normalize else _top(raw.drop(POSITION, BAD).schema)
        bad = [F.col(BAD)] if keep_bad else []
        return raw.select(*[null_if_in(c, JSON_NULL_TEXTS).alias(name) for name, c in leaves], *bad, *place)
    reader = spark.read.options(
        multiLine=not lines, primitivesAsString=True, mode="FAILFAST", encoding=encoding
    )
    if columns:
        reader = reader.schema(text_schema(columns))
    raw = opened(lambda: reader.json(path), path)
    place = [position()] if keep_position else []
    if record_path and record_path in raw.columns:
        kind = raw.schema[record_path].dataType
        inner = F.col(f"`{record_path}`")
        raw = raw.select(
            (F.explode(inner) if isinstance(kind, T.ArrayType) else inner).alias("_record"), *place
        )
        record = raw.schema["_record"].dataType
        if not isinstance(record, T.StructType):
            leaves = [(record_path, F.col("_record").cast("string"))]
        else:
            leaves = _flat(record, F.col("_record"))
        place = [F.col(POSITION)] if keep_position else []
        if keep_position:
            # Several rows share the place of their object; number them apart.
            place = [F.struct(POSITION, F.monotonically_increasing_id().alias("record")).alias(POSITION)]
    else:
        leaves = _flat(raw.schema) if normalize else _top(raw.schema)
    bad = [F.lit(None).cast("string").alias(BAD)] if keep_bad else []
    return raw.select(*[null_if_in(c, JSON_NULL_TEXTS).alias(name) for name, c in leaves], *bad, *place)


#: What stands before an object: the list's bracket, commas, blanks, a byte order mark.
_BEFORE = r"^[\s,\[\uFEFF]+"


def leaf_fields(merged: str) -> T.StructType:
    """The fields of a merged JSON schema under dotted names, as `read_json` names its columns. A field with objects
    in some records and other values in others counts as one field."""
    kind = T._parse_datatype_string(merged.replace("OBJECT<", "STRUCT<"))
    if not isinstance(kind, T.StructType):  # no record, or none that is an object
        return T.StructType()

    def leaves(struct: T.StructType, prefix: str) -> list[T.StructField]:
        found = []
        for f in struct:
            inner = isinstance(f.dataType, T.StructType) and f.dataType.fields
            found += leaves(f.dataType, f"{prefix}{f.name}.") if inner else [T.StructField(prefix + f.name, T.StringType())]
        return found

    return T.StructType(leaves(kind, ""))


def _parsed_records(found: DataFrame, columns: list[str] | None, keep_bad: bool) -> DataFrame:
    """Objects as columns with their place. Without given columns the schema is merged over all of them."""
    spark = found.sparkSession
    text = F.regexp_replace(RECORD, _BEFORE, "")
    options = {"primitivesAsString": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    found = found.select(text.alias(RECORD), POSITION)
    if columns:
        schema = text_schema(columns)
    else:
        found = settled(found)
        # An object on one line each, which is a format that Spark finds the schema of by itself.
        flat = found.select(F.regexp_replace(RECORD, r"[\r\n]+", " ").alias("value"))
        schema = spark.read.options(**options).json(written(flat, "text")).schema
        schema = T.StructType([f for f in schema if f.name != BAD])
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = found.select(_once(F.from_json(RECORD, whole, options)).alias("_row"), RECORD, POSITION)
    if keep_bad:
        return parsed.select("_row.*", POSITION)
    bad = F.col(f"_row.{BAD}").isNotNull()
    return parsed.select(_or_fail(bad, "JSON object", whole).alias("_row"), POSITION).select("_row.*", POSITION).drop(BAD)


def _once(c: Column) -> Column:
    """The column, in a way that keeps the optimizer from copying a parse into filters, or from asking it of rows
    that a filter before it drops."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def _or_fail(bad: Column, what: str, kind: T.StructType) -> Column:
    """The parsed row, or an error that shows the text."""
    message = F.concat(F.lit(f"no {what}: "), F.substring(RECORD, 1, 200))
    return _once(F.when(bad, F.raise_error(message).cast(kind)).otherwise(F.col("_row")))


_XML_OPTIONS = {"inferSchema": "false", "attributePrefix": "_attr_", "ignoreSurroundingSpaces": "false"}
#: The name that records of any tag get, so that one reader takes them all.
_ROW = "tidemark_record"


def read_xml(
    spark: SparkSession,
    path: str | list[str],
    record_tag: str | None = None,
    encoding: str = "utf-8",
    columns: list[str] | None = None,
    keep_position: bool = False,
    keep_bad: bool = False,
) -> DataFrame:
    """Elements as rows and their sub-elements as text columns; empty and absent ones are NULL.

    The records are the children of the root, all of them or those of one tag; elements of that tag at any other
    depth are no records. Many tasks share a file (see `ranges`). Records without any sub-element are left out.
    A record that can't be parsed is an error, unless `keep_bad` asks for it as a row that has only
    `_bad_record`, its text. Files must be in an encoding of which ASCII is a part.
    """
    if encoding.lower() not in BYTEWISE:
        raise ValueError(f"XML can't be cut in {encoding}")
    found = records(pieces(spark, path, ">", encoding), xml_layout())
    # What stands before the element: text of the root.
    name = F.regexp_extract(RECORD, r"^[^<]*<([A-Za-z_][\w.\-:]*)", 1)
    found = found.select(F.regexp_replace(RECORD, r"^[^<]+", "").alias(RECORD), name.alias("_name"), POSITION)
    found = found.where(F.col("_name") == record_tag if record_tag else F.col("_name") != "")
    opening, closing = r"^<[\w.\-:]+", r"</[\w.\-:]+\s*>$"
    named = F.regexp_replace(F.regexp_replace(RECORD, opening, f"<{_ROW}"), closing, f"</{_ROW}>")
    options = {**_XML_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    found = found.select(named.alias("_xml"), RECORD, POSITION)
    if columns:
        schema = text_schema(columns)
    else:
        found = settled(found)
        flat = written(found.select(F.regexp_replace("_xml", r"[\r\n]+", " ").alias("value")), "text")
        # The newer parser wants a file with one root; this one takes a file of records, and splits it.
        inferred = spark.read.format("xml").options(rowTag=_ROW, useLegacyXMLParser="true", **options).load(flat).schema
        schema = T.StructType([f for f in inferred if f.name != BAD])
        if not schema.fields:
            raise ValueError(f"no records in {path}")
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = found.select(_once(F.from_xml("_xml", whole, options)).alias("_row"), RECORD, POSITION)
    bad = F.col(f"_row.{BAD}").isNotNull()
    if not keep_bad:
        parsed = parsed.withColumn("_row", _or_fail(bad, "XML element", whole))
    elements = parsed.select("_row.*", F.when(bad, F.col(RECORD)).alias("_raw"), POSITION)
    names = [c for c in schema.names if not c.startswith("_attr_") and c != "_VALUE"]
    kept = [F.col("_raw").alias(BAD)] if keep_bad else []
    rows = elements.select(
        *[null_if_in(_element_text(elements, c), XML_NULL_TEXTS).alias(c) for c in names], *kept, POSITION
    )
    rows = rows.dropna("all", subset=[*names, BAD] if keep_bad else names) if names else rows
    return rows if keep_position else rows.drop(POSITION)


def _element_text(records: DataFrame, name: str) -> Column:
    kind, c = records.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StructType):  # an element with attributes
        return c["_VALUE"].cast("string") if "_VALUE" in kind.names else F.to_json(c)
    if isinstance(kind, T.ArrayType):  # a repeated element: the last one counts
        last = F.element_at(c, -1)
        return last.cast("string") if not isinstance(kind.elementType, T.StructType) else F.to_json(last)
    return c.cast("string")
