"""Landing readers that lose nothing: columns beyond, without or in another
order than the declared ones, values of another type, and broken records.

Every reader gives the declared columns and

* ``_rescued``  map of what has no place in them: undeclared fields, and the
  text of values that are not of the declared type (their column is NULL);
  NULL where there is nothing to rescue;
* ``_corrupt``  the raw line of a record that does not parse at all, else NULL
  (all declared columns of such a row are NULL);
* ``_file``     the file that the record came from.

``schema_drift`` compares what a JSON feed holds with what is declared.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import broadcast_if_small

EXTRA_COLUMNS = ["_rescued", "_corrupt", "_file"]


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines of all files under ``path``, with their file and the
    offset of the split they were read from."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select(F.rtrim(F.col("value"), F.lit("\r")).alias("line"), F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_offset"))
            .where("trim(line) <> ''"))


def _or_null(m: Column) -> Column:
    return F.when(F.size(m) > 0, m)


def _placed(raw: Column, schema: T.StructType, typed) -> list[Column]:
    """The declared columns out of ``raw`` (names in lower case to text), and
    ``_rescued``.  ``typed(field)`` is the value as declared, NULL if it is not one."""
    named = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    rest = F.map_filter(raw, lambda k, v: ~F.array_contains(named, k))
    misfits = [F.when(typed(f).isNull() & raw[f.name.lower()].isNotNull(),
                      F.create_map(F.lit(f.name.lower()), raw[f.name.lower()])) for f in schema.fields]
    empty = F.create_map().cast("map<string,string>")
    return [*[typed(f).alias(f.name) for f in schema.fields],
            _or_null(F.map_concat(rest, *[F.coalesce(m, empty) for m in misfits])).alias("_rescued")]


# --- CSV --------------------------------------------------------------------------
def _header(line: str) -> list[str]:
    """Column names in lower case; one that comes again gets a number."""
    out: list[str] = []
    for name in next(csv.reader([line.removeprefix("\ufeff")])):
        name = name.strip().lower()
        out.append(name if name not in out else f"{name}#{sum(n.split('#')[0] == name for n in out) + 1}")
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV files, each read by the header it has itself.

    Headers are taken in one scan of the lines (no parsing, one row per file
    leaves it); the distinct ones, a feed's versions, are parsed on the
    driver.  Then one scan reads all files: a line becomes an array of its
    fields, as many as its file's header has, and a map by that header.  A line
    with more or fewer fields is corrupt; one equal to the header is a header.
    Records that span lines are not supported, as in Spark's own line reader.
    """
    schema, lines = _schema(schema), _lines(spark, path)
    first = (lines.where("_offset = 0").withColumn("_row", F.monotonically_increasing_id())
             .groupBy("_file").agg(F.min_by("line", "_row").alias("_header")))
    names = {r["_header"]: _header(r["_header"]) for r in first.select("_header").distinct().collect()}
    if not names:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_rescued", T.MapType(T.StringType(), T.StringType())),
                                                       T.StructField("_corrupt", T.StringType()), T.StructField("_file", T.StringType())]))
    versions = spark.createDataFrame(list(names.items()), "_header string, _names array<string>")
    files = broadcast_if_small(first.join(F.broadcast(versions), "_header"))
    rows = lines.join(files, "_file").where("line <> _header")

    fields = F.lit(None).cast("array<string>")
    for width in sorted({len(n) for n in names.values()}):
        ddl = ", ".join(f"c{k} string" for k in range(width)) + ", broken string"
        # spaces and empty strings are kept as they are; only an empty unquoted field is NULL
        options = {"columnNameOfCorruptRecord": "broken", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        parsed = F.from_csv("line", ddl, options)
        whole = F.when(parsed["broken"].isNull(), F.array(*[parsed[f"c{k}"] for k in range(width)]))
        fields = F.when(F.size("_names") == width, whole).otherwise(fields)
    rows = rows.withColumn("_fields", fields)
    raw = F.map_from_arrays(F.col("_names"), F.col("_fields"))
    rows = rows.withColumn("_raw", raw)
    raw = F.col("_raw")
    return rows.select(*_placed(raw, schema, lambda f: raw[f.name.lower()].try_cast(f.dataType)),
                       F.when(F.col("_fields").isNull(), F.col("line")).alias("_corrupt"), "_file")


# --- JSON -------------------------------------------------------------------------
def _undeclared(raw: Column, kind: T.DataType) -> Column:
    """Does the JSON text have a field, however deep, that ``kind`` has not?"""
    if isinstance(kind, T.StructType):
        obj = F.from_json(raw, "map<string,string>")
        named = F.array(*[F.lit(f.name.lower()) for f in kind.fields])
        found = F.exists(F.map_keys(obj), lambda k: ~F.array_contains(named, F.lower(k)))
        for f in kind.fields:
            if isinstance(f.dataType, (T.StructType, T.ArrayType)):
                found = found | F.coalesce(_undeclared(obj[f.name], f.dataType), F.lit(False))
        return found
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.exists(F.from_json(raw, "array<string>"), lambda x: F.coalesce(_undeclared(x, kind.elementType), F.lit(False)))
    return F.lit(False)


_OBJECT = r"^\s*\{"


def _records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``line`` as declared columns, with what they have no place for.  A
    nested value with an undeclared field is kept whole in ``_rescued`` beside
    its declared part."""
    rows = lines.withColumn("_all", F.from_json("line", "map<string,string>"))
    # names compare without case, of a name that comes twice the first counts; NULL where the line is no object
    lower = F.transform(F.map_entries("_all"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    rows = rows.withColumn("_all", F.when(F.col("line").rlike(_OBJECT), lower))
    keys = F.transform("_all", lambda e: e["key"])
    first = F.filter("_all", lambda e, k: F.array_position(keys, e["key"]) == k + 1)
    rows = rows.withColumn("_raw", F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.col("_all")).otherwise(first)))
    raw = F.col("_raw")

    def typed(f: T.StructField) -> Column:
        text = raw[f.name.lower()]
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(text, f.dataType)
        return text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)

    nested = [F.when(F.coalesce(_undeclared(raw[f.name.lower()], f.dataType), F.lit(False)),
                     F.create_map(F.lit(f.name.lower()), raw[f.name.lower()]))
              for f in schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    placed = _placed(raw, schema, typed)
    empty = F.create_map().cast("map<string,string>")
    # a nested value may be a misfit and have undeclared fields: one entry
    rescued = F.map_from_entries(F.array_distinct(F.concat(*[F.coalesce(F.map_entries(m), F.map_entries(empty)) for m in [placed[-1], *nested]])))
    return rows.select(*placed[:-1], F.when(raw.isNotNull(), _or_null(rescued)).alias("_rescued"),
                       F.when(raw.isNull(), F.col("line")).alias("_corrupt"), "_file")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines: undeclared fields and values of another type are rescued, a
    line that is no JSON object is corrupt.  One scan, nothing is inferred."""
    return _records(_lines(spark, path), _schema(schema))


def read_json_pages(spark: SparkSession, path: str, element_ddl: str) -> DataFrame:
    """Pages of JSON arrays, one row per record.  A page that does not parse
    is one corrupt row, so are elements that are no objects."""
    pages = _lines(spark, path).withColumn("_page", F.from_json("line", "array<string>"))
    records = pages.where("_page is not null").select(F.explode("_page").alias("line"), "_file")
    broken = pages.where("_page is null").select("line", "_file")
    return _records(records.unionByName(broken), _schema(element_ddl))


# --- what was found ---------------------------------------------------------------
def broken_by_file(landed: DataFrame) -> DataFrame:
    """``_file, records, broken`` of a tolerant read, one row per file."""
    return landed.groupBy("_file").agg(F.count(F.lit(1)).alias("records"), F.count("_corrupt").alias("broken"))


def sound(landed: DataFrame) -> DataFrame:
    """The records that parsed: declared columns and ``_rescued``."""
    return landed.where("_corrupt is null").drop("_corrupt", "_file")


#: Kinds that drift is told in: a type's width is the reader's concern (a value that does not fit is rescued).
_KINDS = {"byte": "integer", "short": "integer", "integer": "integer", "long": "integer", "double": "fraction", "float": "fraction",
          "decimal": "fraction", "string": "text", "boolean": "boolean", "date": "text", "timestamp": "text", "void": "null", "variant": "mixed"}


def _kinds(kind: T.DataType, path: str = "") -> Iterable[tuple[str, str]]:
    """``(path, kind)`` of every field, lists' elements as ``path[]``."""
    if isinstance(kind, T.StructType):
        if path:
            yield path, "record"
        for f in kind.fields:
            yield from _kinds(f.dataType, f"{path}.{f.name.lower()}" if path else f.name.lower())
    elif isinstance(kind, T.ArrayType):
        yield path, "list"
        yield from _kinds(kind.elementType, f"{path}[]")
    else:
        yield path, _KINDS.get(kind.typeName(), kind.simpleString())


def schema_drift(spark: SparkSession, path: str, schema: T.StructType | str, pages: bool = False) -> DataFrame:
    """``field, declared, observed, drift`` of a JSON feed, one row per field
    that is declared or occurs, nested ones by path.

    The records' types are merged by one aggregate over one scan (partial
    sums of schemas, one text leaves it).  ``drift``: ``none``, ``new`` (not
    declared), ``absent`` (never there, or always null), ``widened`` (whole
    numbers became fractions), ``changed`` (any other kind).
    """
    lines = _lines(spark, path)
    if pages:
        lines = lines.select(F.explode(F.from_json("line", "array<string>")).alias("line"))
    # variants name records OBJECT, where Spark's own types say STRUCT
    merged = lines.where(F.col("line").rlike(_OBJECT)).agg(F.schema_of_variant_agg(F.try_parse_json("line")).alias("s")).first()["s"]
    seen = T.DataType.fromDDL((merged or "VOID").replace("OBJECT<", "STRUCT<"))
    declared, observed = dict(_kinds(_schema(schema))), dict(_kinds(seen)) if isinstance(seen, T.StructType) else {}
    rows = []
    for field in sorted({*declared, *observed}):
        want, got = declared.get(field), observed.get(field)
        drift = ("new" if want is None else "absent" if got in (None, "null") else "none" if want == got or (want, got) == ("fraction", "integer")
                 else "widened" if (want, got) == ("integer", "fraction") else "changed")
        rows.append((field, want, got, drift))
    return spark.createDataFrame(rows, "field string, declared string, observed string, drift string")
