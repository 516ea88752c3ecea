"""Reading document collections."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import Analyzer, FieldMapping, parse_date

# Declared field types and their column types.  Dates arrive as text.
FIELD_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.StringType(),
}
# In a bulk file an action line says what the line after it is for; a deletion has no such line.
_ACTION = r'^\s*\{\s*"(index|create|update|delete)"\s*:\s*\{'
BROKEN = "_corrupt_record"
# What to do with lines that are not documents of the declared types.
BROKEN_LINES = ("drop", "keep", "fail")


def mapping_schema(properties: Mapping[str, Mapping]) -> T.StructType:
    """Column types of a declared mapping ``{field: {type, index, format}}``."""
    unknown = {p["type"] for p in properties.values()} - set(FIELD_TYPES)
    if unknown:
        raise ValueError(f"unknown field types: {', '.join(sorted(unknown))}")
    fields = [T.StructField(n, FIELD_TYPES[p["type"]]) for n, p in properties.items()]
    return T.StructType(fields)


def field_mapping(
    properties: Mapping[str, Mapping], analyzers: Mapping[str, Analyzer] | None = None
) -> FieldMapping:
    """Which fields are keywords (``index: not_analyzed``) and who analyzes the others."""
    keywords = frozenset(n for n, p in properties.items() if p.get("index") == "not_analyzed")
    named = analyzers or {}
    chosen = {
        n: named[p["analyzer"]] for n, p in properties.items() if p.get("analyzer") in named
    }
    return FieldMapping(keywords, chosen)


def load_corpus(
    spark: SparkSession,
    path: str | list[str],
    properties: Mapping[str, Mapping] | None = None,
    format: str = "json",
    broken: str = "drop",
) -> DataFrame:
    """Documents as ``json`` lines, ``bulk`` files or any column format such as ``parquet``.

    With ``properties`` the schema is declared, so text files are read once, and date fields with
    a format become timestamps (null where the text is no such date).  Lines that do not fit the
    schema are left out, or with ``broken="keep"`` are rows with the line in ``_corrupt_record``,
    or with ``"fail"`` end the job.  Documents of a bulk file have their ``_id`` from the action
    line (null where it names none); deletions and updates are no documents.
    """
    if broken not in BROKEN_LINES:
        raise ValueError(f"broken lines: {broken!r} is not one of {', '.join(BROKEN_LINES)}")
    schema = mapping_schema(properties) if properties else None
    if format == "bulk":
        if schema is None:
            raise ValueError("bulk files need a declared mapping")
        docs = _parsed(_bulk_documents(spark, path), schema, broken, ["_id"])
    elif format == "json" and schema is not None:
        docs = _parsed(spark.read.text(path).select("value"), schema, broken, [])
    else:
        paths = [path] if isinstance(path, str) else path
        docs = spark.read.format(format).load(paths)
    for name, declared in (properties or {}).items():
        if declared["type"] == "date" and dict(docs.dtypes).get(name) == "string":
            parsed = parse_date(F.col(name), declared.get("format", "yyyy-MM-dd HH:mm:ss"))
            docs = docs.withColumn(name, parsed)
    return docs


def _parsed(lines: DataFrame, schema: T.StructType, broken: str, keep: list[str]) -> DataFrame:
    """Lines of JSON in ``value`` as columns."""
    marked = T.StructType([*schema, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "FAILFAST" if broken == "fail" else "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    written = lines.where(F.length(F.trim("value")) > 0)
    docs = written.select(*keep, F.from_json("value", schema if broken == "fail" else marked, options).alias("d"))
    if broken == "fail":
        return docs.select(*keep, "d.*")
    flat = docs.select(*keep, "d.*")
    return flat if broken == "keep" else flat.where(F.col(BROKEN).isNull()).drop(BROKEN)


def _bulk_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(_id, value)``: the lines that follow an action that brings a whole document.

    A document may itself look like an action: in a run of such lines every other one is an
    action.  Lines are numbered inside the split that a task reads; the last line of a split is
    passed on to the next split of its file, so a pair may lie across their border.
    """
    place = ["__file", "__block"]
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
        F.regexp_extract("value", _ACTION, 1).alias("__action"),
    )
    inside = Window.partitionBy(*place).orderBy("__at")
    waits = F.col("__action").isin("index", "create", "update")
    before = F.lag(F.when(waits, F.col("value"))).over(inside)
    # how many action-like lines stand without a break before this one, itself included
    breaks = F.sum(F.when(waits, 0).otherwise(1)).over(inside)
    placed = lines.withColumns({"__before": before, "__break": breaks, "__first": F.row_number().over(inside) == 1})
    run = Window.partitionBy(*place, "__break").orderBy("__at")
    placed = placed.withColumn("__nth", F.sum(F.when(waits, 1).otherwise(0)).over(run))
    last = placed.groupBy(*place).agg(F.max_by(F.struct("value", "__break", "__nth", waits.alias("waits")), "__at").alias("l"))
    # One row per split of the files.  A split that is one single run goes on counting from the one before.
    goes_on = F.col("l.__break") == 0
    splits = Window.partitionBy("__file").orderBy("__block")
    last = last.withColumn("__from", F.sum(F.when(goes_on, 0).otherwise(1)).over(splits))
    counted = F.sum(F.when(F.col("l.waits"), F.col("l.__nth")).otherwise(0))
    open_ = counted.over(Window.partitionBy("__file", "__from").orderBy("__block")) % 2 == 1
    carried = last.withColumn("__open", F.when(open_ & F.col("l.waits"), F.col("l.value")))
    carried = carried.select(*place, F.lag("__open").over(splits).alias("__carried"))
    joined = placed.join(carried.where(F.col("__carried").isNotNull()), place, "left")
    action_before = F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__before"))
    shifted = F.when(F.col("__carried").isNotNull() & (F.col("__break") == 0), F.col("__nth") + 1).otherwise(F.col("__nth"))
    is_document = action_before.isNotNull() & (~waits | (shifted % 2 == 0))
    action = F.regexp_extract(action_before, _ACTION, 1)
    named = F.coalesce(*(F.get_json_object(action_before, f"$.{kind}._id") for kind in ("index", "create")))
    return joined.where(is_document & action.isin("index", "create")).select(named.alias("_id"), "value")


def scan_indices(
    spark: SparkSession,
    paths: Mapping[str, str] | list[str],
    format: str = "parquet",
    ignore_unavailable: bool = False,
    columns: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Several collections as one; ``_index`` says where a document is from.

    ``columns`` may rename columns per collection.  Keys are unique only together with ``_index``.
    """
    named = paths if isinstance(paths, Mapping) else {PurePosixPath(p).stem: p for p in paths}
    frames = []
    for name, path in named.items():
        try:
            frame = spark.read.format(format).load(path)
        except AnalysisException as problem:
            if ignore_unavailable and "PATH_NOT_FOUND" in str(problem):
                continue
            raise
        renamed = (columns or {}).get(name)
        if renamed:
            frame = frame.withColumnsRenamed(dict(renamed))
        frames.append(frame.withColumn("_index", F.lit(name)))
    if not frames:
        raise ValueError("none of the collections is available")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
