"""Collections chosen by name: lists, wildcards and exclusions over the tables of a folder."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from fnmatch import fnmatchcase
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .corpus import scan_indices

# Which collections a wildcard may stand for.
STATES = ("open", "closed", "none", "all")
ALL = "_all"


def _is_pattern(name: str) -> bool:
    return "*" in name


def _states(expand_wildcards: str) -> set[str]:
    asked = {s.strip() for s in expand_wildcards.split(",")}
    if unknown := asked - set(STATES):
        raise ValueError(f"unknown states of collections: {', '.join(sorted(unknown))}")
    return {"open", "closed"} if "all" in asked else asked - {"none"}


def expand_names(
    expression: str | Iterable[str],
    known: Collection[str],
    closed: Collection[str] = (),
    expand_wildcards: str = "open",
    allow_no_indices: bool = True,
    ignore_unavailable: bool = False,
) -> list[str]:
    """The collections that an expression means, each once, in the order in which they are named.

    An expression is a list of names and patterns, or a text with commas between them.  ``*``
    stands for any characters, ``_all`` and an empty expression for everything.  ``-`` before an
    item takes out what earlier items named; at the start it takes from everything.  ``+`` is
    read over.  ``closed`` are the names out of use: a pattern leaves them out unless
    ``expand_wildcards`` is ``closed`` or ``all`` (or both states with a comma), and under
    ``none`` patterns stand for nothing.  A plain name that is unknown or closed is an error, or
    left out with ``ignore_unavailable``; excluding what is not there is none.  A pattern
    without a match is an error only if ``allow_no_indices`` is off, and so is an expression
    that leaves nothing.
    """
    items = expression.split(",") if isinstance(expression, str) else list(expression)
    items = [i.strip() for i in items if i.strip()] or [ALL]
    out_of_use = set(closed)
    states = _states(expand_wildcards)
    usable = sorted(n for n in known if ("closed" if n in out_of_use else "open") in states)
    chosen = dict.fromkeys(usable) if items[0].startswith("-") else {}
    for item in items:
        name = item.lstrip("+") if item.startswith("+") else item.removeprefix("-")
        pattern = "*" if name == ALL else name.replace("[", "[[]").replace("?", "[?]")
        if item.startswith("-"):
            chosen = {n: None for n in chosen if not fnmatchcase(n, pattern)}
        elif name == ALL or _is_pattern(name):
            found = [n for n in usable if fnmatchcase(n, pattern)]
            if not found and not allow_no_indices:
                raise ValueError(f"no collection is like {name}")
            chosen.update(dict.fromkeys(found))
        elif name in known and name not in out_of_use:
            chosen[name] = None
        elif not ignore_unavailable:
            raise ValueError(f"the collection {name} is {'closed' if name in out_of_use else 'missing'}")
    if not chosen and not allow_no_indices:
        raise ValueError("no collection is left")
    return list(chosen)


def list_collections(spark: SparkSession, folder: str, format: str = "parquet") -> dict[str, str]:
    """``{name: path}`` of a folder's tables: what ends in the format's name or has no ending.

    The folder may lie on any file system the session can read.  Names beginning with ``_`` or
    ``.`` are no tables.
    """
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(root)
    named: dict[str, str] = {}
    for status in found:
        path = status.getPath().toString()
        file = PurePosixPath(status.getPath().getName())
        if file.name[0] in "_." or file.suffix not in ("", f".{format}"):
            continue
        if file.stem in named:
            raise ValueError(f"two tables of {folder} are named {file.stem}")
        named[file.stem] = path
    return named


def scan_matching(
    spark: SparkSession,
    folder: str,
    expression: str | Iterable[str] = ALL,
    format: str = "parquet",
    closed: Collection[str] = (),
    expand_wildcards: str = "open",
    allow_no_indices: bool = True,
    ignore_unavailable: bool = False,
    columns: Mapping[str, Mapping[str, str]] | None = None,
    schema: T.StructType | str = "",
) -> DataFrame:
    """The collections of a folder that an expression means, as one; see ``expand_names``.

    Where nothing is left and that is allowed, the result has no rows, and the columns of
    ``schema`` beside ``_index``.  A closed collection that a pattern was allowed to stand for
    is read like the others.
    """
    there = list_collections(spark, folder, format)
    names = expand_names(expression, there, closed, expand_wildcards, allow_no_indices, ignore_unavailable)
    if names:
        return scan_indices(spark, {n: there[n] for n in names}, format, columns=columns)
    empty = spark.createDataFrame([], schema or "_index string").drop("_index")
    return empty.withColumn("_index", F.lit(None).cast("string"))
