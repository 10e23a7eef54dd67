"""File sources: Parquet, CSV and JSON drops, zipped JSON, file listings."""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import csv_name, unique_names
from martloom.operators.change import stamp_run


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files or prefixes; wildcards by ``glob``; columns declared or from the footer."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_csv_drop(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    run_id: str | None = None,
    date_columns: Sequence[str] = (),
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """CSV with a header row: cleaned names, listed date columns parsed, optional run id.

    Pass a schema at scale: inferring one reads the files an extra time.
    """
    reader = spark.read.option("header", "true")
    raw = reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)
    named = raw.toDF(*unique_names([csv_name(c) for c in raw.columns]))
    dates = {c.lower() for c in date_columns}

    def parsed(c: str):
        if c not in dates:
            return F.col(c)
        text = F.col(c).cast("string")
        return F.try_to_timestamp(text, F.lit(date_format)).cast("timestamp_ntz").alias(c)

    return stamp_run(named.select(*[parsed(c) for c in named.columns]), run_id)


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    doc_per_line: bool = False,
    keep_without_items: bool = False,
) -> DataFrame:
    """JSON drops as rows: a list gives its items; an object gives the items of its first
    non-empty list; where no document has a list, each is one row.

    A file holds one document, or one per line. Fields come back in name order when the schema is
    inferred, so "first" is by field name then; pass a schema to fix the order and the types.
    ``keep_without_items`` also keeps objects whose lists are all empty, as rows of their own
    fields; the result then has those fields too.
    """
    reader = spark.read.option("multiLine", str(not doc_per_line).lower())
    docs = (reader.schema(schema) if schema else reader).json(path)
    lists = {f.name: f.dataType for f in docs.schema.fields if isinstance(f.dataType, T.ArrayType)}
    if not lists:
        return docs

    def items(c: Column, kind: T.ArrayType) -> Column:
        record = isinstance(kind.elementType, T.StructType)
        return F.inline(c) if record else F.explode(c).alias("value")

    filled = {c: F.coalesce(F.size(c) > 0, F.lit(False)) for c in lists}
    if len({kind.simpleString() for kind in lists.values()}) == 1:
        chosen = F.coalesce(*[F.when(filled[c], F.col(c)) for c in lists])
        branches = [docs.select(items(chosen, next(iter(lists.values()))))]
    else:
        branches, open_docs = [], docs
        for c, kind in lists.items():
            branches.append(open_docs.where(filled[c]).select(items(F.col(c), kind)))
            open_docs = open_docs.where(~filled[c])
    if keep_without_items:
        none = reduce(lambda a, b: a & b, [~f for f in filled.values()])
        branches.append(docs.where(none).drop(*lists))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def read_json_in_order(
    spark: SparkSession, path: str, schema: T.StructType | str, doc_per_line: bool = False
) -> DataFrame:
    """JSON drops as rows of ``schema``: a list gives its items; an object gives the items of its
    first non-empty list, *first in the document*, whatever the lists are called; an object
    without one is a row itself. Items that are no objects are left out, as are broken documents.

    Each document is read as text and its fields are looked at in the order they stand there; a
    document must fit in a task (a line, with ``doc_per_line``).
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if doc_per_line:
        docs = spark.read.text(path).select(F.col("value").alias("doc"))
    else:
        docs = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
    docs = docs.select(F.trim("doc").alias("doc")).where("doc <> ''")
    # ``json_object_keys`` gives the outermost names as they stand in the document.
    names = F.json_object_keys("doc")
    fields = F.from_json("doc", "map<string, variant>")
    as_list = lambda v: F.try_variant_get(v, "$", "array<variant>")
    lists = F.filter(names, lambda n: F.size(as_list(F.try_element_at(fields, n))) > 0)
    body = F.when(names.isNull(), F.try_parse_json("doc")).otherwise(F.try_element_at(fields, F.get(lists, F.lit(0))))
    whole = names.isNotNull() & (F.size(lists) == 0)
    items = F.when(whole, F.array("doc")).otherwise(F.transform(as_list(body), lambda v: F.to_json(v)))
    texts = docs.select(F.explode(items).alias("item")).where(F.col("item").startswith("{"))
    return texts.select(F.from_json("item", kind).alias("r")).select("r.*")


def split_items(
    docs: DataFrame, key: str, items: str = "items"
) -> tuple[DataFrame, DataFrame]:
    """Nested documents as (parents, children); each child carries its parent's key."""
    parents = docs.drop(items)
    children = docs.select(F.col(key).alias(f"parent_{key}"), F.inline(F.col(items)))
    return parents, children


def list_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Path, size and modification time of every file below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


# Characters of a member that are decoded at a time, and of records that are passed on together.
PIECE = 1 << 20


def json_records(pieces: Iterator[str]) -> Iterator[str]:
    """The records of a JSON document that comes in pieces: the items of a list, or the document
    itself, each as text. Holds one record and one piece; an unfinished document is an error."""
    held, at, depth, start = "", 0, 0, None
    listed = quoted = escaped = False
    scan = re.compile(r'["\\\[\]{},]')
    for piece in itertools.chain(pieces, [None]):
        if piece is None:
            break
        held += piece
        while True:
            if escaped:  # the character after a backslash
                if at >= len(held):
                    break
                at, escaped = at + 1, False
            found = scan.search(held, at)
            if not found:
                at = len(held)
                break
            c, at = found.group(), found.end()
            if quoted:
                quoted = c != '"'
                escaped = c == "\\"
                continue
            if c == '"':
                quoted = True
            elif c in "[{":
                if depth == 0 and c == "[" and not held[: at - 1].strip():
                    listed, held, at = True, held[at:], 0
                depth += 1
            elif c in "]}":
                depth -= 1
                if listed and depth == 0:
                    if held[: at - 1].strip():
                        yield held[: at - 1].strip()
                    held, at = held[at:], 0
            elif c == "," and listed and depth == 1:
                yield held[: at - 1].strip()
                held, at = held[at:], 0
    if depth or quoted:
        raise ValueError("the JSON document is not finished")
    if not listed and held.strip():
        yield held.strip()


def unzip_records(archives: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the JSON documents in a ``content`` column of zip archives.

    Archives are unpacked in parallel. Members are read as streams and cut into records while
    they are unpacked, so a member may be larger than a worker's memory; the archive itself, and
    one record, must fit. A record is passed on as JSON text and typed by Spark.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(blob)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as data, io.TextIOWrapper(data, "utf-8-sig") as text:
                            part, size = [], 0
                            for record in json_records(iter(lambda: text.read(PIECE), "")):
                                part.append(record)
                                size += len(record)
                                if size >= PIECE:
                                    yield pd.DataFrame({"record": part})
                                    part, size = [], 0
                            if part:
                                yield pd.DataFrame({"record": part})

    records = archives.select("content").mapInPandas(unpack, "record string")
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")


def read_zip_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the JSON documents inside the zip archives below ``path``."""
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return unzip_records(archives, schema)


def with_date_layout(df: DataFrame, ts: str, zone: str = "Asia/Kolkata") -> DataFrame:
    """Add year, month and day of the business zone, the columns of the drop layout."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts).cast("timestamp_ntz"))
    return df.withColumns({"year": F.year(local), "month": F.month(local), "day": F.day(local)})


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder on whichever file system its URI names."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def is_missing(problem: AnalysisException) -> bool:
    """Whether a read failed because nothing is there, and for no other reason."""
    return problem.getCondition() == "PATH_NOT_FOUND"
