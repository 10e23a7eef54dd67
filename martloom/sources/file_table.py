"""Tables as a list of files: a change rewrites the files it touches and keeps all others.

Below a table's path lie data folders (one for each write), manifests and a log. A manifest has a
row for each file of a version: its size, its number of rows, and the smallest and largest value
of each *index* (a set of columns by which files are looked up). Beside each data folder lies a
Bloom filter of each file and index. The log has one record for each version, which names the
manifest; writing it makes the version current, so readers see all of a change or none. The record
of a version number can be written once: of two writers the later one fails, and changed nothing.

File names pass through the driver, as they do in any Spark scan; rows, keys and filters do not.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.skew import all_not_null
from martloom.sources.files import is_missing, remove_folder

FILE_ROWS = 1_000_000
BITS_PER_KEY, PROBES = 12, 6  # of a file's Bloom filter: about one other key in 200 passes
BOUNDS = 128  # values that split an index's range where keys meet files

_RECORD = (
    "number bigint, manifest string, schema string, indexes string, at timestamp, stream string, batch bigint"
)
_FILTERS = "file string, index int, bits binary"


@dataclass(frozen=True)
class Snapshot:
    """A version: its number, the folder of its manifest, and the rows' schema."""

    number: int
    manifest: str
    schema: T.StructType


@dataclass(frozen=True)
class FileTable:
    """``indexes``: the column sets by which files are looked up; the first one also orders the
    rows, so that the files of one write hold ranges of it. ``file_rows``: rows of a file at most."""

    spark: SparkSession
    path: str
    indexes: tuple[tuple[str, ...], ...]
    file_rows: int = FILE_ROWS

    # ---- versions ---------------------------------------------------------------------------

    def log(self) -> DataFrame:
        return self.spark.read.schema(_RECORD).parquet(f"{self.path}/_log_/*")

    def snapshot(self) -> Snapshot | None:
        """The current version; one row of the log comes to the driver."""
        try:
            newest = self.log().agg(F.max_by(F.struct("*"), "number").alias("r")).first()["r"]
        except AnalysisException as problem:
            if is_missing(problem):
                return None
            raise
        if newest is None:
            return None
        held = tuple(map(tuple, json.loads(newest["indexes"])))
        if held != self.indexes:
            raise ValueError(f"the table's indexes are {held}")
        return Snapshot(newest["number"], newest["manifest"], T.StructType.fromJson(json.loads(newest["schema"])))

    def version(self) -> int | None:
        now = self.snapshot()
        return now.number if now else None

    def exists(self) -> bool:
        return self.snapshot() is not None

    def has_batch(self, stream: str, batch: int) -> bool:
        """Whether this batch of a stream is in the table."""
        try:
            return not self.log().where((F.col("stream") == stream) & (F.col("batch") >= batch)).isEmpty()
        except AnalysisException as problem:
            if is_missing(problem):
                return False
            raise

    # ---- reading ----------------------------------------------------------------------------

    def _now(self) -> Snapshot:
        now = self.snapshot()
        if now is None:
            raise FileNotFoundError(f"nothing published under {self.path}")
        return now

    def files(self, now: Snapshot | None = None) -> DataFrame:
        """The manifest: ``file, rows, bytes`` and ``low_i, high_i`` of each index."""
        now = now or self._now()
        return self.spark.read.schema(self._manifest_schema(now.schema)).parquet(f"{self.path}/{now.manifest}")

    def _manifest_schema(self, schema: T.StructType) -> T.StructType:
        out = T.StructType().add("file", "string").add("rows", "long").add("bytes", "long")
        for i, columns in enumerate(self.indexes):
            key = T.StructType([T.StructField(f"k{j}", schema[c].dataType) for j, c in enumerate(columns)])
            out = out.add(f"low_{i}", key).add(f"high_{i}", key)
        return out

    def read(self, files: Iterable[str] | None = None, now: Snapshot | None = None) -> DataFrame:
        """The rows of the current version, or of some of its files."""
        now = now or self._now()
        if files is None:
            files = [r["file"] for r in self.files(now).select("file").toLocalIterator()]
        paths = [f"{self.path}/{f}" for f in files]
        if not paths:
            return self.spark.createDataFrame([], now.schema)
        return self.spark.read.schema(now.schema).parquet(*paths)

    def files_with(
        self, keys: DataFrame, columns: Sequence[str], null_safe: bool = False, now: Snapshot | None = None
    ) -> list[str]:
        """The files that may hold one of the keys: none that holds one is left out.

        Keys and files meet by ranges of the index, split at values of the files themselves; a
        file's Bloom filter then passes the keys inside its range. A key with a NULL is in no
        file, unless ``null_safe``.
        """
        at = self.indexes.index(tuple(columns))
        now = now or self._now()
        fields = [now.schema[c].dataType for c in columns]
        keys = keys if null_safe else keys.where(all_not_null(columns))
        typed = [F.col(c).cast(kind).alias(c) for c, kind in zip(columns, fields)]
        keys = keys.select(*typed).distinct().select(_key(columns).alias("key"), _hash(columns).alias("h"))
        manifest = self.files(now).select("file", F.col(f"low_{at}").alias("low"), F.col(f"high_{at}").alias("high"))
        some = F.pmod(F.xxhash64("file"), F.lit(BOUNDS))
        told = manifest.groupBy(some).agg(F.any_value("low").alias("low"), F.collect_set(_folder("file")).alias("folders"))
        told = told.collect()
        if not told:
            return []
        folders = sorted({f for r in told for f in r["folders"]})
        bound = F.array(*[_literal(r["low"], fields) for r in told])

        def part(c: str) -> Column:
            return F.size(F.filter(bound, lambda b: b <= F.col(c)))

        spread = manifest.withColumn("part", F.explode(F.sequence(part("low"), part("high"))))
        met = keys.withColumn("part", part("key")).join(spread, "part")
        met = met.where((F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")))
        filters = self.spark.read.schema(_FILTERS).parquet(*[f"{self.path}/_blooms_/{f}" for f in folders]).where(F.col("index") == at)
        none = lambda kind: F.lit(None).cast(kind)
        both = filters.select("file", F.lit(0).alias("kind"), none("bigint").alias("h"), "bits").unionByName(
            met.select("file", F.lit(1).alias("kind"), "h", none("binary").alias("bits"))
        )
        # A file's filters come first, then its keys stream past them; a file has few filters.
        passed = both.repartition("file").sortWithinPartitions("file", "kind").mapInArrow(_probe, "file string")
        return sorted(r["file"] for r in passed.distinct().toLocalIterator())

    # ---- writing ----------------------------------------------------------------------------

    def publish(self, df: DataFrame) -> int:
        """A version of these rows alone."""
        return self.commit(add=df, keep=False)

    def commit(
        self,
        add: DataFrame | None = None,
        remove: Sequence[str] = (),
        keep: bool = True,
        batch: tuple[str, int] | None = None,
        after: Snapshot | None = None,
    ) -> int:
        """The next version: the files of the one ``after`` (or the current one) without
        ``remove``, and files of the rows ``add``. ``batch`` records a stream's batch with it."""
        now = after or self.snapshot()
        schema = now.schema if now is not None and keep else None
        described = None
        if add is not None:
            own = T.StructType([T.StructField(f.name, f.dataType) for f in add.schema.fields])
            if schema is not None and own.simpleString() != schema.simpleString():
                raise ValueError(f"rows are {own.simpleString()}, the table is {schema.simpleString()}")
            schema = schema or own
            described = self._write(add, schema)
        return self._switch(now, schema, described, remove, keep, batch)

    def _switch(
        self,
        now: Snapshot | None,
        schema: T.StructType,
        described: DataFrame | None,
        remove: Sequence[str] = (),
        keep: bool = True,
        batch: tuple[str, int] | None = None,
    ) -> int:
        parts = [described] if described is not None else []
        if now is not None and keep:
            gone = self.spark.createDataFrame([(f,) for f in remove], "file string")
            parts.append(self.files(now).join(gone, "file", "left_anti"))
        manifest = f"_manifests_/{uuid.uuid4().hex}"
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        every.coalesce(1 + len(remove) // 10000).write.parquet(f"{self.path}/{manifest}")
        number = now.number + 1 if now is not None else 1
        record = (
            number, manifest, schema.json(), json.dumps(self.indexes), datetime.now(timezone.utc),
            *(batch or (None, None)),
        )
        record = self.spark.createDataFrame([record], _RECORD).coalesce(1)
        record.write.mode("errorifexists").parquet(f"{self.path}/_log_/{number:010d}")
        return number

    def _write(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Write rows as files ordered by the first index; their manifest rows."""
        folder = f"data-{uuid.uuid4().hex}"
        order = list(self.indexes[0])
        # A value of the index may have a large part of the rows: the other columns spread it.
        held = [f.name for f in schema.fields if f.name not in order and not _has_map(f.dataType)]
        spread = [F.xxhash64(*held)] if held else []
        ordered = df.repartitionByRange(*order, *spread).sortWithinPartitions(*order)
        self._write_files(ordered, folder)
        return self._describe(folder, schema)

    def _write_files(self, df: DataFrame, folder: str) -> None:
        df.write.option("maxRecordsPerFile", self.file_rows).parquet(f"{self.path}/{folder}")

    def _describe(self, folder: str, schema: T.StructType) -> DataFrame:
        """Sizes, ranges and Bloom filters of the files of one write."""
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_bytes"))
        described = rows.groupBy("_file").agg(
            F.count(F.lit(1)).alias("rows"), F.max("_bytes").alias("bytes"),
            *[one for i, columns in enumerate(self.indexes) for one in _range(columns, i)],
        )
        # The folder joins a file's name once per file, not once per row.
        named = F.concat(F.lit(f"{folder}/"), F.col("_file")).alias("file")
        described = described.select(named, *[c for c in described.columns if c != "_file"])
        hashes = [_hash(columns).alias(f"h_{i}") for i, columns in enumerate(self.indexes)]
        filters = rows.select("_file", *hashes).mapInArrow(_fill, _FILTERS)
        filters = filters.withColumn("file", F.concat(F.lit(f"{folder}/"), F.col("file")))
        filters.write.parquet(f"{self.path}/_blooms_/{folder}")
        return described

    # ---- upkeep -----------------------------------------------------------------------------

    def compact(self, small_bytes: int, target_bytes: int) -> int | None:
        """Pack files below ``small_bytes`` into files of about ``target_bytes``; larger ones stay.

        Neighbours by the first index share a file, so ranges stay narrow; a file that finds no
        partner stays too. None when nothing is to be done.
        """
        now = self._now()
        small = self.files(now).where(F.col("bytes") < small_bytes).orderBy("low_0", "file")
        bins: list[list[str]] = []
        room = 0
        for row in small.select("file", "bytes").toLocalIterator():
            if not bins or row["bytes"] > room:
                bins.append([])
                room = target_bytes
            bins[-1].append(row["file"])
            room -= row["bytes"]
        packed = [b for b in bins if len(b) > 1]
        if not packed:
            return None
        remove = [f for b in packed for f in b]
        places = [(f"{self.path}/{f}", i) for i, b in enumerate(packed) for f in b]
        places = self.spark.createDataFrame(places, "path string, bin int")
        places = places.select(F.regexp_extract("path", "[^/]+/[^/]+$", 0).alias("_name"), "bin")
        rows = self.read(remove, now)
        rows = rows.withColumn("_name", F.regexp_extract("_metadata.file_path", "[^/]+/[^/]+$", 0))
        rows = rows.join(places, "_name").repartitionById(len(packed), F.col("bin"))
        folder = f"data-{uuid.uuid4().hex}"
        self._write_files(rows.sortWithinPartitions(*self.indexes[0]).drop("_name", "bin"), folder)
        return self._switch(now, now.schema, self._describe(folder, now.schema), remove)

    def expire(self, older_than: datetime) -> int:
        """Drop versions written before ``older_than``, but for the current one, and the files
        that no version left refers to. Readers of dropped versions fail. Returns how many files
        went. The record of each stream's last batch goes only with a later one."""
        now = self._now()
        log = self.log()
        last = log.where("stream IS NOT NULL").groupBy("stream").agg(F.max("number").alias("number"))
        old = log.where((F.col("at") < F.lit(older_than)) & (F.col("number") < now.number))
        old = old.join(last, "number", "left_anti").select("number", "manifest").collect()
        if not old:
            return 0
        numbers = [r["number"] for r in old]
        kept = log.where(~F.col("number").isin(numbers)).select("manifest").distinct().collect()
        manifests = lambda some: self.spark.read.parquet(*[f"{self.path}/{r['manifest']}" for r in some])
        unused = manifests(old).select("file").distinct()
        unused = [r["file"] for r in unused.join(manifests(kept).select("file"), "file", "left_anti").toLocalIterator()]
        for row in old:  # the record first: a version that is listed has its files
            remove_folder(self.spark, f"{self.path}/_log_/{row['number']:010d}")
        for row in old:
            remove_folder(self.spark, f"{self.path}/{row['manifest']}")
        for file in unused:
            remove_folder(self.spark, f"{self.path}/{file}")
        left = {r["f"] for r in manifests(kept).select(_folder("file").alias("f")).distinct().toLocalIterator()}
        for folder in {f.split("/")[0] for f in unused} - left:
            remove_folder(self.spark, f"{self.path}/{folder}")
            remove_folder(self.spark, f"{self.path}/_blooms_/{folder}")
        return len(unused)


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map, which Spark does not hash."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _key(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def _literal(row, kinds: Sequence[T.DataType]) -> Column:
    return F.struct(*[F.lit(row[i]).cast(kind).alias(f"k{i}") for i, kind in enumerate(kinds)])


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def _range(columns: Sequence[str], i: int) -> tuple[Column, Column]:
    """Smallest and largest value of an index, NULL below all others."""
    low, high = F.min(_key(columns)), F.max(_key(columns))
    if len(columns) == 1:  # of one column without a sort
        c = F.col(columns[0])
        low = F.struct(F.when(F.count(c) == F.count(F.lit(1)), F.min(c)).alias("k0"))
        high = F.struct(F.max(c).alias("k0"))
    return low.alias(f"low_{i}"), high.alias(f"high_{i}")


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key in a Bloom filter of so many bits, by double hashing."""
    h = hashes.view(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bloom filters of the files of a scan task: a file's rows come one after another, so a file
    has one for each task that reads of it. Holds the different hashes of one file's batches."""
    now, held = None, []

    def close() -> pa.RecordBatch:
        bits = []
        for parts in zip(*held):
            hashes = pa.array(np.concatenate(parts)).unique().to_numpy()
            size = -(-max(len(hashes), 1) * BITS_PER_KEY // 64) * 64
            marks = np.zeros(size, dtype=bool)
            marks[_bits(hashes, size).ravel().astype(np.int64)] = True
            bits.append(np.packbits(marks, bitorder="little").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([now] * len(bits)), pa.array(range(len(bits)), pa.int32()), pa.array(bits, pa.binary())],
            ["file", "index", "bits"],
        )

    for batch in batches:
        name = batch.column(0).dictionary_encode()
        hashes = batch.columns[1:]
        code = name.indices.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
        for first, end in zip(cuts, cuts[1:]):
            if first == end:
                continue
            own = name.dictionary[int(code[first])].as_py()
            if own != now and held:
                yield close()
                held = []
            now = own
            held.append([h.slice(first, end - first).unique().to_numpy() for h in hashes])
    if held:
        yield close()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of which a filter holds a key."""
    now, filters, done = None, [], False
    for batch in batches:
        passed = []
        for file, kind, h, bits in zip(*(c.to_pylist() for c in batch.columns)):
            if file != now:
                now, filters, done = file, [], False
            if kind == 0:
                filters.append((np.frombuffer(bits, np.uint8), 8 * len(bits)))
            elif not done:
                for marks, size in filters:
                    at = _bits(np.array([h]), size)[0].astype(np.int64)
                    if (marks[at >> 3] >> (at & 7) & 1).all():
                        passed.append(file)
                        done = True
                        break
        yield pa.RecordBatch.from_arrays([pa.array(passed, pa.string())], ["file"])


def _folder(file: str) -> Column:
    return F.substring_index(file, "/", 1)
