"""URL filter: suffix rules first, then a list behind a blocked Bloom filter and an exact join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.skew import lookup_join

BITS_PER_URL = 12
MAX_BYTES = 32 << 20  # the filter is broadcast; a longer list makes it less sharp, never larger
BLOCK_BITS = 512
PROBES = 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without ``index.html``, ``.html`` and the
    closing slash. Scheme, query and fragment do not count. NULL where there is no host."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(?:/index\.html|\.html|/+)$", "")
    return F.when(host != "", F.concat(host, path))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Position in ``rules`` of the longest rule that fits, or NULL."""
    out = F.lit(None).cast("int")
    for i, rule in sorted(enumerate(rules), key=lambda x: len(x[1].text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Bit positions inside a block, ``PROBES`` per hash, by double hashing."""
    low = hashes & np.uint64(0xFFFF)
    step = (hashes >> np.uint64(16)) & np.uint64(0xFFFF) | np.uint64(1)
    return (low[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(BLOCK_BITS)


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) % np.uint64(blocks)


@dataclass(frozen=True)
class BlockedBloom:
    """A Bloom filter whose probes for one key all fall into one 64-byte block."""

    blocks: int
    words: bytes

    def may_hold(self, key: Column, spark) -> Column:
        """True for every listed key and for few others; false for NULL. The filter's size is
        bounded by ``MAX_BYTES``, so it is broadcast."""
        shared = spark.sparkContext.broadcast((self.blocks, self.words))

        @F.pandas_udf("boolean")
        def probe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            blocks, raw = shared.value
            words = np.frombuffer(raw, dtype=np.uint64)
            for hashes in batches:
                h = hashes.to_numpy(dtype=np.int64).view(np.uint64)
                bits = _bits(h)
                at = _block(h, blocks)[:, None] * np.uint64(8) + bits // np.uint64(64)
                hit = (words[at.astype(np.int64)] >> (bits % np.uint64(64))) & np.uint64(1)
                yield pd.Series(hit.all(axis=1))

        return key.isNotNull() & probe(F.xxhash64(key))


def build_bloom(keys: DataFrame, column: str, max_bytes: int = MAX_BYTES) -> BlockedBloom:
    """Fill the filter on the executors: each task sets the bits of its keys in words of 64, equal
    words are or-ed by Spark, and only the words (at most ``max_bytes``) reach the driver."""
    keys = keys.where(F.col(column).isNotNull()).select(F.xxhash64(column).alias("h"))
    n = keys.count()
    blocks = max(1, min(max_bytes * 8, n * BITS_PER_URL) // BLOCK_BITS + 1)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = pdf["h"].to_numpy(dtype=np.int64).view(np.uint64)
            bits = _bits(h)
            at = (_block(h, blocks)[:, None] * np.uint64(8) + bits // np.uint64(64)).ravel()
            mask = (np.uint64(1) << (bits % np.uint64(64))).ravel()
            yield pd.DataFrame({"at": at.astype(np.int64), "mask": mask.view(np.int64)})

    filled = (
        keys.mapInPandas(fill, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask"))
    )
    words = np.zeros(blocks * 8, dtype=np.uint64)
    got = filled.toPandas()
    words[got["at"].to_numpy(dtype=np.int64)] = got["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return BlockedBloom(blocks, words.tobytes())


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, id_column: str = "page_id"
) -> DataFrame:
    """One row per page: id, host, path, ``rule`` (its text, or NULL) and ``verdict``.

    The longest fitting rule decides. Without one, the verdict is block if the URL's canonical
    form is in ``listed`` (column ``url_key``), else allow. The Bloom filter lets through every
    listed URL and few others; those that pass are joined with the list exactly, salted against
    one hot URL, so the rest is never shuffled. NULL URLs and URLs without ``://`` have an empty
    host and path and are allowed; repeated rows are judged alike and all returned; an empty
    list or table is fine; other columns are not read.
    """
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col(id_column).alias(id_column),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        canonical(url).alias("url_key"),
    )
    rows = rows.withColumn("at", rule_for(F.col("host"), F.col("path"), rules))
    texts = F.array(*[F.lit(r.text) for r in rules])
    verdicts = F.array(*[F.lit(r.verdict) for r in rules])
    listed = listed.select("url_key").where("url_key IS NOT NULL").distinct()
    bloom = build_bloom(listed, "url_key")
    key = F.when(F.col("at").isNull(), F.col("url_key"))
    probed = rows.withColumn("maybe", bloom.may_hold(key, pages.sparkSession))
    hits = lookup_join(
        probed.where("maybe"), listed.withColumn("hit", F.lit(True)), ["url_key"], "left"
    )
    judged = hits.unionByName(
        probed.where("NOT maybe").withColumn("hit", F.lit(None).cast("boolean"))
    )
    return judged.select(
        id_column,
        "host",
        "path",
        F.when(F.col("at").isNotNull(), F.get(texts, F.col("at"))).alias("rule"),
        F.when(F.col("at").isNotNull(), F.get(verdicts, F.col("at")))
        .otherwise(F.when(F.coalesce("hit", F.lit(False)), "block").otherwise("allow"))
        .alias("verdict"),
    )
