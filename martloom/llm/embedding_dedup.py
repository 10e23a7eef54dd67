"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated at random and cut into blocks. Two vectors within squared distance T
of each other are, in at least one block, within that block's share of T (its share of the
dimensions). So each block is joined by range on its own: a grid over its first axes brings
together what may be close there, and the union of what passes is checked exactly.

The vectors of a label are packed into chunks once. A tile is a pair of chunks of one label: its
task reads both from the shared folder and joins all blocks there, so that no vector is shuffled
or written again for a block, a cell or a tile.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import kept, runs
from martloom.llm.components import components
from martloom.operators.skew import lookup_join
from martloom.session import settle

THRESHOLD = 0.93
BLOCKS = 8
AXES = 2  # axes of a block that make up its grid
CELL = 1.0  # width of a grid's cells, in times the range
TILE = 4096  # vectors on a side of a tile in which pairs are compared
TILE_BYTES = 8 << 20  # and bytes of theirs, as doubles
SLACK = 1e-9  # added to distances, so that rounding loses no pair
SEED = 7
ROWS = 256  # vectors compared at a time with one side of a tile
PAIRS = 1 << 16  # pairs checked at a time
SEEN = 1 << 16  # vectors that a task remembers while it reads

_CHUNK = ["lot", "dims", "chunk"]  # a lot is a label with vectors of one length


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_bounds(dims: int, blocks: int) -> list[tuple[int, int]]:
    cut = np.linspace(0, dims, min(blocks, dims) + 1).astype(int).tolist()
    return list(zip(cut, cut[1:]))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1, without overflow for very large or small components."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _usable(vector: str) -> Column:
    """Neither NULL nor empty nor zero, and every component a finite number."""
    v = F.col(vector)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0)


def _element(x) -> str:
    return "" if x is None else "nan" if math.isnan(x) else repr(float(x) + 0.0)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``print``, a SHA-256 by which equal vectors are known, and the components as bytes: of a
    usable vector only, and not where this task has lately met it under that label."""
    seen: set[tuple] = set()
    for batch in batches:
        labels = batch.column("label").to_pylist()
        usable = np.array(batch.column("usable").to_pylist(), dtype=bool)
        vector = batch.column("vector")
        prints: list[bytes] = [b""] * len(labels)
        dims: list[int | None] = [None] * len(labels)
        data: list[bytes | None] = [None] * len(labels)
        at = np.flatnonzero(usable)
        taken = vector.take(pa.array(at))
        sizes = taken.value_lengths().to_pylist()
        flat = taken.flatten().to_numpy(zero_copy_only=False)
        flat = (flat if flat.dtype == np.float32 else flat.astype(np.float64)) + flat.dtype.type(0)
        start = 0
        for i, size in zip(at.tolist(), sizes):
            raw = flat[start : start + size].tobytes()
            start += size
            prints[i], dims[i] = hashlib.sha256(raw).digest(), size
            if (labels[i], prints[i]) not in seen:
                if len(seen) == SEEN:
                    seen.clear()
                seen.add((labels[i], prints[i]))
                data[i] = raw
        for i in np.flatnonzero(~usable).tolist():
            v = vector[i].as_py()
            text = "null" if v is None else f"[{','.join(map(_element, v))}]"
            prints[i] = hashlib.sha256(text.encode()).digest()
        columns = [batch.column(n) for n in ("vec_id", "label", "usable")]
        columns += [pa.array(prints, pa.binary()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "usable", "print", "dims", "data"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by chunk and print: the one with a node, and the first with a vector."""
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(n).to_pylist() for n in (*_CHUNK, "print"))))
        has = batch.column("data").is_valid().to_pylist()
        take = []
        for i, key in enumerate(keys):
            if has[i]:
                if key == last:
                    continue
                last = key
            take.append(i)
        yield batch.take(pa.array(take, pa.int64()))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a chunk: its nodes in order, their copies and vectors."""
    names = [*_CHUNK, "nodes", "copies", "vectors"]
    for chunk in runs(_once(batches), len(_CHUNK)):
        chunk = chunk.combine_chunks()
        known, full = chunk.filter(chunk["node"].is_valid()), chunk.filter(chunk["data"].is_valid())
        if known["print"] != full["print"]:
            raise ValueError("a chunk lacks vectors or their numbers")
        node = known["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        copies, vectors = known["copies"].to_numpy()[order], full["data"].take(pa.array(order))
        row = [[v] for v in (node[order].tobytes(), copies.tobytes(), b"".join(vectors.to_pylist()))]
        first = [chunk[n].slice(0, 1).combine_chunks() for n in _CHUNK]
        yield pa.RecordBatch.from_arrays([*first, *(pa.array(v, pa.binary()) for v in row)], names)


def _share(limit: float, size: int, dims: int) -> float:
    """A block's share of the squared distance, and what single precision may add to one."""
    return limit * size / dims + SLACK + (size + 8) * 2.0**-22


def _in_range(a: np.ndarray, b: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within ``share`` of each other in a block. Rows of ``a`` are taken by their
    cell in a grid over the first axes, and meet the rows of ``b`` that the cell's range touches."""
    reach, axes = share**0.5, min(AXES, a.shape[1])
    cell = np.floor(a[:, :axes] / (CELL * reach))
    order = np.lexsort(cell.T)
    cuts = np.flatnonzero(np.any(cell[order[1:]] != cell[order[:-1]], axis=1)) + 1
    by_first = np.argsort(b[:, 0])
    first = b[by_first, 0]
    # One product gives the squared distance: -2ab + aa + bb.
    left = np.column_stack((-2 * a, (a * a).sum(1), np.ones_like(a[:, 0])))
    right = np.column_stack((b, np.ones_like(b[:, 0]), (b * b).sum(1)))
    for member in np.split(order, cuts):
        low, high = a[member, :axes].min(0) - reach, a[member, :axes].max(0) + reach
        lo, hi = np.searchsorted(first, low[0], "left"), np.searchsorted(first, high[0], "right")
        at = by_first[lo:hi]
        for k in range(1, axes):
            at = at[(b[at, k] >= low[k]) & (b[at, k] <= high[k])]
        if not len(at):
            continue
        there = right[at].T
        for k in range(0, len(member), ROWS):
            rows = member[k : k + ROWS]
            i, j = np.divmod(np.flatnonzero(left[rows] @ there <= share), len(at))
            yield rows[i], at[j]


def _near(own_a: np.ndarray, own_b: np.ndarray, maybe: np.ndarray, threshold: float) -> np.ndarray:
    """The places in ``maybe`` whose pair has the cosine. Where there are many, one product settles
    all but those too close to the threshold to trust its rounding."""
    at = np.flatnonzero(maybe)
    i, j = np.divmod(at, len(own_b))
    near = np.ones(len(at), dtype=bool)
    check = np.arange(len(at))
    if len(at) * 16 > maybe.size:
        over = (own_a @ own_b.T).ravel()[at] - threshold
        near = over > 0
        check = np.flatnonzero(np.abs(over) <= SLACK)
    for k in range(0, len(check), PAIRS):
        c = check[k : k + PAIRS]
        near[c] = (own_a[i[c]] * own_b[j[c]]).sum(1) >= threshold
    return at[near]


def _hang(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root`` (each row's smallest reachable row) after the links between ``x`` and ``y``."""
    x, y = root[x], root[y]
    while len(apart := np.flatnonzero(x != y)):
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := root[root], root):
            root = above
        x, y = root[x], root[y]
    return root


def _tile_links(threshold: float, blocks: int, kind: str):
    """Count links in tiles. Pairs in range in some block are checked; links of a vector are
    summed, and its smallest partner within the tile is its root."""
    limit = 2 - 2 * threshold

    def side(row: dict, name: str, dims: int) -> tuple[np.ndarray, ...]:
        node, copies = (np.frombuffer(row[f"{n}_{name}"], np.int64) for n in ("nodes", "copies"))
        flat = np.frombuffer(row[f"vectors_{name}"], kind).astype(np.float64)
        own = unit(flat.reshape(len(node), dims))
        spun = own @ kept(("rotation", dims), lambda: rotation(dims))
        return node, copies, own, spun.astype(np.float32)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
            dims, across = row["dims"], row["chunk_a"] != row["chunk_b"]
            left = side(row, "a", dims)
            right = side(row, "b", dims) if across else left
            n, own_a, spun_a, own_b, spun_b = len(left[0]), left[2], left[3], right[2], right[3]
            maybe = np.zeros((n, len(right[0])), dtype=bool)
            for lo, hi in block_bounds(dims, blocks):
                for i, j in _in_range(spun_a[:, lo:hi], spun_b[:, lo:hi], _share(limit, hi - lo, dims)):
                    maybe[i, j] = True
            node = np.concatenate((left[0], right[0])) if across else left[0]
            copies = np.concatenate((left[1], right[1])) if across else left[1]
            order = np.argsort(node, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            total, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
            for at in range(0, n, ROWS):
                found = _near(own_a[at : at + ROWS], own_b, maybe[at : at + ROWS], threshold)
                x, y = np.divmod(found, len(own_b))
                x, y = x + at, y + (n if across else 0)
                if not across:
                    x, y = x[x < y], y[x < y]
                np.add.at(total, x, copies[y])
                np.add.at(total, y, copies[x])
                root = _hang(root, rank[x], rank[y])
            linked = np.flatnonzero(total)
            columns = [node[linked], total[linked], node[order[root[rank[linked]]]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

    return links


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    blocks: int = BLOCKS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per vector.

    Vectors are compared when their labels are equal and not NULL (and their lengths are equal);
    a pair is linked when its cosine is ``threshold`` or more. Equal vectors of a label are
    folded into their smallest id before the join and counted by their number; they are known by
    their SHA-256, and only numbers travel from there on. Pairs are compared in tiles of bounded
    size and only sums and roots leave a tile, so neither a large cell nor a large group of copies
    meets in one task, and no pair is ever written. The vectors are written twice and shuffled
    once; tiles read them again, each pair of partitions in a task.

    NULL, empty or zero vectors, and vectors with NULL or non-finite components, link with
    nothing: 0 links, their own id, kept. So do rows with a NULL label or id. Rows that repeat an
    id, label and vector are one vector; rows that share an id but not the vector are vectors of
    their own. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).alias("vector"),
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable("vector")
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    kinds = dict(rows.dtypes)
    schema = f"vec_id long, label {kinds['label']}, usable boolean, print binary, dims int, data binary"
    marked = settle(rows.mapInArrow(_marked, schema))
    rows = settle(marked.drop("data").distinct())
    groups = settle(
        rows.where("usable")
        .groupBy("label", "dims", "print")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    side = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_BYTES) / (8 * F.col("dims")))))
    sizes = settle(
        groups.groupBy("label", "dims")
        .count()
        .select("label", "dims", F.ceil(F.col("count") / side).cast("int").alias("chunks"))
        .withColumn("lot", F.monotonically_increasing_id())
    )
    none, chunk = F.lit(None), F.pmod(F.xxhash64("print", F.lit(17)), F.col("chunks")).cast("int")
    full = marked.where("data IS NOT NULL").select(
        "label", "dims", "print", none.cast("long").alias("node"), none.cast("long").alias("copies"), "data"
    )
    known = groups.select("label", "dims", "print", "node", "copies", none.cast("binary").alias("data"))
    placed = [
        lookup_join(part, sizes, ["label", "dims"], "inner").select(
            "lot", "dims", chunk.alias("chunk"), "print", "node", "copies", "data"
        )
        for part in (full, known)
    ]
    packed = settle(
        placed[0]
        .unionByName(placed[1])
        .repartition(*_CHUNK)
        .sortWithinPartitions(*_CHUNK, "print")
        .mapInArrow(_packed, "lot long, dims int, chunk int, nodes binary, copies binary, vectors binary")
    )
    a, b = (packed.toDF(*[f"{c}_{name}" for c in packed.columns]) for name in "ab")
    # Without the hint the chunks would be sorted by lot, all those of a lot in one task.
    tiles = a.join(
        b.hint("shuffle_replicate_nl"),
        (F.col("lot_a") == F.col("lot_b")) & (F.col("chunk_a") <= F.col("chunk_b")),
    ).select(F.col("dims_a").alias("dims"), *[f"{c}_{x}" for x in "ab" for c in ("chunk", "nodes", "copies", "vectors")])
    kind = "<f4" if kinds["vector"] == "array<float>" else "<f8"
    counted = settle(tiles.mapInArrow(_tile_links(threshold, blocks, kind), "node long, links long, root long"))
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(counted, "node", "root")
    rooted = (
        groups.join(links, "node", "left")
        .join(roots, "node", "left")
        .select(
            "label",
            "print",
            "rep",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    first = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = lookup_join(rooted.drop("rep"), first, ["root"], "inner").drop("root")
    found = lookup_join(rows.where("usable"), classes, ["label", "print"], "inner")
    alone = rows.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        found.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
