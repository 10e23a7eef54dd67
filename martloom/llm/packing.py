"""Packing of token sequences by bin completion over the lengths' counts.

The lengths are at most the capacity, so how often each occurs is a table of bounded size,
however many documents there are. Fillings are chosen on that table, each with the number of
sequences it is used for; the pieces then look up their place by their rank among the pieces of
the same length. No task and no driver ever holds the pieces themselves.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import ASCII_LOWER, kept, utf8
from martloom.session import settle

CAPACITY = 2048
END_ID = 0
KEPT_WORDS = 1 << 20  # words whose ids a worker remembers
JOINED = 2000  # unknown words tokenized by one call
NODES = 2_000  # steps of one search for fillings
FILLINGS = 64  # fillings considered around one document
SEARCHES = 8  # greedy completions before the depth-first search
STEPS = 3_000  # fillings searched for in the depth-first search

# A full stop or comma between a letter or digit and white space never shares a token with them.
# (Letters here: ASCII and U+00C0 to U+00FF.)
_MARK = re.compile(
    rb"(?:(?<=[a-z0-9])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([.,])(?=[\x20\x09-\x0D]|\Z)"
)
# Kinds of bytes: letter or digit, blank, mark, lead and rest of a letter from U+00C0 to U+00FF.
_KIND = bytes(
    ord(
        "a" if 97 <= b <= 122 or 48 <= b <= 57 else " " if b == 32 or 9 <= b <= 13
        else "," if b in b".," else "c" if b == 0xC3
        else "b" if 0x80 <= b <= 0xBF and b not in (0x97, 0xB7) else "#"
    )
    for b in range(256)
)
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
# ASCII and U+00C0 to U+00FF: their normal form is themselves, whatever stands beside them.
_PLAIN = bytes([*range(0xC0), 0xC3])


class WordTokens:
    """Ids of whole texts by a ``tokenizers`` file that drops white space and marks word ends.

    No token spans white space, so a text's ids are those of its white-space-free stretches,
    which are remembered up to a bound. In stretches of ASCII and U+00C0 to U+00FF, ASCII letters
    are lower-cased beforehand, which the tokenizer does anyway; all others go to it as they
    stand. So do whole texts that hold a special token's text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # The words met lately, and those of the time before: full, the first become the second.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def plain(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of lower-case words made of letters: ASCII ones by the merges alone, the others
        several to a call, cut apart at the word ends."""
        # Lower-case ASCII letters are all the steps before the merges leave as they are.
        merge = self.tokenizer.model.tokenize
        plain = [w for w in words if w.isalpha()]
        out = {
            w: array("I", [t.id for t in merge(w.decode())]).tobytes() for w in plain
        }
        words = [w for w in words if not w.isalpha()]
        for i in range(0, len(words), JOINED):
            part = words[i : i + JOINED]
            text = b" ".join(part).decode()
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                cut = np.concatenate(([0], ends)).tolist()
                out.update((w, ids[a:b].tobytes()) for w, a, b in zip(part, cut, cut[1:]))
            else:
                out.update((w, self.plain(w)) for w in part)
        return out

    def _learn(self, stretches: set[bytes]) -> None:
        """Remember the ids of stretches that are not known yet. ASCII marks behind a letter, up
        to the end, are a token's work of their own."""
        words, tails, other, parts = set(), set(), [], []
        for s in stretches:
            core = s.rstrip(_MARKS)
            if not core or len(s) > 64 or s.translate(None, _PLAIN) or not (core.isalpha() or core.decode().isalpha()):
                other.append(s)
            elif len(core) < len(s):
                tail = s[len(core) :]
                parts.append((s, core, tail))
                if core not in self.known:
                    words.add(core)
                if tail not in self.known:
                    tails.add(tail)
            else:
                words.add(s)
        other.extend(tails)
        self.known.update(self._words(list(words)))
        found = self.tokenizer.encode_batch_fast([s.decode() for s in other], add_special_tokens=False)
        self.known.update((s, np.array(e.ids, dtype="<u4").tobytes()) for s, e in zip(other, found))
        self.known.update((s, self.known[core] + self.known[tail]) for s, core, tail in parts)

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; NULL counts as empty."""
        if len(self.known) > KEPT_WORDS // 2:
            self.older, self.known = self.known, {}
        out: list[bytes | None] = []
        open_rows: list[tuple[int, list[bytes], list[bytes | None]]] = []
        get, older = self.known.get, self.older.get
        for text in texts:
            low = (text or b"").translate(ASCII_LOWER)
            if b"<|" in low and any(s in low for s in _SPECIAL):
                out.append(self.plain(text))
                continue
            if low.translate(None, _PLAIN):
                parts = [p if p.translate(None, _PLAIN) else p.translate(ASCII_LOWER) for p in text.split()]
            else:
                parts = marks_apart(low).split()
            ids = list(map(get, parts))
            if None in ids:
                for i in [i for i, own in enumerate(ids) if own is None]:
                    if (own := older(parts[i])) is not None:
                        ids[i] = self.known[parts[i]] = own
            if None in ids:
                open_rows.append((len(out), parts, ids))
                out.append(None)
            else:
                out.append(b"".join(ids))
        new = {p for _, parts, ids in open_rows for p, i in zip(parts, ids) if i is None}
        if new:
            self._learn(new)
            for row, parts, ids in open_rows:
                out[row] = b"".join([get(p) if i is None else i for p, i in zip(parts, ids)])
            for s in [s for s in new if len(s) > 64]:
                del self.known[s]
        return out


def marks_apart(low: bytes) -> bytes:
    """A text with a blank before each full stop or comma that stands between a letter or digit
    and white space: they share no token. Plain replacement does where no other such mark stands
    before white space, which is checked on the bytes' classes."""
    low += b" "
    kinds = low.translate(_KIND)
    odd = b"#, " in kinds or b",, " in kinds or b" , " in kinds
    if odd or kinds.count(b"b, ") != kinds.count(b"cb, "):
        return _MARK.sub(rb" \1", low)
    return low.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n")


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32`` (and
    ``ids`` if wanted), with ``part`` and ``rank``: the piece's number among the pieces of its
    length in its input partition. Every document ends with one ``END_ID``, so empty and NULL
    texts give one piece of length 1."""
    id_type = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        part = TaskContext.get().partitionId()
        ranks: Counter[int] = Counter()
        for batch in batches:
            row, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for i, found in enumerate(tokens.encode(batch.column(1).to_pylist())):
                data = found + end
                for p, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    size = len(own) // 4
                    row.append(i)
                    piece.append(p)
                    start.append(p * capacity)
                    length.append(size)
                    crc.append(zlib.crc32(own))
                    rank.append(ranks[size])
                    ranks[size] += 1
                    ids.append(own if with_ids else None)
            columns = [
                pc.take(batch.column(0), pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array([part] * len(row), pa.int32()),
                pa.array(rank, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(cut, T.StructType(fields))


def _tokens(path: str) -> WordTokens:
    """One tokenizer per worker process."""
    return kept(("words", path), lambda: WordTokens(path))


# A filling: how often each length occurs in it, longest first.
Filling = tuple[tuple[int, int], ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by the ids in all, and, for each limit k, by the pieces
    too long to share with one above ``capacity - k`` plus what must go beside them."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in {0, *(n for n in counts if 2 * n <= capacity)}:
        alone = sum(c for n, c in counts.items() if n > capacity - k)
        halves = [(n, c) for n, c in counts.items() if capacity - k >= n > capacity / 2]
        small = sum(n * c for n, c in counts.items() if k <= n <= capacity / 2)
        free = sum((capacity - n) * c for n, c in halves)
        best = max(best, alone + sum(c for _, c in halves) + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on the counts: equal, equally filled sequences are kept as one group,
    so the work depends on the number of different lengths, not of pieces."""
    groups: dict[int, list[tuple[Counter, int]]] = {}
    room: list[int] = []  # sorted residuals that have a group

    def put(residual: int, filling: Counter, n: int) -> None:
        if residual not in groups:
            groups[residual] = []
            room.insert(bisect_right(room, residual), residual)
        groups[residual].append((filling, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_right(room, size - 1)
            if at == len(room):
                residual, filling, n = capacity, Counter(), -(-left // (capacity // size))
            else:
                residual = room[at]
                filling, n = groups[residual].pop()
                if not groups[residual]:
                    del groups[residual], room[at]
            each = min(residual // size, left)
            full = min(n, left // each)
            put(residual - each * size, filling + Counter({size: each}), full)
            left -= full * each
            rest = n - full
            if rest and left and left < each:
                put(residual - left * size, filling + Counter({size: left}), 1)
                left, rest = 0, rest - 1
            if rest and filling:
                put(residual, filling, rest)
    return [
        (tuple(sorted(filling.items(), reverse=True)), n)
        for residual in groups
        for filling, n in groups[residual]
    ]


def fillings(
    sizes: list[int], counts: dict[int, int], room: int, every: bool = False
) -> list[tuple[Filling, int]]:
    """Undominated ways to fill ``room`` around the longest piece, least waste first.

    A filling is dominated when a left-out piece still fits into its waste, or could take the
    place of a shorter one without overflow; those are not listed. Longest pieces come first.
    The search ends with a filling without waste (unless ``every`` one is wanted), or after
    ``NODES`` steps or ``FILLINGS`` fillings.
    """
    found: list[tuple[int, Filling]] = []
    left = [NODES]

    def improvable(free: int, chosen: tuple) -> bool:
        """A longer piece that is left out could replace a chosen one."""
        used = dict(chosen)
        for size, _ in chosen:
            at = bisect_left(sizes, -(size + free), key=lambda n: -n)
            while at < len(sizes) and sizes[at] > size:
                if counts[sizes[at]] > used.get(sizes[at], 0):
                    return True
                at += 1
        return False

    def take(at: int, free: int, chosen: tuple) -> None:
        left[0] -= 1
        while at < len(sizes) and sizes[at] > free:
            at += 1
        if at == len(sizes):
            if not free or not improvable(free, chosen):
                found.append((free, chosen))
            return
        size = sizes[at]
        for k in range(min(counts[size], free // size), -1, -1):
            if left[0] < 0 or len(found) >= FILLINGS or (found and not found[-1][0] and not every):
                return
            take(at + 1, free - k * size, (*chosen, (size, k)) if k else chosen)

    take(0, room, ())
    if not found:
        at, free, chosen = 0, room, ()
        for size in sizes:
            k = min(counts[size], free // size)
            if k:
                chosen, free = (*chosen, (size, k)), free - k * size
        found.append((free, chosen))
    return sorted(((f, w) for w, f in found), key=lambda x: x[1])


def complete_bins(
    counts: dict[int, int], capacity: int = CAPACITY, searches: int = SEARCHES, steps: int = STEPS
) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each, covering ``counts`` exactly.

    Best-fit decreasing gives the incumbent. Bin completion then fills sequences around the
    longest piece left, each filling repeated as long as its pieces last, the way of least waste
    first; when the waste so far exceeds what the incumbent allows, the search goes back to the
    step that wasted most and takes its next filling, ``searches`` times. Then it goes depth
    first through all fillings and their repeats, pruned by the waste, for ``steps`` searches for
    fillings. It stops at the lower bound; with few pieces it ends with the fewest sequences
    proven, with many it may end above them.
    """
    counts = {n: c for n, c in counts.items() if c}
    incumbent = best_fit(counts, capacity)
    used = sum(n for _, n in incumbent)
    bound = lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    other: dict[int, int] = {}  # step -> which of its fillings is taken
    for _ in range(searches):
        if used <= bound:
            break
        left, plan, waste, worst = dict(counts), [], 0, (0, -1)
        allowed = (used - 1) * capacity - total
        sizes = sorted(left, reverse=True)
        while sizes:
            first = sizes[0]
            left[first] -= 1
            rest = [n for n in sizes if left[n] and n <= capacity - first]
            ways = fillings(rest, left, capacity - first)
            left[first] += 1
            chosen, free = ways[min(other.get(len(plan), 0), len(ways) - 1)]
            filling = Counter(dict(chosen)) + Counter({first: 1})
            times = min(left[n] // k for n, k in filling.items())
            if len(ways) > 1 + other.get(len(plan), 0):
                worst = max(worst, (free * times, len(plan)))
            plan.append((tuple(sorted(filling.items(), reverse=True)), times))
            waste += free * times
            for n, k in filling.items():
                left[n] -= k * times
            sizes = [n for n in sizes if left[n]]
            if waste > allowed:
                break
        else:
            n = sum(times for _, times in plan)
            if n < used:
                incumbent, used = plan, n
        if worst[1] < 0:
            break
        other = {step: way for step, way in other.items() if step < worst[1]} | {
            worst[1]: other.get(worst[1], 0) + 1
        }
    return _depth_first(counts, capacity, incumbent, bound, steps)


def _depth_first(
    counts: dict[int, int], capacity: int, incumbent: list[tuple[Filling, int]], bound: int, steps: int
) -> list[tuple[Filling, int]]:
    """A plan with fewer sequences than ``incumbent``, if ``steps`` lead to one."""
    used = sum(n for _, n in incumbent)
    total = sum(n * c for n, c in counts.items())
    left, plan, waste = dict(counts), [], 0

    def choices() -> list[tuple[Filling, int, int]]:
        """Fillings around the longest piece left, with repeats and waste; the best one last."""
        sizes = [n for n in sorted(left, reverse=True) if left[n]]
        first = sizes[0]
        left[first] -= 1
        rest = [n for n in sizes if left[n] and n <= capacity - first]
        ways = fillings(rest, left, capacity - first, every=True)
        left[first] += 1
        out = []
        for chosen, free in sorted(ways, key=lambda w: w[1]):
            filling = Counter(dict(chosen)) + Counter({first: 1})
            most = min(left[n] // k for n, k in filling.items())
            for times in dict.fromkeys((most, 1)):
                out.append((tuple(sorted(filling.items(), reverse=True)), times, free * times))
        return out[::-1]

    if used <= bound or steps < 1:
        return incumbent
    open_choices = [choices()]
    while open_choices:
        if len(plan) == len(open_choices):  # the choice taken here has been followed: undo it
            filling, times, lost = plan.pop()
            waste -= lost
            for n, k in filling:
                left[n] += k * times
        if not open_choices[-1]:
            open_choices.pop()
            continue
        filling, times, lost = open_choices[-1].pop()
        plan.append((filling, times, lost))
        waste += lost
        for n, k in filling:
            left[n] -= k * times
        if waste > (used - 1) * capacity - total:
            continue
        if not any(left.values()):
            incumbent = [(filling, times) for filling, times, _ in plan]
            used = sum(n for _, n in incumbent)
            if used <= bound:
                break
            continue
        steps -= 1
        if steps < 1:
            break
        open_choices.append(choices())
    return incumbent


def _places(plan: list[tuple[Filling, int]]) -> pd.DataFrame:
    """For each length, which ranks go to which sequences and offsets. A row: the pieces of
    ``length`` from rank ``base`` on, ``each`` to a sequence, from ``sequence`` on."""
    rows, taken, sequence = [], Counter(), 0
    for filling, times in plan:
        offset = 0
        for size, each in filling:
            rows.append((size, taken[size], each, sequence, offset))
            taken[size] += each * times
            offset += each * size
        sequence += times
    return pd.DataFrame(rows, columns=["length", "base", "each", "sequence", "offset"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and
    ``ids`` if wanted).

    Every piece is placed once; a sequence's pieces lie without gaps from offset 0 and hold at
    most ``capacity`` ids. NULL and empty texts hold the end id only; a NULL or repeated doc_id
    is packed like any other row; an empty table gives no rows; other columns are not read.
    """
    pieces = settle(cut_pieces(docs, tokenizer, capacity, with_ids))
    tally = settle(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(complete_bins(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = tally.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    by_length = {n: own.sort_values("base") for n, own in places.groupby("length")}
    tables = {n: own.drop(columns="length").to_numpy(dtype=np.int64) for n, own in by_length.items()}
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("sequence_id long, offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tables = shared.value
        for lengths, ranks in batches:
            length, rank = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
            out = np.zeros((len(length), 2), dtype=np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                own = tables[int(n)]
                run = own[np.searchsorted(own[:, 0], rank[at], side="right") - 1]
                among = rank[at] - run[:, 0]
                out[at, 0] = run[:, 2] + among // run[:, 1]
                out[at, 1] = run[:, 3] + among % run[:, 1] * n
            yield pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = pieces.join(starts, ["length", "part"]).withColumn(
        "place", place(F.col("length"), F.col("rank") + F.col("before"))
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return placed.select(*columns, "place.*", *(["ids"] if with_ids else []))
