"""Token counts at every prefix of a text, by dynamic programming over a BPE vocabulary.

If a text's encoding ends in token t, what stands before t is the encoding of the text without
t, and a sequence of tokens is an encoding exactly when each neighbouring pair is one. So the
last token at position i is the only vocabulary entry t that ends there and may follow the last
token at i - len(t), and count[i] = count[i - len(t)] + 1. One pass gives the exact count of
every prefix; how many tokens a cut leaves, or where a budget ends, is then a lookup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import beside, kept, utf8

LIMIT = 4096
KEPT_WORDS = 1 << 20  # words whose counts a worker remembers
WIDE = 40  # longer words are worked through one by one
SPACE = "▁"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_PIECE_BITS = 20  # leading hash bits by which a piece is looked up
_PAIR_BITS = 21  # pairs of tokens whose answer is kept
MARKS = ".,"
_LONE = 1 << 20  # last "token" of a prefix that ends in a character outside the vocabulary


class PrefixCounts:
    """Prefix counts for a ``sentencepiece`` BPE model with byte fallback.

    No piece holds a space mark after another character, so an encoding is that of its words,
    each with the mark before it; words are remembered up to a bound. A character that is in no
    piece is encoded as its UTF-8 bytes and joins with nothing.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        model.normalizer_spec.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        pieces = [p.piece for p in model.pieces]
        normal = [i for i, p in enumerate(model.pieces) if p.type == 1]
        whole = self.bare.encode([pieces[i] for i in normal], num_threads=1)
        # Runs of marks alone are settled apart: all of them have the same merge rank.
        self.ids = {
            pieces[i]: i
            for i, ids in zip(normal, whole)
            if ids == [i] and (pieces[i] == SPACE or pieces[i].strip(SPACE))
        }
        self.run = max(len(pieces[i]) for i in normal if not pieces[i].strip(SPACE))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds a space mark inside: words are not independent")
        self.pieces = pieces
        self.longest = max(map(len, self.ids))
        # The order in which lengths are tried does not change what is found: common ones first.
        self.tried = sorted(range(1, self.longest + 1), key=lambda n: (abs(n - 3), n))
        self.size = np.int64(len(pieces))
        self.hashes, self.tokens, self.first, self.most = _lookup(self.ids)
        self.powers = np.cumprod(
            np.array([1] + [_BASE] * self.longest, dtype=np.uint64), dtype=np.uint64
        )
        self.pairs = np.full(1 << _PAIR_BITS, -1, dtype=np.int64)
        self.may = np.zeros(1 << _PAIR_BITS, dtype=bool)
        # Characters after which a mark never continues a piece: the text may be cut there.
        inside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.glued = {pair for pair in inside if pair[1] in MARKS}
        # Space marks in a row: whole runs, then what is left.
        runs = ["" if not n else SPACE * n for n in range(self.run)]
        self.rest = [len(ids) for ids in self.bare.encode(runs, num_threads=1)]
        self.known: dict[bytes, int] = {}

    # ---- which token may follow which -------------------------------------------------

    def _may_follow(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours is its own encoding. Answers are kept in a table of
        fixed size, where a later pair may take an earlier one's place."""
        lone = before >= _LONE
        keys = before * self.size + token
        slots = (keys.astype(np.uint64) * _MIX >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        new = (self.pairs[slots] != keys) & ~lone
        out = lone | self.may[slots]
        if new.any():
            asked, back = np.unique(keys[new], return_inverse=True)
            a, b = (asked // self.size).tolist(), (asked % self.size).tolist()
            joined = [self.pieces[x] + self.pieces[y] for x, y in zip(a, b)]
            got = self.bare.encode(joined, num_threads=1)
            may = np.array([g == [x, y] for g, x, y in zip(got, a, b)])
            out[new] = may[back]
            at = (asked.astype(np.uint64) * _MIX >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
            _, kept = np.unique(at, return_index=True)
            self.pairs[at[kept]], self.may[at[kept]] = asked[kept], may[kept]
        return out

    def _piece(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rolled hashes: which are pieces, and their tokens."""
        at = self.first[(key >> np.uint64(64 - _PIECE_BITS)).astype(np.int64)]
        hit = self.hashes[at] == key
        for _ in range(self.most - 1):
            at = np.where(hit, at, at + 1)
            hit = self.hashes[at] == key
        return hit, self.tokens[at[hit]]

    # ---- the dynamic programme --------------------------------------------------------

    def table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and last tokens at every prefix of each word with its mark, one row per word
        (position 1 is the mark alone). Rows are padded with the values at the word's end."""
        marked = [SPACE + w for w in words]
        sizes = np.array([len(w) for w in marked])
        width = int(sizes.max())
        flat = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
        row = np.repeat(np.arange(len(words)), sizes)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chars = np.zeros((len(words), width), dtype=np.uint32)
        chars[row, col] = flat
        rolled = np.zeros((len(words), width + 1), dtype=np.uint64)
        for i in range(width):
            rolled[:, i + 1] = rolled[:, i] * _BASE + (chars[:, i].astype(np.uint64) * _MIX ^ _MIX)
        counts = np.zeros((len(words), width + 1), dtype=np.int64)
        last = np.full((len(words), width + 1), -1, dtype=np.int64)
        for i in range(1, width + 1):
            open_rows = np.flatnonzero(sizes >= i)
            for n in self.tried:
                if not len(open_rows):
                    break
                if n > i:
                    continue
                key = rolled[open_rows, i] - rolled[open_rows, i - n] * self.powers[n]
                hit, token = self._piece(key)
                rows = open_rows[hit]
                if i > n:
                    ok = self._may_follow(last[rows, i - n], token)
                    rows, token = rows[ok], token[ok]
                counts[rows, i], last[rows, i] = counts[rows, i - n] + 1, token
                open_rows = open_rows[last[open_rows, i] == -1]
            if len(open_rows):  # no piece ends here: bytes
                code = chars[open_rows, i - 1]
                size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
                counts[open_rows, i] = counts[open_rows, i - 1] + size
                last[open_rows, i] = _LONE
            done = sizes < i
            counts[done, i], last[done, i] = counts[done, i - 1], last[done, i - 1]
        return counts, last

    def _tables(self, words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Positions in ``words`` and their rows of counts, words of like length together."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        start = 0
        while start < len(order):
            wide = len(words[order[start]]) > WIDE
            end = start + 1 if wide else min(start + 8192, len(order))
            while not wide and end > start + 1 and len(words[order[end - 1]]) > WIDE:
                end -= 1
            part = order[start:end]
            yield part, self.table([words[i] for i in part])[0]
            start = end

    def _totals(self, words: list[str]) -> list[int]:
        """Tokens of each word with its mark."""
        out = np.zeros(len(words), dtype=np.int64)
        for part, counts in self._tables(words):
            out[part] = counts[:, -1]
        return out.tolist()

    # ---- whole texts ------------------------------------------------------------------

    def learn(self, texts: list[bytes]) -> None:
        """Work out the words that are not known yet. Full stops and commas at a word's end are
        counted apart where no piece joins them to what stands before."""
        new = {w for t in texts for w in t.split(b" ") if w not in self.known}
        new.discard(b"")
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = {w for t in texts for w in t.split(b" ")} - {b""}
        parts, cores = {}, set()
        for w in new:
            core, mark = w[:-1], w[-1:].decode("latin-1")
            apart = mark in MARKS and core and core.decode()[-1] + mark not in self.glued
            parts[w] = core if apart else None
            if not apart or core not in self.known:
                cores.add(core if apart else w)
        if cores:
            words = sorted(cores)
            self.known.update(zip(words, self._totals([w.decode() for w in words])))
        for w, core in parts.items():
            if core is not None:
                self.known[w] = self.known[core] + 1

    def count(self, text: bytes) -> int:
        """Tokens of a text whose words have been learnt."""
        if not text:
            return 0
        words = text.split(b" ")
        if b"" not in words:
            return sum(map(self.known.__getitem__, words))
        return int(self._runs(words)[-1])

    def _runs(self, words: list[bytes]) -> np.ndarray:
        """Tokens up to the end of each word, where some are empty: runs of space marks."""
        ends, total, run = [], 0, 0
        for word in words:
            run += 1
            if word:
                total += self._spaces(run - 1, word) + self.known[word]
                run = 0
            ends.append(total + self._run(run))
        return np.array(ends)

    def _run(self, run: int) -> int:
        """Tokens of ``run`` space marks in a row."""
        return run // self.run + self.rest[run % self.run]

    def _spaces(self, run: int, word: bytes) -> int:
        """Tokens that ``run`` marks add before a word with its own mark. The word's mark joins
        the run only if it stays alone in front of the word."""
        if not run:
            return 0
        first = self.bare.encode(SPACE + word.decode(), out_type=str)[0]
        return self._run(run) if first != SPACE else self._run(run + 1) - 1

    def prefixes(self, text: bytes) -> np.ndarray:
        """Exact token count of every prefix, 0 to all characters."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        words = _plain(text).split(b" ")
        self.learn([b" ".join(words)])
        own: dict[bytes, np.ndarray] = {}
        different = [w for w in dict.fromkeys(words) if w]
        shown = [w.decode() for w in different]
        for part, counts in self._tables(shown):
            own.update((different[i], row[2 : 2 + len(shown[i])]) for i, row in zip(part, counts))
        ends = self._runs(words)
        out, before, run = [np.zeros(1, dtype=np.int64)], 0, 0
        for k, word in enumerate(words):
            run += 1
            if k:  # the space itself ends the prefix
                out.append(np.array([before + self._run(run)]))
            if word:
                out.append(before + own[word] + self._before(run - 1, word))
                before, run = int(ends[k]), 0
        return np.concatenate(out)

    def _before(self, run: int, word: bytes) -> np.ndarray | int:
        """What a run of marks adds to each prefix of the word after it."""
        if not run:
            return 0
        shown = word.decode()
        # Whether the mark joins the first token is settled within the longest piece.
        starts = [shown[:i].encode() for i in range(1, min(len(shown), 2 * self.longest) + 1)]
        added = [self._spaces(run, w) for w in starts]
        return np.array(added + [self._spaces(run, word)] * (len(shown) - len(added)))

    def cut(self, text: bytes, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.

        Counts at the ends of words never fall, so it ends in, or in the spaces before, the first
        word whose end is beyond the budget; only there are single characters looked at. (A
        further character may join tokens, so the last prefix within the budget is meant.) A
        negative budget counts as none.
        """
        budget = max(budget, 0)
        words = _plain(text).split(b" ")
        ends = self._runs(words)
        if ends[-1] <= budget:
            return len(text.decode())
        k = next((i for i, w in enumerate(words) if w and ends[i] > budget), len(words) - 1)
        start = k
        while start and not words[start - 1]:
            start -= 1  # a run of spaces belongs to the word after it
        done = len(b" ".join(words[:start]).decode())
        before = int(ends[start - 1]) if start else 0
        tail = np.concatenate([[before], self._tail(words[start : k + 1], before, start > 0)])
        return done + int(np.flatnonzero(tail <= budget)[-1])

    def _tail(self, words: list[bytes], before: int, spaced: bool) -> np.ndarray:
        """Counts at the characters of empty words and one word after them."""
        out, run = [], 0
        for k, word in enumerate(words):
            run += 1
            if k or spaced:
                out.append(np.array([before + self._run(run)]))
            if word:
                counts = self.table([word.decode()])[0][0][2:]
                out.append(before + counts + self._before(run - 1, word))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + (ord(c) * int(_MIX) ^ int(_MIX))) & (1 << 64) - 1
    return h


def _lookup(ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted hashes of the pieces (with room behind), their tokens, where the hashes of each
    leading bit pattern begin, and how many share one at most."""
    hashes = np.array([_hash(p) for p in ids], dtype=np.uint64)
    order = np.argsort(hashes)
    hashes, tokens = hashes[order], np.array(list(ids.values()), dtype=np.int64)[order]
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two pieces share a hash")
    lead = (hashes >> np.uint64(64 - _PIECE_BITS)).astype(np.int64)
    first = np.searchsorted(lead, np.arange(1 << _PIECE_BITS))
    most = int(np.bincount(lead).max())
    pad = np.zeros(most + 1, dtype=np.int64)
    return np.concatenate((hashes, pad.view(np.uint64))), np.concatenate((tokens, pad)), first, most


def counter(path: str) -> PrefixCounts:
    """One counter per worker process."""
    return kept(("prefixes", path), lambda: PrefixCounts(path))


def _plain(text: bytes | None) -> bytes:
    return (text or b"").replace(SPACE.encode(), b" ")


def token_totals(model: str, limit: int) -> Column:
    """``n_tokens`` of a text column and ``cut``: the characters that ``limit`` tokens hold (the
    whole text where it is within the limit)."""

    @F.pandas_udf("n_tokens long, cut long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = counter(model)
        for series in batches:
            texts = [_plain(t) for t in series]
            counts.learn(texts)
            out = []
            for t in texts:
                n = counts.count(t)
                out.append((n, counts.cut(t, limit) if n > limit else len(t.decode())))
            yield pd.DataFrame(out, columns=["n_tokens", "cut"])

    return count(utf8("text"))


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """``row`` (the document's columns), ``n_bytes``, ``n_tokens``, ``over_limit`` and
    ``cut_chars``, one row per document.

    NULL and empty texts have no tokens. Texts of any length and spacing are counted whole;
    repeated rows are counted alike and all returned; an empty table gives an empty result.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")).cast("long"), F.lit(0))
    counted = beside(docs, n_bytes=size, found=token_totals(model, limit))
    return counted.select(
        "row",
        "n_bytes",
        F.col("found.n_tokens").alias("n_tokens"),
        (F.col("found.n_tokens") > limit).alias("over_limit"),
        F.col("found.cut").alias("cut_chars"),
    )


def prefix_index(docs: DataFrame, model: str) -> DataFrame:
    """``row`` and ``steps``: how the token count changes with each further character, a signed
    16-bit number per character. The running sum is the count at every prefix."""

    @F.pandas_udf("binary")
    def index(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counter(model)
        for texts in batches:
            yield pd.Series([_steps(counts.prefixes(t or b"")) for t in texts], dtype=object)

    return beside(docs, steps=index(utf8("text")))


def _steps(counts: np.ndarray) -> bytes:
    steps = np.diff(counts)
    if len(steps) and np.abs(steps).max() >= 1 << 15:
        raise ValueError("a token count changes by more than 16 bits hold")
    return steps.astype("<i2").tobytes()


def prefix_answers(indexed: DataFrame, chars: Column, budget: Column) -> DataFrame:
    """From an index, without any tokenizer: ``tokens_at`` (tokens of the first ``chars``
    characters) and ``chars_within`` (characters of the longest prefix within ``budget``). NULL
    asked gives NULL; fewer than no characters or tokens count as none."""

    @F.pandas_udf("tokens_at long, chars_within long")
    def answer(steps: pd.Series, chars: pd.Series, budget: pd.Series) -> pd.DataFrame:
        out = []
        for raw, n, most in zip(steps, chars, budget):
            counts = np.concatenate(([0], np.cumsum(np.frombuffer(raw, "<i2"), dtype=np.int64)))
            at = None if pd.isna(n) else counts[int(min(max(n, 0), len(counts) - 1))]
            out.append((at, None if pd.isna(most) else np.flatnonzero(counts <= max(most, 0))[-1]))
        return pd.DataFrame(out, columns=["tokens_at", "chars_within"], dtype="Int64")

    return indexed.select("row", answer("steps", chars, budget).alias("found")).select("row", "found.*")
