"""Token counts by prefix dynamic programming, and exact ids for packing.

A byte-level BPE text falls into *units*: a run of white space with the chunk of
letters, digits or other characters after it. A unit's tokens do not depend on
what stands around it, so the token count of any prefix is the count of the
units before it plus the count of the begun unit. Within a unit, the last token
of each prefix is the only vocabulary entry that ends there and may follow the
last token of the shorter prefix; one pass over the bytes fills the table.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "byte_bpe_50k"
LIMIT = 512
#: Units longer than this are counted but not remembered.
LONG_UNIT = 64
#: Remembered units per Python worker; the memory is emptied when it is full.
REMEMBERED = 600_000
#: The state after this many bytes of a piece is remembered apart.
HEAD = 5

UNIT = (
    r"(?:[\p{White_Space}]*[^\P{White_Space} ])?'(?:s|t|re|ve|m|ll|d)"
    r"|\p{White_Space}*(?:\p{L}+|\p{N}+|[^\p{White_Space}\p{L}\p{N}]+)"
    r"|\p{White_Space}+"
)
PIECE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


#: Characters on which all Unicode versions agree; others are asked about once.
SETTLED = r"[^\x00-\u0377\u2000-\u2064\u20A0-\u20BF\u2190-\u23FF\u3040-\u3096\u30A0-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3\U0001F300-\U0001F64F]"
#: A letter, a digit, another character and a white space that stand in for the rest.
STAND_INS = ("a", "1", "!", "\u2003")


class Splitter:
    """Cuts texts into units and pieces as the tokenizers library would, whatever
    Unicode version this Python's tables have: a character outside the settled
    ranges is looked up with the library's own pre-tokenizer."""

    def __init__(self, path: str):
        import regex

        self.path = path
        self.units_of = regex.compile(UNIT).findall
        self.pieces_of = regex.compile(PIECE).findall
        self.unsettled = regex.compile(SETTLED).findall
        self.kinds: dict[int, str] = {}
        self._pre = None

    def _kind(self, c: str) -> str:
        if self._pre is None:
            from tokenizers import Tokenizer

            self._pre = Tokenizer.from_file(self.path).pre_tokenizer
        for probe in STAND_INS[:3]:
            if len(self._pre.pre_tokenize_str(probe + c)) == 1:
                return probe
        return STAND_INS[3]

    def _cut(self, findall, text: str) -> list[str]:
        if text.isascii() or not (odd := self.unsettled(text)):
            return findall(text)
        for c in set(odd):
            if ord(c) not in self.kinds:
                self.kinds[ord(c)] = self._kind(c)
        out, at = [], 0
        for x in findall(text.translate(self.kinds)):
            out.append(text[at : at + len(x)])
            at += len(x)
        return out

    def units(self, text: str) -> list[str]:
        return self._cut(self.units_of, text)

    def pieces(self, text: str) -> list[str]:
        return self._cut(self.pieces_of, text)


class PrefixCounter:
    """Exact token counts of every prefix of a text.

    `deltas(text)` gives, for each character, by how much the count changes when
    the prefix grows by it; their running sum is the table. The empty text has an
    empty table and no tokens.
    """

    def __init__(self, path: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{path}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._pair = core._encode_single_piece if hasattr(core, "_encode_single_piece") else core._core_bpe.encode_single_piece
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.split = Splitter(public_tokenizers.path(f"{path}.json"))
        self._valid: dict[bytes, dict[bytes, bool]] = {}
        self._pairs = 0
        self._heads: dict[bytes, tuple[list[int], list[bytes]]] = {}
        self._units: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def may_follow(self, left: bytes, right: bytes) -> bool:
        """Whether the text left + right is encoded as exactly these two tokens."""
        after = self._valid.get(left)
        if after is None:
            after = self._valid[left] = {}
        got = after.get(right)
        if got is None:
            if self._pairs >= REMEMBERED:
                self._valid.clear()
                self._pairs = 0
                after = self._valid[left] = {}
            self._pairs += 1
            got = after[right] = self._pair(left + right) == [self.ranks[left], self.ranks[right]]
        return got

    def piece_counts(self, b: bytes) -> list[int]:
        """Counts of the prefixes of one piece, by bytes; counts[0] is 0.

        Exactly one vocabulary entry is the last token of a prefix, so the order in
        which entries are tried is free: first the one before grown by a byte, then a
        new one, then the rest."""
        head = b[:HEAD]
        known = self._heads.get(head)
        if known is None:
            if len(self._heads) >= REMEMBERED // 4:
                self._heads.clear()
            known = self._heads[head] = self._extend(head, [0], [b""])
        if len(b) <= HEAD:
            return known[0]
        return self._extend(b, known[0][:], known[1][:])[0]

    def _extend(self, b: bytes, counts: list[int], last: list[bytes]) -> tuple[list[int], list[bytes]]:
        ranks, longest, may_follow = self.ranks, self.longest, self.may_follow
        for i in range(len(counts), len(b) + 1):
            j = grown = i - 1 - len(last[i - 1])
            t = b[j:i]
            if not (t in ranks and (j == 0 or may_follow(last[j], t))):
                j = i - 1
                t = b[j:i]
                if j and not may_follow(last[j], t):
                    for j in range(i - 2, max(-1, i - longest - 1), -1):
                        t = b[j:i]
                        if t in ranks and j != grown and (j == 0 or may_follow(last[j], t)):
                            break
                    else:
                        raise ValueError("the vocabulary does not cover this text")
            last.append(t)
            counts.append(counts[j] + 1)
        return counts, last

    def _unit(self, u: str) -> bytes:
        """Deltas of one unit as little-endian 16-bit integers."""
        if u[0] == " " and not u[1:2].isspace() or not u[0].isspace() and u[0] != "'":  # one piece
            counts = self._by_char(u)
            return array("h", map(sub, counts[1:], counts)).tobytes()
        if u[0].isspace() and not u.isspace():  # a prefix inside the run of white space is one piece
            run = len(u) - len(u.lstrip())
        else:
            run = 0
        counts = [0]
        done = 0
        if run > 1:
            counts += self._by_char(u[:run])[1:]
            pieces = self.split.pieces(u)
            base, at = 0, 0
            for p in pieces:
                c = self._by_char(p)
                if at + len(p) > run:
                    skip = max(0, run - at)
                    counts += [base + x for x in c[skip + 1 :]]
                base, at = base + c[-1], at + len(p)
        elif u[0] == "'" and len(u) == 3 and u[1:] in ("re", "ve", "ll"):
            counts += [1, self._whole("'") + self._whole(u[1]), self._by_char(u)[-1]]
        else:
            for p in self.split.pieces(u):
                c = self._by_char(p)
                counts += [done + x for x in c[1:]]
                done += c[-1]
        if run and u[run:] in ("'re", "'ve", "'ll"):  # white space other than a blank, then a contraction
            head = counts[run]
            tail = sum(self._whole(p) for p in self.split.pieces(u[: run + 2]))
            counts[run + 1] = sum(self._whole(p) for p in self.split.pieces(u[: run + 1]))
            counts[run + 2], counts[run] = tail, head
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def _whole(self, piece: str) -> int:
        return len(self._pair(piece.encode()))

    def _by_char(self, piece: str) -> list[int]:
        counts = self.piece_counts(piece.encode())
        if len(counts) == len(piece) + 1:
            return counts
        ends = np.cumsum([len(c.encode()) for c in piece])
        return [0, *(counts[i] for i in ends)]

    def _plain(self, text: str) -> bytes:
        units = self.split.units(text)
        out = [*map(self._units.get, units)]
        if None in out:
            for k, d in enumerate(out):
                if d is None:
                    u = units[k]
                    out[k] = self._older.get(u) or self._units.get(u) or self._unit(u)
                    if len(u) <= LONG_UNIT:
                        if len(self._units) >= REMEMBERED:
                            self._older, self._units = self._units, {}
                        self._units[u] = out[k]
        return b"".join(out)

    def deltas(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return np.frombuffer(self._plain(text), "<i2")
        parts, out = text.split(SPECIAL), []
        for k, part in enumerate(parts):
            own = np.frombuffer(self._plain(part), "<i2")
            out.append(own)
            if k < len(parts) - 1:  # inside the special string, a prefix is ordinary text
                found = self.split.units(part)
                tail = found[-1] if found else ""
                whole = int(own.sum(dtype=np.int64))
                before = whole - int(np.frombuffer(self._plain(tail), "<i2").sum(dtype=np.int64)) if tail else 0
                counts = [whole]
                for j in range(1, len(SPECIAL)):
                    counts.append(before + int(np.frombuffer(self._plain(tail + SPECIAL[:j]), "<i2").sum(dtype=np.int64)))
                counts.append(whole + 1)
                out.append(np.diff(counts).astype("<i2"))
        return np.concatenate(out)

    def table(self, text: str) -> np.ndarray:
        """table[i]: the number of tokens of the first i + 1 characters."""
        return np.cumsum(self.deltas(text), dtype=np.int64)


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that has at most `budget` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@lru_cache(maxsize=2)
def prefix_counter(vocabulary: str) -> PrefixCounter:
    """One per Python worker, kept from task to task."""
    return PrefixCounter(vocabulary)


def count_tokens(df: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, keep_table: bool = False) -> DataFrame:
    """Per row of `df(doc_id, text)`: doc_id, n_bytes, n_tokens, over_limit, and
    cut_chars, the characters of the longest prefix of at most `limit` tokens.
    With keep_table also prefix_deltas, the stored table (16-bit differences), from
    which `answer` reads any budget or length without encoding again.

    Null and empty texts have 0 tokens and an empty table; repeated rows, ties and
    null ids are rows like any other; an empty table gives an empty result; other
    columns are dropped. Long texts are handled unit by unit, in linear time.
    """
    fields = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint"
    fields += ", prefix_deltas binary" if keep_table else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(vocabulary)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for t in batch.column(1):
                text = t.as_py() or ""
                d = counter.deltas(text)
                counts = np.cumsum(d, dtype=np.int64)
                n = int(counts[-1]) if len(counts) else 0
                top = len(counts) if not n > limit and not len(counts) > limit else longest_within(counts, limit)
                for to, x in zip(rows, (len(text.encode()), n, n > limit, top, d.tobytes()), strict=True):
                    to.append(x)
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
            names = ["n_bytes", "n_tokens", "over_limit", "cut_chars", "prefix_deltas"]
            cols = [pa.array(x, k) for x, k in zip(rows, kinds, strict=True)]
            keep = 5 if keep_table else 4
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *cols[:keep]], ["doc_id", *names[:keep]])

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, fields)


def answer(stored: bytes, budget: int | None = None, chars: int | None = None) -> int:
    """From a stored table: characters that fit `budget` tokens, or tokens of the
    first `chars` characters."""
    counts = np.cumsum(np.frombuffer(stored, "<i2"), dtype=np.int64)
    if budget is not None:
        return longest_within(counts, budget)
    n = min(chars or 0, len(counts))
    return int(counts[n - 1]) if n else 0


class Encoder:
    """Ids of whole texts as the tokenizers library gives them.

    Ordinary texts go through the same vocabulary's rank file, which is several
    times faster and yields the same ids; texts with the special string, with
    characters on which Unicode tables differ, or with runs long enough to strain
    that reader go to the tokenizers library itself.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import os

        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._fast = fast._core_bpe.encode_to_tiktoken_buffer
        self._exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self._unsettled, self._long = re.compile(SETTLED).search, re.compile(r"\S{2000}|\s{2000}").search

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if SPECIAL in text or self._unsettled(text) or len(text) > 2000 and self._long(text):
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return bytes(self._fast(text, set()))


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    return Encoder(vocabulary)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
