"""Encoding of texts with a public byte-level BPE tokenizer.

Method: prefix dynamic programming. A text is cut into pieces by the tokenizer's pattern, as its definition wants. For
every prefix of a piece's bytes there is exactly one token that can end the prefix's encoding; the table of these last
tokens is built from left to right: token t may end prefix i if its bytes do, and if the last token of the prefix before t
and t are a pair that the merges leave side by side. Walking back from the end gives the ids. Since the table of a prefix never
changes when more bytes follow, an appended text reuses it (``PrefixEncoder.append``), and an edit re-encodes
only the pieces near it (``PrefixEncoder.replace``).

A sequence of tokens is what the merges produce if and only if each pair of neighbours is; so only pairs need testing, and
tests are remembered.

Defined ids: null and empty texts have an empty list of ids. Special tokens are never produced; their strings in a
text are ordinary text. Long pieces cost time in proportion to their length. Lone surrogates become U+FFFD.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The pattern that cuts a text into pieces (fixed value of the tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A piece's extent can depend on this many characters after its start (a contraction).
LOOK = 3
#: Pieces whose ids a worker keeps; more only cost time.
CACHE = 400_000


def default_vocabulary() -> str:
    """The path of byte_bpe_50k as ranks: ``KINELAKE_TOKENIZERS``, the folder of public tokenizers, or the installed module."""
    for d in (os.environ.get("KINELAKE_TOKENIZERS"), "/opt/tokenizers"):
        if d and Path(d, "byte_bpe_50k.tiktoken").exists():
            return str(Path(d, "byte_bpe_50k.tiktoken"))
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def shipped(spark: SparkSession, path: str) -> Callable[[], str]:
    """Sends a vocabulary file along with the job; the function gives its path on an executor: the same path where it lies there, else the file that was sent."""
    spark.sparkContext.addFile(path)
    name = Path(path).name
    return lambda: path if Path(path).exists() else SparkFiles.get(name)


class Vocabulary:
    """Tokens by bytes and rank, the pair each token is merged from, and a trie of their bytes from the end."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes = {r: b for b, r in self.rank.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for b, r in sorted(self.rank.items(), key=lambda x: x[1]):
            if len(b) > 1:
                got = self._merged(b, r)
                if len(got) == 2:
                    self.parts[r] = got
                    self.merge[got] = r
        self.beside: dict[tuple[int, int], bool] = {}
        root: dict = {}
        for b, r in self.rank.items():
            node = root
            for x in reversed(b):
                node = node.setdefault(x, {})
            node[-1] = (r, len(b))
        self.trie = root

    def _merged(self, b: bytes, below: int) -> tuple[int, ...]:
        """The ids of ``b`` by the merges of a lower rank than ``below``, found the plain way; for single tokens only."""
        ids = [self.rank[bytes([x])] for x in b]
        while len(ids) > 1:
            least, at = below, -1
            for i in range(len(ids) - 1):
                r = self.rank.get(self.bytes[ids[i]] + self.bytes[ids[i + 1]])
                if r is not None and r < least:
                    least, at = r, i
            if at < 0:
                break
            ids[at : at + 2] = [least]
        return tuple(ids)

    def stays(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side, that is, encode their joined bytes as just this pair."""
        known = self.beside.get((left, right))
        if known is None:
            if len(self.beside) > 2_000_000:
                self.beside.clear()
            known = self.beside[left, right] = self._stays(left, right)
        return known

    def _stays(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens' merges step by step: at every moment before it the parts that face each
        # other across the border were there, and no merge across the border may have come first.
        a, b, before = left, right, None
        while True:
            across = self.merge.get((a, b))
            if across is not None and (before is None or across < before):
                return False
            if a > b and a in self.parts or b not in self.parts:
                if a not in self.parts:
                    return True
                before, a = a, self.parts[a][1]
            else:
                # merges of one rank happen from the left, so one across the border would come before b's own
                before, b = b + 1, self.parts[b][0]

    def encode_piece(self, b: bytes, last: list[int] | None = None) -> list[int]:
        """Ids of one piece; ``last`` holds the last token of each prefix of ``b`` that is known already and is extended."""
        whole = self.rank.get(b)
        if whole is not None and last is None:
            return [whole]
        last = [-1] if last is None else last
        trie, stays = self.trie, self.stays
        for end in range(len(last), len(b) + 1):
            node, at, token = trie, end, -1
            while at:
                node = node.get(b[at - 1])
                if node is None:
                    break
                at -= 1
                t = node.get(-1)
                if t is not None and (at == 0 or stays(last[at], t[0])):
                    token = t[0]
                    break
            last.append(token)
        ids, at = [], len(b)
        while at:
            ids.append(last[at])
            at -= len(self.bytes[last[at]])
        return ids[::-1]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def pattern(text: str) -> regex.Pattern:
    return regex.compile(text)


class PrefixEncoder:
    """The pieces of one text with their tables, for exact appends and edits."""

    def __init__(self, vocab: Vocabulary, text: str = "", cut: str = PATTERN):
        self.vocab, self.cut, self.text = vocab, pattern(cut), ""
        self.starts: list[int] = []
        self.tables: list[list[int]] = []
        self.pieces: list[list[int]] = []
        self.append(text)

    @property
    def ids(self) -> list[int]:
        return [x for p in self.pieces for x in p]

    def _piece(self, text: str, table: list[int] | None = None) -> None:
        table = [-1] if table is None else table
        self.pieces.append(self.vocab.encode_piece(text.encode("utf-8", "replace"), table))
        self.tables.append(table)

    def append(self, more: str) -> int:
        """Add ``more``; gives the number of characters that were looked at again."""
        old = len(self.text)
        at, reuse = old, None
        while self.starts and (at >= old or self.starts[-1] + LOOK > old):
            at = self.starts.pop()
            self.pieces.pop()
            reuse = self.tables.pop()
        kept = self.text[at:old]
        self.text += more
        for m in self.cut.finditer(self.text, at):
            table = None
            if reuse is not None and m.start() == at and len(m.group()) > 0:
                # the table of the longest common prefix of the old and the new piece stays as it is
                keep = len(m.group()[: len(kept)].encode("utf-8", "replace"))
                table = reuse[: min(len(reuse), keep + 1)]
            self.starts.append(m.start())
            self._piece(m.group(), table)
        return old - at

    def replace(self, begin: int, end: int, new: str) -> int:
        """Put ``new`` in the place of characters begin .. end; gives the number of pieces that were encoded again."""
        first = len(self.starts)
        while first and self.starts[first - 1] + LOOK > begin or first and (self.starts[first] if first < len(self.starts) else len(self.text)) >= begin:
            first -= 1
        tail = {s - (end - begin) + len(new): i for i, s in enumerate(self.starts) if s >= end}
        at = self.starts[first] if first < len(self.starts) else 0
        self.text = self.text[:begin] + new + self.text[end:]
        starts, pieces, tables = self.starts, self.pieces, self.tables
        self.starts, self.pieces, self.tables = starts[:first], pieces[:first], tables[:first]
        done = 0
        for m in self.cut.finditer(self.text, at):
            same = tail.get(m.start())
            if same is not None:
                shift = m.start() - starts[same]
                self.starts += [s + shift for s in starts[same:]]
                self.pieces += pieces[same:]
                self.tables += tables[same:]
                break
            self.starts.append(m.start())
            self._piece(m.group())
            done += 1
        return done


class Encoder:
    """Whole texts; pieces met before are taken from a cache."""

    def __init__(self, path: str, cut: str = PATTERN):
        self.vocab, self.cut = vocabulary(path), pattern(cut)
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for piece in self.cut.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= CACHE:
                    known.clear()
                ids = self.vocab.encode_piece(piece.encode("utf-8", "replace"))
                if len(piece) <= 64:
                    known[piece] = ids
            out += ids
        return out


def encoded(documents: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of integers) of every row, whole texts."""
    where = shipped(documents.sparkSession, path or default_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(where())
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [enc.encode(t) for t in texts]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.fromiter((x for y in ids for x in y), np.int32, int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(documents: DataFrame, path: str | None = None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of every row; null and empty texts have none."""
    where = shipped(documents.sparkSession, path or default_vocabulary())
    cols = documents.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[:-1]) + ", n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(where())
        for b in batches:
            n = pa.array([len(enc.encode(t)) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*keep, "n_tokens"])

    return cols.mapInArrow(run, schema)
