"""Encoding of a corpus with a public byte-level BPE tokenizer, by dynamic programming over prefixes."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZERS = os.environ.get("PHASEMILL_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the public pattern by which byte_bpe_50k and byte_bpe_multi_50k split text before any merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bounds of what a worker keeps: pieces, pairs and lines, and how long a piece or line may be to be kept.
CACHED_PIECES, CACHED_PAIRS, CACHED_LENGTH = 300_000, 1_000_000, 64
CACHED_LINES, CACHED_LINE_LENGTH = 50_000, 800
# The pattern always cuts between a line end behind a visible character and a visible character, and such
# a cut changes no other: lines so parted can be encoded apart, and they recur in revisions of a page.
LINE_CUT = re.compile(r"(?<=\S\n)(?=\S)")
FLUSH_IDS = 4_000_000


class PrefixBPE:
    """A byte-level BPE vocabulary whose ids are the merges' ranks.

    For every byte prefix of a piece exactly one token can be the last of the prefix's encoding. A
    token t may follow the encoding of the rest if the merges would leave (last token of the rest,
    t) apart; so the last tokens of all prefixes are found left to right, each from those before it,
    in time linear in the piece (tokens are of bounded length), also for words of many kilobytes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.pieces = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.size = max(ranks.values()) + 1
        self.length = [0] * self.size
        self.left = list(range(self.size))
        self.right = list(range(self.size))
        self.merged: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces = _Pieces(self.piece)
        self._lines: dict[str, array] = {}
        lengths: dict[bytes, set[int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.length[rank] = len(token)
            lengths.setdefault(token[-3:], set()).add(len(token))
            if len(token) == 1:
                continue
            # the two tokens that this one's bytes consist of before its own merge
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None and a < rank and b < rank and self._apart(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.merged[a, b] = rank
                    break
        # the lengths, longest first, of the tokens that end in these (up to three) bytes
        self.lengths = {k: tuple(sorted(set().union(*(lengths.get(k[-j:], ()) for j in range(1, len(k) + 1))), reverse=True)) for k in lengths}

    def _apart(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``a`` followed by token ``b`` as these two tokens."""
        merged, left, right = self.merged, self.left, self.right
        bound = self.size  # of what was undone on the way here, the merge that would have come first
        while True:
            joined = merged.get((a, b))
            if joined is not None and joined < bound:
                return False
            # undo the later of the two merges at the seam; a single byte has none
            a_can, b_can = right[a] != a, left[b] != b
            if not a_can and not b_can:
                return True
            if a_can and (not b_can or a > b):
                bound, a = a, right[a]
            else:
                # a merge of equal rank on the right comes after one at the seam
                bound, b = b + 1, left[b]

    def follows(self, a: int, b: int) -> bool:
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[a, b] = self._apart(a, b)
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Continue ``last``, the last tokens of the prefixes of ``data`` so far, to its end, in place."""
        ranks, lengths, follows = self.ranks, self.lengths, self.follows
        for end in range(len(last) + 1, len(data) + 1):
            tail = data[max(0, end - 3) : end]
            for n in lengths.get(tail) or lengths.get(tail[-2:]) or lengths[tail[-1:]]:
                begin = end - n
                if begin < 0:
                    continue
                token = ranks.get(data[begin:end])
                if token is not None and (self._whole(token) if begin == 0 else follows(last[begin - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return last

    def _whole(self, token: int) -> bool:
        """A token of several bytes stands for them only if merges lead to it."""
        return self.length[token] == 1 or self.left[token] != token

    def walk(self, last: Sequence[int]) -> list[int]:
        """The tokens of the whole from the last tokens of its prefixes."""
        out, at = [], len(last)
        while at:
            token = last[at - 1]
            out.append(token)
            at -= self.length[token]
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode()
        whole = self.ranks.get(data)
        ids = (whole,) if whole is not None and self._whole(whole) else tuple(self.walk(self.extend(data, [])))
        return ids

    def encode_into(self, text: str, out: array) -> None:
        lines, piece = self._lines, self._pieces.__getitem__
        for line in LINE_CUT.split(text):
            ids = lines.get(line)
            if ids is None:
                ids = array("i", chain.from_iterable(map(piece, self.split(line))))
                if len(line) <= CACHED_LINE_LENGTH:
                    if len(lines) >= CACHED_LINES:
                        lines.clear()
                    lines[line] = ids
            out.extend(ids)

    def encode(self, text: str) -> list[int]:
        out = array("i")
        self.encode_into(text, out)
        return out.tolist()


class _Pieces(dict):
    """Ids by piece; missing ones are made, and kept if short, until there are too many."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self._make(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[text] = ids
        return ids


class EditableEncoding:
    """A text with the last token of every prefix of its pieces, for exact appends and edits."""

    def __init__(self, bpe: PrefixBPE, text: str = ""):
        self.bpe = bpe
        self.text = ""
        self.pieces: list[tuple[str, list[int]]] = []
        self.recoded = 0
        self.append(text)

    def ids(self) -> list[int]:
        return [t for _, last in self.pieces for t in self.bpe.walk(last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, begin: int, end: int, by: str) -> None:
        """Put ``by`` in place of the characters from ``begin`` to ``end``; only pieces near it are encoded anew.

        How a piece ends depends on at most two characters behind it, so pieces that end three
        characters before the edit stay; behind it, all pieces stay from the first cut that falls on
        an old one. In the first piece that changes, the prefixes before the edit keep their tokens.
        """
        starts, at = [], 0
        for p, _ in self.pieces:
            starts.append(at)
            at += len(p)
        keep = 0
        while keep < len(self.pieces) and starts[keep] + len(self.pieces[keep][0]) + 2 < begin:
            keep += 1
        origin = starts[keep] if keep < len(starts) else at
        text = self.text[:begin] + by + self.text[end:]
        shift = len(text) - len(self.text)
        old_cuts = {s + shift: i for i, s in enumerate(starts) if s >= end}
        fresh: list[tuple[str, list[int]]] = []
        rest = len(self.pieces)
        pos = origin
        self.recoded = 0
        for m in _matches(self.bpe, text, origin):
            if pos >= begin + len(by) and pos in old_cuts:
                rest = old_cuts[pos]
                break
            known: list[int] = []
            old = self.pieces[keep + len(fresh)] if keep + len(fresh) < len(self.pieces) else None
            if old and pos == starts[keep + len(fresh)]:
                same = len(os.path.commonprefix([old[0].encode(), m.encode()]))
                known = old[1][:same]
            self.recoded += len(m.encode()) - len(known)
            fresh.append((m, self.bpe.extend(m.encode(), known)))
            pos += len(m)
        self.text = text
        self.pieces = self.pieces[:keep] + fresh + self.pieces[rest:]


def _matches(bpe: PrefixBPE, text: str, pos: int) -> Iterator[str]:
    finder = bpe.split.__self__
    while pos < len(text):
        m = finder.match(text, pos)
        yield m.group()
        pos = m.end()


@lru_cache(maxsize=4)
def load_bpe(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> PrefixBPE:
    """The vocabulary of a rank file; kept per process, so that a Python worker reads it once."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return PrefixBPE(ranks)


def _lists(ids: array, ends: array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)]), pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids)]))


def encode_corpus(df: DataFrame, keys: Sequence[str], text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, count_only: bool = False) -> DataFrame:
    """``(*keys, ids)``, or with ``count_only`` ``(*keys, n_tokens)``, for every row.

    Each whole text is encoded without special tokens; their strings in a text are ordinary text. A
    NULL and an empty text both give the empty list. Repeated rows are each encoded. Only ``keys``
    and ``text`` are read. A map without shuffle: each task splits its texts by the tokenizer's
    pattern and encodes each piece by :class:`PrefixBPE`; pieces recur, so their ids are kept per
    worker in a table of bounded size. Output is flushed by number of ids, not of rows.
    """
    kept = df.select(*keys, F.col(text).alias("__text"))
    result = T.StructField("n_tokens", T.LongType()) if count_only else T.StructField("ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "__text"], result])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(name, folder)
        for b in batches:
            column = b.column(b.num_columns - 1)
            ids, ends, begin, counts = array("i"), array("i", [0]), 0, []

            def flushed(upto: int) -> pa.RecordBatch:
                parts = [c.slice(begin, upto - begin) for c in b.columns[:-1]]
                value = pa.array(counts, pa.int64()) if count_only else _lists(ids, ends)
                return pa.RecordBatch.from_arrays([*parts, value], names=schema.names)

            for i in range(b.num_rows):
                one = column[i].as_py()
                if one:
                    bpe.encode_into(one, ids)
                if count_only:
                    counts.append(len(ids))
                    del ids[:]
                else:
                    ends.append(len(ids))
                    if len(ids) >= FLUSH_IDS:
                        yield flushed(i + 1)
                        ids, ends, begin = array("i"), array("i", [0]), i + 1
            if count_only or begin < b.num_rows:
                yield flushed(b.num_rows)

    return kept.mapInArrow(run, schema)


def decode_corpus(df: DataFrame, keys: Sequence[str], ids: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``(*keys, text)``: the texts that encodings stand for; a NULL list gives the empty text. Bytes that aren't UTF-8 become replacement characters."""
    kept = df.select(*keys, F.col(ids).alias("__ids"))
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "__ids"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_bpe(name, folder).pieces
        for b in batches:
            texts = [b"".join([pieces[i] for i in x or ()]).decode(errors="replace") for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)
