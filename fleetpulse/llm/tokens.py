"""Token ids of the public tokenizers, fast enough for whole corpora.

Both encoders give the ids that the ``tokenizers`` library gives for the file, special tokens not
added. They read the vocabulary from that library and merge with the faster ``tiktoken``, as byte
ranks. Texts with characters on which the two libraries' character classes or cases could differ,
and texts that spell a special token, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable
from functools import cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import as_field, fields, map_batches

# Latin letters and signs up to U+017F, and white space that every library takes as such.
_PLAIN = re.compile("[\\x20-\\x7e\\n\\t\\r\\u00a1-\\u017f]*")
_MOST_CHUNKS = 1 << 19  # distinct chunks of text a WordEncoder keeps


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_values() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and its byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteEncoder:
    """Byte-level BPE without normalisation, from a ``tokenizers`` file."""

    PATTERN = (
        r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    )

    def __init__(self, path: str):
        import tiktoken

        self.library = _library(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        byte_of = _byte_values()
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in self.library.get_vocab(with_added_tokens=True).items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.special = sorted(special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def _classes() -> tuple[str, str]:
    """Letters and numbers among the plain characters."""
    plain = [chr(c) for c in range(0x21, 0x180)]
    return tuple("".join(c for c in plain if unicodedata.category(c)[0] == k) for k in "LN")


class Runs:
    """Arrays of different lengths, one behind the other."""

    def __init__(self):
        self.flat, self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, np.cumsum(sizes) - sizes + len(self.flat)))
        self.flat = np.concatenate((self.flat, flat))
        self.sizes = np.concatenate((self.sizes, sizes))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen arrays in a row, and their lengths."""
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at + np.repeat(self.starts[which] - (ends - sizes), sizes)], sizes


class Numbers(dict):
    """Numbers keys as they are met; those met for the first time wait in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number

    def of(self, keys: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, count)

    def take_new(self) -> list[str]:
        found, self.new = self.new, []
        return found


class WordEncoder:
    """A lower-casing tokenizer whose words end in a mark: every word is encoded by itself.

    A text is cut at white space into chunks and a chunk into words by the tokenizer's own
    pattern. The ids of each distinct chunk are worked out once, with the vocabulary as byte ranks
    in which the byte 0, which plain texts do not have, stands for the end of a word.
    """

    LETTERS, NUMBERS = _classes()
    PATTERN = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+"
    )

    def __init__(self, path: str):
        import tiktoken

        self.library = _library(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        byte_of, ranks = _byte_values(), {}
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            if token not in special:
                end = b"\0" if token.endswith("</w>") else b""
                ranks[bytes(byte_of[c] for c in token.removesuffix("</w>")) + end] = i
        self.fast = tiktoken.Encoding("ranks", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
        self.ends_word = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            self.ends_word[i] = len(token) > 1 and token.endswith(b"\0")
        self.chunks, self.chunk_ids = Numbers(), Runs()

    def _learn(self, chunks: list[str]) -> None:
        split = list(map(self.PATTERN.findall, chunks))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        marked = "\0".join(chain.from_iterable(split)) + "\0"
        ids = np.array(self.fast.encode_ordinary(marked), np.int64)
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) != counts.sum():
            raise ValueError("the vocabulary does not mark the end of each word")
        self.chunk_ids.add(ids, _sums(np.diff(last, prepend=-1), counts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.chunks) > _MOST_CHUNKS:
            self.chunks, self.chunk_ids = Numbers(), Runs()
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, split = [], []
        for i, text in enumerate(texts):
            if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                plain.append(i)
                split.append(text.lower().split())
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
                out[i] = np.array(ids, dtype=np.uint32)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        codes = self.chunks.of(chain.from_iterable(split), int(counts.sum()))
        if new := self.chunks.take_new():
            self._learn(new)
        flat, sizes = self.chunk_ids.take(codes)
        ends = np.cumsum(_sums(sizes, counts))
        for i, ids in zip(plain, np.split(flat.astype(np.uint32), ends[:-1])):
            out[i] = ids
        return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of values, of the given sizes."""
    through = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return through[ends] - through[ends - counts]


ENCODERS = {"byte": ByteEncoder, "word": WordEncoder}


@cache
def encoder(kind: str, path: str):
    """One encoder for all tasks of a worker."""
    return ENCODERS[kind](path)


@cache
def vocabulary_size(path: str) -> int:
    return max(_library(path).get_vocab().values()) + 1


def id_bytes(path: str) -> int:
    """Bytes in which every id of the vocabulary fits: two or four."""
    return 2 if vocabulary_size(path) <= 1 << 16 else 4


def tokenize(
    docs: DataFrame, path: str, kind: str, end_id: int, id_col: str = "doc_id"
) -> DataFrame:
    """(_id, ids, n): ids of each row, ``end_id`` appended, as little-endian integers.

    Ids take ``id_bytes(path)`` bytes each. A null text is an empty one: its only id is ``end_id``.
    """
    width = id_bytes(path)

    def rows(columns):
        end = np.array([end_id], dtype=np.uint32)
        texts = [t or "" for t in columns["_text"].to_pylist()]
        ids = [np.concatenate((x, end)) for x in encoder(kind, path).encode(texts)]
        return {
            "_id": columns["_id"],
            "ids": [x.astype(f"<u{width}").tobytes() for x in ids],
            "n": [len(x) for x in ids],
        }

    slim = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("_text"))
    schema = fields(as_field(docs, id_col, "_id"), "ids binary", "n bigint")
    return map_batches(slim, rows, schema)
