"""Token counts by the whole-token shortcut (operator 10), and exact ids for packing.

A pre-token that is a vocabulary string which the library encodes alone as one token counts one; that
is proved once per worker by encoding every vocabulary string by itself. Only other pre-tokens go
through the merges, and each distinct one only once while it stays in a bounded table.

The pre-token pattern is run by ``regex``. It depends on a character's class alone: letter, digit, space or
other. That both libraries put a character in the same class is proved by three short strings, for those in
``_PROVEN`` by the tests and for others when a worker first meets them. Only a text with a character on which
they differ, or with an added special string, is encoded whole by the library.

Ids of a text of ``_PROVEN`` characters come from ``tiktoken`` with the same pattern, in one call and without
tables; the tests prove that it puts these characters in the same classes too.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
from collections.abc import Callable, Iterator
from functools import cached_property
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm.common import held, lean, table

# The pattern of byte-level pre-tokens, and code points for which both libraries agree.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PROVEN = r"[^\x00-\u0557\u2010-\u2064\u20a0-\u20bf]"

#: Runs of spaces that are too long for the steps back of ``tiktoken``'s pattern.
_long_blank = re.compile(r"\s{1000}").search

#: Entries that a worker's table of merged pre-tokens may hold before it starts anew.
TABLE_ENTRIES = 100_000


def resolve(tokenizer: str) -> str:
    """The place of a vocabulary file: a path, or a name among the installed public ones."""
    if os.path.isabs(tokenizer):
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_chars() -> dict[int, str]:
    """The printable characters by which byte-level vocabularies write bytes: the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Table(dict):
    """pre-token -> value; what is missing is computed, and growth is bounded."""

    def __init__(self, whole: dict, make: Callable) -> None:
        super().__init__(whole)
        self._whole, self._make = whole, make

    def __missing__(self, key: str):
        if len(self) > len(self._whole) + TABLE_ENTRIES:
            self.clear()
            self.update(self._whole)
        value = self[key] = self._make(key)
        return value


class ByteTokens:
    """Counts and ids of one byte-level BPE vocabulary, equal to the library's."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._t = Tokenizer.from_file(resolve(tokenizer))
        self._t.no_truncation()
        self._t.no_padding()
        self._find = regex.compile(PATTERN).findall
        self._odd, self._strange = regex.compile(_PROVEN).findall, regex.compile(_PROVEN).search
        self._agree: dict[str, bool] = {}
        self._special = [t.content for t in self._t.get_added_tokens_decoder().values()]
        self._core = self._ranked(resolve(tokenizer))

    @cached_property
    def _whole(self) -> dict[str, int]:
        return self._prove()

    @cached_property
    def _counts(self) -> _Table:
        return _Table(dict.fromkeys(self._whole, 1), lambda p: len(self._merge(p.encode())))

    @cached_property
    def _bytes(self) -> _Table:
        return _Table({p: i.to_bytes(4, "little") for p, i in self._whole.items()}, lambda p: _little(self._merge(p.encode())))

    def _merge(self, piece: bytes) -> list[int]:
        return self._core.encode_single_piece(piece) if self._core else self._encode(piece.decode())

    def _encode(self, text: str) -> list[int]:
        return self._t.encode(text, add_special_tokens=False).ids

    def _ranked(self, path: str) -> object | None:
        """``tiktoken``'s encoder, where the file's ids are ranks of its merges.

        Then both libraries merge the adjacent pair of least rank until none is left, so they agree.
        """
        import tiktoken

        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        vocab = model["vocab"]
        char = {c: b for b, c in _byte_chars().items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(pairs)) or sorted(vocab[c] for c in char) != [*range(256)]:
            return None
        ranks = {bytes(char[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def _prove(self) -> dict[str, int]:
        """Vocabulary strings that are one pre-token and that the library encodes alone as one token."""
        strings = [s for i in range(self._t.get_vocab_size(with_added_tokens=False)) if (s := self._t.decode([i])) and "\ufffd" not in s and self._find(s) == [s]]
        ids = self._t.encode_batch(strings, add_special_tokens=False)
        return {s: e.ids[0] for s, e in zip(strings, ids) if len(e.ids) == 1}

    def agree(self, c: str) -> bool:
        """Whether both libraries put a character in the same class: beside its like it makes one piece."""
        if c not in self._agree:
            strings = (f"a{c}a", f"1{c}1", f"!{c}!")
            self._agree[c] = self._t.normalizer is None and all(len(self._find(s)) == len(self._t.pre_tokenizer.pre_tokenize_str(s)) for s in strings)
        return self._agree[c]

    def _plain(self, text: str) -> bool:
        return all(map(self.agree, set(self._odd(text)))) and not any(s in text for s in self._special)

    def count(self, text: str) -> int:
        return sum(map(self._counts.__getitem__, self._find(text))) if self._plain(text) else len(self._encode(text))

    def id_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self._core and sys.byteorder == "little" and not any(s in text for s in self._special) and (text.isascii() or not self._strange(text)) and not _long_blank(text):
            return bytes(self._core.encode_to_tiktoken_buffer(text, set()))
        return b"".join(map(self._bytes.__getitem__, self._find(text))) if self._plain(text) else _little(self._encode(text))


@held
def byte_tokens(tokenizer: str) -> ByteTokens:
    return ByteTokens(tokenizer)


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; no shuffle, rows in, rows out.

    Null and empty texts have 0 bytes and 0 tokens; null ids, repeated rows and ties keep a row each; an
    empty table gives no rows; other columns are not read, so clashing names do no harm. Texts of any
    length are counted whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(tokenizer)
        for b in batches:
            n = [tokens.count(t) if t else 0 for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    ids = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
    out = src.mapInArrow(lean(count, byte_tokens), f"doc_id {ids}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
