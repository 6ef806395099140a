"""Byte-level BPE in linear time (problem 7).

A text is cut into pieces by the tokenizer's split pattern; each distinct piece is encoded once and
kept. Within a piece the bytes, read as Latin-1 characters, run through an Aho-Corasick automaton of
the vocabulary, which gives the longest token at each position. Starting from the longest match the
encoder walks on, and steps back to a shorter token whenever two neighbours could not stand next to
each other after the merges; whether a pair can is memoised. The result is the merges' own.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tamarack.sources.tables import text_table

DEFAULT_TOKENIZERS = "/opt/tokenizers"
# The split pattern that the byte-level vocabularies of this family are defined with.
SPLIT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept per worker, and answers about neighbouring tokens; a store is emptied when full, so memory stays bounded.
KEPT_PIECES, KEPT_PAIRS = 400_000, 1_000_000


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def _quick_patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Forms of the pattern for the standard engine, and what a text must not hold for them to be exact."""
    ascii_form = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
    unicode_form = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    # In the standard engine the letters' class also takes numbers that are no decimal digits, and white space also the separators 1C to 1F.
    odd = "".join(re.escape(chr(c)) for c in range(0x80, 0x3400) if unicodedata.category(chr(c)) in ("Nl", "No"))
    return ascii_form, unicode_form, re.compile(f"[\x1c-\x1f{odd}꘠-꛿꠰-꠿\U00010000-\U0010ffff]")


class ByteBPE(dict):
    """Maps a piece to the tuple of its ids; missing pieces are encoded and kept."""

    def __init__(self, path: str) -> None:
        super().__init__()
        whole = json.loads(Path(path).read_text(encoding="utf-8"))
        data, before = whole["model"], whole.get("pre_tokenizer") or {}
        if data.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or whole.get("normalizer"):
            raise ValueError(f"{path} is no byte-level vocabulary that encodes texts as they stand")
        special = {t["id"] for t in whole.get("added_tokens", ()) if t["special"]}
        chars = _byte_chars()
        to_latin = str.maketrans({k: chr(b) for k, b in chars.items()})
        ids = {t.translate(to_latin): i for t, i in data["vocab"].items() if i not in special and all(c in chars for c in t)}
        # parts: for each id the two ids it is merged from, itself twice for a byte. rank: the place of the merge that makes it.
        self.parts: dict[int, tuple[int, int]] = {i: (i, i) for i in ids.values()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        for n, merge in enumerate(data["merges"]):
            a, b = (merge.split(" ") if isinstance(merge, str) else merge)
            left, right = ids[a.translate(to_latin)], ids[b.translate(to_latin)]
            joined = ids[(a + b).translate(to_latin)]
            self.parts[joined], self.merged[left, right], self.rank[joined] = (left, right), joined, n
        self.ids = ids
        self.trie = ahocorasick.Automaton()
        for t, i in ids.items():
            self.trie.add_word(t, (len(t), i))
        self.trie.make_automaton()
        self.text_of = {i: t for t, i in ids.items()}
        self.shorter: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def can_touch(self, a: int, b: int) -> bool:
        """Whether the merges leave a directly before b.

        The merges are undone from the latest on, on both sides of the border; if at any moment the two
        tokens at the border have a merge that comes before the one undone, it would have been made.
        """
        known = self.fits.get((a, b))
        if known is not None:
            return known
        left, right, undone = a, b, len(self.merged) + 1
        rank, parts = self.rank, self.parts
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and rank[joined] < undone:
                ok = False
                break
            rl, rr = rank.get(left, -1), rank.get(right, -1)
            if rl < 0 and rr < 0:
                ok = True
                break
            # Of merges in both tokens the later one is undone first; of one merge in both, the right one, as merges run from the left.
            if rl > rr:
                left, undone = parts[left][1], rl
            else:
                right, undone = parts[right][0], rr + 1
        if len(self.fits) >= KEPT_PAIRS:
            self.fits.clear()
        self.fits[a, b] = ok
        return ok

    def next_shorter(self, i: int) -> tuple[int, int] | None:
        """(length, id) of the longest token that is a proper prefix of token i."""
        if i not in self.shorter:
            t, out = self.text_of[i], None
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in self.ids:
                    out = (n, self.ids[t[:n]])
                    break
            self.shorter[i] = out
        return self.shorter[i]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.ids.get(text)
        if whole is not None:
            return (whole,)
        n = len(text)
        longest: list[tuple[int, int] | None] = [None] * (n + 1)
        for end, (size, i) in self.trie.iter(text):
            at = end - size + 1
            if longest[at] is None or longest[at][0] < size:
                longest[at] = (size, i)
        open_at = bytearray(b"\x01" * (n + 1))
        out: list[int] = []
        sizes: list[int] = []
        pos, trial = 0, longest[0]
        while pos < n:
            while trial is not None:
                size, i = trial
                if open_at[pos + size] and (not out or self.can_touch(out[-1], i)):
                    break
                trial = self.next_shorter(i)
            if trial is None:
                open_at[pos] = 0
                pos -= sizes.pop()
                trial = self.next_shorter(out.pop())
            else:
                out.append(trial[1])
                sizes.append(trial[0])
                pos += trial[0]
                trial = longest[pos]
        return tuple(out)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= KEPT_PIECES:
            self.clear()
        out = self.encode_piece(piece)
        if len(piece) <= 64:
            self[piece] = out
        return out

    def pieces(self, text: str) -> list[str]:
        plain, wide, unfit = _quick_patterns()
        if text.isascii():
            if not unfit.search(text):
                return plain.findall(text)
        elif not unfit.search(text):
            return wide.findall(text)
        return _split().findall(text)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text without special tokens; null and empty texts have none."""
        return list(chain.from_iterable(map(self.__getitem__, self.pieces(text)))) if text else []


@cache
def _split() -> regex.Pattern:
    return regex.compile(SPLIT_PATTERN)


@cache
def load(path: str) -> ByteBPE:
    """The tokenizer of a byte-level vocabulary file, once per worker; other kinds of vocabulary are refused."""
    return ByteBPE(path)


def vocabulary_path(tokenizer_name: str, folder: str = DEFAULT_TOKENIZERS) -> str:
    return f"{folder}/{tokenizer_name}.json"


@cache
def token_counter(tokenizer_name: str, folder: str = DEFAULT_TOKENIZERS) -> Callable[[str], int]:
    """How many ids a text has by any tokenizer of the folder, special tokens left out; the library of its kind counts what is no byte-level JSON vocabulary."""
    path = Path(vocabulary_path(tokenizer_name, folder))
    if path.exists():
        try:
            own = load(str(path))
            return lambda text: sum(map(len, map(own.__getitem__, own.pieces(text))))
        except ValueError:
            from tokenizers import Tokenizer

            other = Tokenizer.from_file(str(path))
            other.encode_special_tokens = True
            return lambda text: len(other.encode(text, add_special_tokens=False).ids)
    if (ranks := path.with_suffix(".tiktoken")).exists():
        import tiktoken

        pairs = (line.split() for line in ranks.read_bytes().splitlines() if line)
        known = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        return lambda text: len(known.encode_ordinary(text))
    if (pieces := path.with_suffix(".model")).exists():
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=str(pieces))
        return lambda text: len(processor.encode(text))
    raise ValueError(f"no vocabulary of {tokenizer_name} in {folder}")


def encode_column(df: DataFrame, id_col: str, text_col: str, tokenizer_name: str = "byte_bpe_50k", folder: str = DEFAULT_TOKENIZERS) -> DataFrame:
    """Rows (id, ids): the whole text of every row in token ids, in one narrow pass over Arrow batches.

    Null and empty texts give an empty list, marker strings are plain text, repeated rows each keep
    their row and other columns are ignored. Each worker holds one vocabulary (about 60 MB), at
    most KEPT_PIECES encoded pieces and KEPT_PAIRS answers about neighbours.
    """
    path = vocabulary_path(tokenizer_name, folder)
    source = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids, offsets = [], [0]
            for text in batch.column(1).to_pylist():
                ids += bpe.encode(text)
                offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(np.array(ids, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "ids"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_column(text_table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")
