"""Operator 10: sequences of at most 4096 tokens, packed by the sum-of-squares rule.

A document's tokens (ids of a public tokenizer, then the end id) are cut into pieces only where
it is longer than a sequence. Pieces are packed in groups: within a group the longest come first,
and each goes where it makes the sum over all gaps g of (open sequences with gap g) squared
smallest, a new sequence included; so no gap piles up that nothing fits. Ties prefer the
smaller gap, then an open sequence.

Texts are tokenised once, map-side; only piece lengths are shuffled. A group has about ``GROUP``
pieces by a hash of the piece, so any number of groups pack in parallel, a source or a group of
copies spreads evenly, and each group leaves a few unfilled sequences, some thousandths of its
own. White space never joins two tokens of this tokenizer, so words between ASCII spaces are
tokenised once per task each and remembered in a bounded table; texts are read whole.

A null text is empty and yields the end id alone; repeated rows are packed each; an empty table
gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, table

#: Tokens of a sequence, id that ends a document, pieces packed by one task, words remembered.
CAPACITY, END_ID, GROUP, REMEMBERED = 4096, 1, 50_000, 600_000
#: Bytes of short texts and words of a text that are handled at once.
TOGETHER, WORDS = 1 << 18, 1 << 17


#: Punctuation (without apostrophes) that ends a word after a letter is a token run of its own.
_ENDING = re.compile(rb"(.*[a-z])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)
#: Letters that no rule before the model changes but by lower-casing.
_LETTERS = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+")


def _byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte in a byte-level vocabulary: its own where it
    has one in Latin-1, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of texts, by remembered words. The tokenizer lower-cases texts itself."""

    def __init__(self, tokenizer_path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered, self.signs = Tokenizer.from_file(tokenizer_path), remembered, _byte_signs()
        self._clear()

    def _clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.tails: dict[bytes, list[int]] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.first = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int64)

    def _letters(self, word: bytes) -> list[int] | None:
        """Ids of a word of letters that no rule before the model changes but by lower-casing."""
        if not word.isalpha():  # of bytes: a-z, as A-Z are lower-cased
            text = word.decode()
            if not _LETTERS.fullmatch(text):
                return None
            word = "".join(map(self.signs.__getitem__, text.lower().encode())).encode()
        return [t.id for t in self.tokenizer.model.tokenize(word.decode())]

    def _known(self, word: bytes) -> list[int] | None:
        at = self.code.get(word)
        if at is None:
            return None
        return self.ids[self.first[at]:self.first[at] + self.length[at]].tolist()

    def _ids_of(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int] | None] = []
        rest = []
        for w in words:
            ids = self._letters(w)
            if ids is None and (cut := _ENDING.fullmatch(w)):
                body, tail = cut.groups()
                ids = self._known(body) or self._letters(body)
                if ids is not None:
                    if tail not in self.tails:
                        self.tails[tail] = self.tokenizer.encode(tail.decode(), add_special_tokens=False).ids
                    ids = ids + self.tails[tail]
            out.append(ids)
            if ids is None:
                rest.append(w.decode())
        found = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [next(found).ids if x is None else x for x in out]

    def _learn(self, words: list[bytes]) -> None:
        """Adds new, different words."""
        found = self._ids_of(words)
        lengths = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.array([i for x in found for i in x], dtype=np.uint32)
        code = len(self.code)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while code + len(words) > len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length))
        self.ids[self.used:self.used + len(flat)] = flat
        self.first[code:code + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.length[code:code + len(words)] = lengths
        self.used += len(flat)
        self.code.update(zip(words, range(code, code + len(words)), strict=True))

    def _codes(self, words: list[bytes]) -> np.ndarray:
        get = self.code.get
        codes = [get(w, -1) for w in words]
        if -1 in codes:
            new = list(dict.fromkeys(w for w, c in zip(words, codes, strict=True) if c < 0))
            if len(self.code) + len(new) > self.remembered:
                self._clear()
                codes, new = [-1] * len(words), list(dict.fromkeys(words))
            self._learn(new)
            get = self.code.__getitem__
            codes = [get(w) if c < 0 else c for w, c in zip(words, codes, strict=True)]
        return np.array(codes, dtype=np.int64)

    def _words_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids before each word and in all)."""
        code = self._codes(words)
        length = self.length[code]
        ends = np.r_[0, np.cumsum(length)]
        return self.ids[np.repeat(self.first[code] - ends[:-1], length) + np.arange(ends[-1])], ends

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of every text, in order; texts are handled about ``TOGETHER`` bytes at once."""
        at = 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and (to == at or held + len(texts[to]) <= TOGETHER):
                held += len(texts[to])
                to += 1
            words, cuts, special = [], [0], {}
            for i, text in enumerate(texts[at:to]):
                if b"<|" in text:  # may hold a special token, which is found before letters are lower-cased
                    special[i] = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)
                else:
                    words += text.lower().split()
                cuts.append(len(words))
            parts = [self._words_ids(words[k:k + WORDS]) for k in range(0, len(words), WORDS)]
            ids = np.concatenate([x for x, _ in parts]) if parts else np.zeros(0, np.uint32)
            base, before = 0, [np.zeros(1, np.int64)]
            for x, ends in parts:
                before.append(ends[1:] + base)
                base += len(x)
            place = np.concatenate(before)[cuts]
            for i in range(to - at):
                yield special[i] if i in special else ids[place[i]:place[i + 1]]
            at = to


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = WordIds(tokenizer_path)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            for i, found in enumerate(words.encode(texts)):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for p, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc_ids[i], p, start, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                cols, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in the given order."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)  # of open bins by gap; full ones do not count
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        if s == capacity:
            bins[i], offsets[i], made = made, 0, made + 1
            continue
        gaps = np.flatnonzero(count[s:])  # gap s + g takes the piece and leaves g
        new = 2 * count[capacity - s] + 1
        if len(gaps):
            # the sum falls by 2 N(g) - 1 at the old gap and grows by 2 N(g - s) + 1 at the new one
            grown = np.where(gaps > 0, 2 * count[gaps] + 1, 0)
            change = grown - 2 * count[gaps + s] + 1
            k = int(np.argmin(change))
            if change[k] <= new:
                left = int(gaps[k])
                b = open_bins[left + s].pop()
                count[left + s] -= 1
                bins[i], offsets[i] = b, capacity - left - s
                if left:
                    open_bins[left].append(b)
                    count[left] += 1
                continue
        bins[i], offsets[i] = made, 0
        open_bins[capacity - s].append(made)
        count[capacity - s] += 1
        made += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to written pieces (doc_id, piece, start, length, ids_crc32)."""
    groups = max(1, -(-pieces.count() // group))

    def run(one: pa.Table) -> pa.Table:
        order = np.lexsort((one.column("piece").to_numpy(), one.column("doc_id").to_pandas().fillna(-1).to_numpy(),
                            -one.column("length").to_numpy()))
        one = one.take(pa.array(order))
        bins, offsets = sum_of_squares(one.column("length").to_numpy(), capacity)
        number = one.column("part").to_numpy().astype(np.int64) * (1 << 32) + bins
        return one.drop_columns(["part"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets))

    return (pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
            .groupBy("part")
            .applyInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.save(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
