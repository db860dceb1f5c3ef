"""Operator 3: token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at a position;
dynamic programming carries the best score and its number of pieces, nothing else. Tie rules are
those of the public tokenizers' Viterbi search: starts are tried in ascending order and a later
one must score strictly more, so of equal scores the longest last piece wins; a character without
a piece of its own may be an unknown one, at the lowest vocabulary score less 10, and counts as
its UTF-8 bytes where the vocabulary has byte pieces (else a run of unknown ones counts as one).
Scores add up in double precision.

No piece spans a place where a space sign follows another character, nor a character that is part
of no longer piece, so a text falls into independent chunks there (both facts are read from the
vocabulary). Equal chunks are counted once per task and kept in a bounded table. Each row is
handled alone: no shuffle, no group, no hot key. Null and empty texts have 0 tokens; repeated rows are
counted each; an empty table gives no rows. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import table

#: Space sign of the vocabulary; chunks remembered per task; a chunk longer than this is not kept.
SPACE, REMEMBERED, KEPT_CHARS = "▁", 400_000, 64
#: Score below the vocabulary's lowest that an unknown character has.
UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """Counts pieces of the best segmentation. ``pieces``: piece -> score, matched in texts;
    ``lowest``: lowest score of the whole vocabulary; ``byte_pieces``: unknown characters count as
    bytes; ``dummy_prefix``: a space sign is put before a text."""

    def __init__(self, pieces: dict[str, float], lowest: float | None = None, byte_pieces: bool = True,
                 dummy_prefix: bool = True):
        import ahocorasick

        self.unknown = (min(pieces.values()) if lowest is None else lowest) - UNKNOWN_PENALTY
        self.pieces, self.byte_pieces, self.dummy_prefix = pieces, byte_pieces, dummy_prefix
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        joined = sorted({c for p in pieces if len(p) > 1 for c in p} - {SPACE})
        inner = "".join(map(re.escape, joined))
        # a chunk: space signs and the joinable characters after them, or one other character
        self.chunk = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|." if inner else f"{SPACE}+|.", re.DOTALL)
        self.whole = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.kept: dict[str, int] = {}

    @classmethod
    def from_sentencepiece(cls, path: str) -> UnigramCounter:
        """Ordinary pieces and scores of a sentencepiece model file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        return cls(scores, min(scores.values()), any(model.is_byte(i) for i in ids))

    def count_chunk(self, chunk: str) -> int:
        """Pieces of the best segmentation of one chunk."""
        size = len(chunk)
        best: list[float | None] = [None] * (size + 1)
        count, unknown_end = [0] * (size + 1), [False] * (size + 1)
        best[0] = 0.0
        matches = self.automaton.iter(chunk)
        last, found = next(matches, (size, None))
        for end in range(size):
            top, pieces, unknown = None, 0, False
            single = False
            while last == end:
                length, score = found
                single = single or length == 1
                value = best[end + 1 - length] + score
                if top is None or value > top:
                    top, pieces = value, count[end + 1 - length] + 1
                last, found = next(matches, (size, None))
            if not single:
                value = best[end] + self.unknown
                if top is None or value > top:
                    top, unknown = value, True
                    if self.byte_pieces:
                        pieces = count[end] + len(chunk[end].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = count[end] + (not unknown_end[end])
            best[end + 1], count[end + 1], unknown_end[end + 1] = top, pieces, unknown
        return count[size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        if self.whole or not self.byte_pieces:  # chunks are not independent
            return self.count_chunk(text)
        kept, total = self.kept, 0
        for chunk in self.chunk.findall(text):
            n = kept.get(chunk)
            if n is None:
                n = self.count_chunk(chunk)
                if len(chunk) <= KEPT_CHARS:
                    if len(kept) >= REMEMBERED:
                        kept.clear()
                    kept[chunk] = n
            total += n
        return total


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens of every row of ``docs`` (doc_id, text); ``model_path``: a sentencepiece
    vocabulary file that every executor can read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter.from_sentencepiece(model_path)
        for batch in batches:
            counts = [counter.count(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
