"""Operator 9: language identification by a bidirectional gated recurrent network over bytes.

The network is trained here in numpy by backpropagation through time on a bounded sample, on the
driver: of each language whole documents in the order of a hash of their id, until ``TRAIN_BYTES``
are held. Prediction reads every byte of every whole text: a sequence is a word (a run of bytes
between ASCII spaces, A-Z lower-cased, the punctuation that ends it cut off) between two space
bytes, both directions start at its ends, every position gets log probabilities of all languages,
and a document pools the mean over all its positions. Equal sequences get equal outputs, so a task
runs each once and remembers it in a bounded table. Rows are handled alone: no shuffle.

lang, source and doc_id are never inputs. Texts that are null or have no letter are ``und`` with
score 0; a table without labelled rows gives ``und`` everywhere; null languages are not learnt;
repeated rows are labelled each and learnt once; ties take the first language in order; an empty
table gives no rows. Only doc_id, text and, to learn, lang are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Bytes of text learnt per language and of documents looked at; units per direction; training steps, batch, rate.
TRAIN_BYTES, SAMPLE_DOCS, HIDDEN, STEPS, BATCH, RATE, SEED = 400_000, 400, 16, 500, 256, 0.02, 7
#: Parts of the hash of an id by which the training sample is drawn.
SPOTS = 1 << 40
#: Longest sequence in bytes (a longer word is cut into more), sequences remembered by a task.
LONGEST, REMEMBERED = 24, 400_000
#: Sequences looked up at once.
TOGETHER = 1 << 15

_END = re.compile(rb"(?<=[a-z\x80-\xff])[!-&(-/:-@\[-`{-~]+(?=\s|\Z)")
_LETTER = re.compile(r"[^\W\d_]")
_SPACE = 32


def sequences(text: bytes) -> list[bytes]:
    """Words of a text; long ones in parts."""
    words = _END.sub(b"", text.lower()).split()
    if max(map(len, words), default=0) > LONGEST:
        words = [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes by position, one column per word, between spaces; lengths)."""
    lengths = np.array([len(w) + 2 for w in words])
    wide = int(lengths.max())
    flat = np.frombuffer(b"".join(b" " + w + b" " * (wide - 1 - len(w)) for w in words), np.uint8)
    return flat.reshape(len(words), wide).T.astype(np.int64), lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class ByteGru:
    """Two gated recurrent layers (one per direction) and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        h, n = hidden, len(languages)
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)  # byte -> update, reset, new
            self.p[f"u{d}"] = rng.normal(0, h ** -0.5, (h, 2 * h)).astype(np.float32)
            self.p[f"v{d}"] = rng.normal(0, h ** -0.5, (h, h)).astype(np.float32)
        self.p["o"] = rng.normal(0, 0.1, (2 * h, n)).astype(np.float32)
        self.p["c"] = np.zeros(n, np.float32)

    def _forward(self, seq: np.ndarray, live: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States after each position (in reading order of the direction) and what training needs."""
        h, (steps, size) = self.hidden, seq.shape
        state = np.zeros((size, h), np.float32)
        states, kept = np.empty((steps, size, h), np.float32), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            x = self.p[f"x{d}"][seq[t]]
            gates = _sigmoid(x[:, :2 * h] + state @ self.p[f"u{d}"])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h:] + (r * state) @ self.p[f"v{d}"])
            mask = live[t][:, None]
            after = np.where(mask, (1 - z) * state + z * new, state)
            kept.append((t, state, z, r, new, mask))
            states[t] = state = after
        return states, kept

    def log_probabilities(self, seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Position x word x language; positions past a word's end are 0."""
        live = np.arange(len(seq))[:, None] < lengths[None, :]
        both = np.concatenate([self._forward(seq, live, d)[0] for d in "fb"], axis=2)
        logits = both @ self.p["o"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return np.where(live[:, :, None], logits, 0)

    def gradients(self, seq: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of all positions and its gradients, by backpropagation through time."""
        h, (steps, size) = self.hidden, seq.shape
        live = np.arange(steps)[:, None] < lengths[None, :]
        runs = {d: self._forward(seq, live, d) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        logits = both @ self.p["o"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        total = live.sum()
        chosen = prob[:, np.arange(size), target]
        loss = float(-(np.log(np.maximum(chosen, 1e-9)) * live).sum() / total)
        err = prob.copy()
        err[:, np.arange(size), target] -= 1
        err *= (live / total)[:, :, None].astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["o"] = np.einsum("tsh,tsn->hn", both, err, optimize=True)
        grad["c"] = err.sum(axis=(0, 1))
        back = err @ self.p["o"].T
        for i, d in enumerate("fb"):
            carry = np.zeros((size, h), np.float32)
            for t, before, z, r, new, mask in reversed(runs[d][1]):
                total_in = carry + back[t][:, i * h:(i + 1) * h]
                here = np.where(mask, total_in, 0)
                d_new = here * z * (1 - new ** 2)
                d_rs = d_new @ self.p[f"v{d}"].T
                d_gates = np.concatenate([here * (new - before) * z * (1 - z), d_rs * before * r * (1 - r)], axis=1)
                grad[f"v{d}"] += (r * before).T @ d_new
                grad[f"u{d}"] += before.T @ d_gates
                np.add.at(grad[f"x{d}"], seq[t], np.concatenate([d_gates, d_new], axis=1))
                carry = np.where(mask, here * (1 - z) + d_rs * r + d_gates @ self.p[f"u{d}"].T, total_in)
        return loss, grad

    def fit(self, words: list[bytes], target: np.ndarray, weight: np.ndarray, steps: int = STEPS,
            batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> list[float]:
        """Adam on batches drawn by weight; returns the losses."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        share, losses = weight / weight.sum(), []
        for step in range(1, steps + 1):
            pick = rng.choice(len(words), size=batch, p=share)
            seq, lengths = padded([words[i] for i in pick])
            loss, grad = self.gradients(seq, lengths, target[pick])
            losses.append(loss)
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= (now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return losses


class Scorer:
    """Sums of log probabilities per remembered sequence, pooled per document."""

    def __init__(self, model: ByteGru):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.sums = np.zeros((1 << 12, len(self.model.languages)))
        self.positions = np.zeros(1 << 12)

    def _learn(self, words: list[bytes]) -> None:
        """Runs new, different words through the network."""
        new = sorted(words, key=len)
        while len(self.code) + len(new) > len(self.positions):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.positions = np.concatenate([self.positions, np.zeros_like(self.positions)])
        for at in range(0, len(new), 2048):
            part = new[at:at + 2048]
            seq, lengths = padded(part)
            codes = np.arange(len(self.code), len(self.code) + len(part))
            self.sums[codes] = self.model.log_probabilities(seq, lengths).sum(axis=0)
            self.positions[codes] = lengths
            self.code.update(zip(part, codes.tolist(), strict=True))

    def _codes(self, words: list[bytes]) -> np.ndarray:
        get = self.code.get
        codes = [get(w, -1) for w in words]
        if -1 in codes:
            new = list(dict.fromkeys(w for w, c in zip(words, codes, strict=True) if c < 0))
            if len(self.code) + len(new) > REMEMBERED:
                self._clear()
                codes, new = [-1] * len(words), list(dict.fromkeys(words))
            self._learn(new)
            get = self.code.__getitem__
            codes = [get(w) if c < 0 else c for w, c in zip(words, codes, strict=True)]
        return np.array(codes, dtype=np.int64)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Language probabilities of every text: the normalised mean of all its positions."""
        many = len(self.model.languages)
        total, positions = np.zeros((len(texts), many)), np.zeros(len(texts))
        words: list[bytes] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            own = sequences(text)
            for at in range(0, len(own), TOGETHER):
                part = own[at:at + TOGETHER]
                words += part
                owner += [i] * len(part)
                if len(words) >= TOGETHER:
                    self._add(words, owner, total, positions)
                    words, owner = [], []
        if words:
            self._add(words, owner, total, positions)
        mean = total / np.maximum(positions, 1)[:, None]
        prob = np.exp(mean - mean.max(axis=1, keepdims=True))
        return prob / prob.sum(axis=1, keepdims=True)

    def _add(self, words: list[bytes], owner: list[int], total: np.ndarray, positions: np.ndarray) -> None:
        codes, rows = self._codes(words), np.array(owner)
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        total[rows[first]] += np.add.reduceat(self.sums[codes], first, axis=0)
        positions[rows[first]] += np.add.reduceat(self.positions[codes], first)


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % 5 == 0


def training_words(docs: DataFrame, train_bytes: int = TRAIN_BYTES, sample: int = SAMPLE_DOCS) -> dict[str, Counter]:
    """Word counts per language of a bounded sample of documents that are not held out.

    Sizes of about twice ``sample`` documents per language (an expected number) come to the driver first; only the texts
    chosen by them follow, so it never holds more than ``train_bytes`` of a language, or one longer text. Three scans in
    all. Of rows with one doc_id the shortest text stands for all."""
    usable = docs.where(~held_out()).where("lang is not null and text is not null").select(
        "lang", F.xxhash64("doc_id", F.lit("language")).alias("spot"), F.octet_length("text").alias("size"), "text")
    rows = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not rows:
        return {}
    limits = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, int(min(1.0, 2 * sample / n) * SPOTS) + 1)])
    some = usable.where(F.pmod("spot", F.lit(SPOTS)) < limits[F.col("lang")])
    chosen: dict[str, set[int]] = {lang: set() for lang in rows}
    seen, held = Counter(), Counter()
    for lang, spot, size in sorted(map(tuple, some.groupBy("lang", "spot").agg(F.min("size")).collect())):
        seen[lang] += 1
        if seen[lang] <= sample and (not held[lang] or held[lang] + size <= train_bytes):
            held[lang] += size
            chosen[lang].add(spot)
    found: dict[str, Counter] = {lang: Counter() for lang in sorted(rows)}
    texts = (usable.where(F.col("spot").isin(sorted(set().union(*chosen.values()))))
             .groupBy("lang", "spot").agg(F.min(F.struct("size", "text")).alias("x")).select("lang", "spot", "x.text").orderBy("lang", "spot"))
    for row in texts.toLocalIterator():
        if row["spot"] in chosen[row["lang"]]:
            found[row["lang"]].update(sequences(row["text"].encode("utf-8", "surrogatepass")))
    return found


def train(docs: DataFrame) -> ByteGru | None:
    """The fitted network, or None without labelled rows."""
    counts = {k: v for k, v in training_words(docs).items() if v}
    if not counts:
        return None
    languages = sorted(counts)
    words = [w for k in languages for w in counts[k]]
    target = np.repeat(np.arange(len(languages)), [len(counts[k]) for k in languages])
    weight = np.concatenate([np.sqrt(np.array(list(counts[k].values()), float)) / np.sqrt(list(counts[k].values())).sum() for k in languages])
    model = ByteGru(languages)
    model.fit(words, target, weight)
    return model


def label_languages(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text); the network (some ten
    thousand numbers) goes with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [i for i, x in enumerate(texts) if model and x and _LETTER.search(x)]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if known:
                prob = scorer.pooled([texts[i].encode("utf-8", "surrogatepass") for i in known])
                for i, best, score in zip(known, prob.argmax(axis=1), prob.max(axis=1), strict=True):
                    names[i], scores[i] = model.languages[int(best)], float(score)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label_languages(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
