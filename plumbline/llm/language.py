"""Language identification: unigram pieces per language, summed over all segmentations of each word."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import fold_of

#: Runs of letters with their marks.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MARK = "▁"  # the vocabulary's sign for the start of a word
CHUNK = 24  # longer words are scored in parts of so many characters
_MIX = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str) -> list[str]:
    """The pieces of a public sentencepiece model, without control and byte pieces, as text for tasks."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


class Lattice:
    """Finds every piece at every position of many words of one length at once."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        by_length: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for i, p in enumerate(pieces):
            if len(p) <= CHUNK + 1:
                by_length[len(p)].append((i, p))
        self.tables = {}
        for n, mine in sorted(by_length.items()):
            h = np.zeros(len(mine), np.uint64)
            codes = np.array([[ord(c) for c in p] for _, p in mine], np.uint64)
            for k in range(n):
                h = self.add(h, codes[:, k])
            order = np.argsort(h)
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.tables[n] = h[order], np.array([i for i, _ in mine])[order], seen

    @staticmethod
    def add(h: np.ndarray, code: np.ndarray) -> np.ndarray:
        h = (h ^ code) * _MIX
        return h ^ (h >> np.uint64(29))

    def matches(self, codes: np.ndarray):
        """(start, length, rows, piece ids) for words given as rows of code points."""
        width = codes.shape[1]
        for s in range(width):
            h = np.zeros(len(codes), np.uint64)
            for n in range(1, width - s + 1):
                h = self.add(h, codes[:, s + n - 1])
                if n not in self.tables:
                    continue
                known, ids, seen = self.tables[n]
                rows = np.flatnonzero(seen[h >> np.uint64(44)])
                if len(rows):
                    at = np.searchsorted(known, h[rows])
                    at[at == len(known)] = 0
                    hit = known[at] == h[rows]
                    if hit.any():
                        yield s, n, rows[hit], ids[at[hit]]


def _by_length(words: list[str]):
    """(indexes, code matrix) per length of the parts that words are scored in."""
    groups: dict[int, tuple[list[int], list[str]]] = {}
    for i, w in enumerate(words):
        w = MARK + w
        for k in range(0, len(w), CHUNK):
            part = w[k:k + CHUNK]
            at, parts = groups.setdefault(len(part), ([], []))
            at.append(i)
            parts.append(part)
    for n, (at, parts) in groups.items():
        yield np.array(at), np.array(parts, f"<U{n}").view(np.uint32).reshape(-1, n).astype(np.uint64)


class _CountPieces:
    """Occurrences of all pieces at all positions of the words of each language: one row per language and piece a task."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces

    def __call__(self, batches):
        lattice, total = _lattice(self.pieces), {}
        for b in batches:
            words: dict[str, list[str]] = defaultdict(list)
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words[lang] += WORD.findall(text.lower())
            for lang, ws in words.items():
                total.setdefault(lang, np.zeros(lattice.size))
                unique, n = _unique(ws)
                for at, codes in _by_length(unique):
                    for _, _, rows, ids in lattice.matches(codes):
                        total[lang] += np.bincount(ids, n[at[rows]], lattice.size)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1), pa.string()), pa.array([-1, *at], pa.int64()), pa.array([0.0, *n[at]], pa.float64())], names=["lang", "piece", "n"])


def _unique(ws: list[str]):
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int64, len(ws))
    return list(index), np.bincount(ids, minlength=len(index)).astype(float)


_CACHE: dict[str, object] = {}


def _lattice(pieces: list[str]) -> Lattice:
    """The last vocabulary's lattice; another one's takes its place."""
    key = hashlib.sha256("\n".join(pieces).encode()).hexdigest()
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Lattice(pieces)
    return _CACHE[key]


def fit(docs: DataFrame, pieces: list[str], smooth: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities [pieces + 1, languages]) from all rows of (lang, text) without NULLs.

    A piece's count in a language is its number of occurrences at any position of any word, whether or not they belong
    to one segmentation; it is not an expected count over segmentations. The last row is the probability of a
    character that no piece covers. The result has one row per language and piece of the fixed vocabulary, whatever
    the corpus' size; that is what the driver gets.
    """
    counts = docs.select("lang", "text").where("lang is not null and text is not null").mapInArrow(_CountPieces(pieces), "lang string, piece long, n double")
    got = counts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    c = np.full((len(pieces) + 1, len(langs)), smooth)
    known = got[got["piece"] >= 0]
    c[known["piece"].to_numpy(), np.searchsorted(langs, known["lang"].to_numpy())] += known["n"].to_numpy() if len(known) else 0
    return langs, c / c.sum(0) if langs else c


class _Score:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        pieces, langs, prob = self.model.value
        lattice, index, logp = _lattice(pieces), {}, np.zeros((0, len(langs)))
        for b in batches:
            if len(index) > 300_000:
                index, logp = {}, logp[:0]
            new: list[str] = []

            def number(w: str) -> int:
                i = index.get(w)
                if i is None:
                    i = index[w] = len(index)
                    new.append(w)
                return i

            pred, score, at = [], [], []
            for x in b.column(1):
                ws = WORD.findall((x.as_py() or "").lower())
                at.append(np.fromiter(map(number, ws), np.int64, len(ws)))
            logp = np.concatenate([logp, self.words(lattice, new, prob)])
            for ids in at:
                if not len(ids) or not langs:
                    pred.append("und")
                    score.append(0.0)
                    continue
                total = logp[ids].sum(0)
                best = int(total.argmax())
                pred.append(langs[best])
                score.append(1.0 / float(np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[b.schema.names[0], "lang_pred", "score"])

    @staticmethod
    def words(lattice: Lattice, new: list[str], prob: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations, [words, languages]: the forward algorithm over columns."""
        out = np.zeros((len(new), prob.shape[1]))
        for at, codes in _by_length(new):
            for lo in range(0, len(at), 1 << 14):
                part = codes[lo:lo + (1 << 14)]
                n, width = part.shape
                forward = np.zeros((width + 1, n, prob.shape[1]))
                forward[0] = 1.0
                by_start: dict[int, list] = defaultdict(list)
                for s, length, rows, ids in lattice.matches(part):
                    by_start[s].append((length, rows, ids))
                for s in range(width):
                    bare = np.ones(n, bool)
                    for length, rows, ids in by_start[s]:
                        forward[s + length, rows] += forward[s, rows] * prob[ids]
                        if length == 1:
                            bare[rows] = False
                    if bare.any():
                        forward[s + 1, bare] += forward[s, bare] * prob[-1]
                np.add.at(out, at[lo:lo + (1 << 14)], np.log(np.maximum(forward[width], 1e-300)))
        return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], pieces: list[str]) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text: the language of the largest likelihood and its posterior.

    All languages are alike beforehand; equal likelihoods go to the first by code point. NULL, empty and letterless
    texts are ``und`` with score 0, as is every text when no language was learned. No row meets another.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((pieces, *model))
    return docs.select("doc_id", "text").mapInArrow(_Score(sent), docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double"))


def predictions(docs: DataFrame, vocabulary_path: str, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict every row: doc_id, held_out, lang_pred, score."""
    pieces = vocabulary(vocabulary_path)
    model = fit(docs.where(fold_of(F.col("doc_id"), folds) != held), pieces)
    return identify(docs, model, pieces).select("doc_id", (fold_of(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score")

