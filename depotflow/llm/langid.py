"""Languages of the spans of mixed-language texts.

Character trigrams of words (runs of letters, lower-cased) are counted per language over all
documents to learn from. A word's score for a language is the sum of its trigrams'
log-probabilities. The scripts of a word's letters narrow its candidates to the languages that
write in them. Viterbi finds the best sequence of languages over the words, where each switch
costs a penalty, and so labels spans; the language with most letters is the document's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import held_out, map_batches, merge_counters
from depotflow.llm.textarrays import code_points, letter_runs, letter_table, slices

HASH_BITS = 16
SWITCH_PENALTY = 8.0
#: A language is a candidate for a script if so much of its letters is in it.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"

# --- fixed values: first code points of ranges of scripts; the name holds up to the next one
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"),
    (0x0B80, "Tamil"), (0x0C00, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"),
    (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)

_FIRST = np.array([first for first, _ in SCRIPT_RANGES], np.uint32)
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])


def script_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_FIRST, points, side="right") - 1]


def _trigrams(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the letters, and the hash of the trigram around each; other signs are alike."""
    clean = np.where(letter_table()[flat], flat, 0).astype(np.uint32)
    at = np.flatnonzero(clean)
    around = np.concatenate((np.zeros(1, np.uint32), clean, np.zeros(1, np.uint32)))
    mixed = (around[at] * np.uint32(0x01000193) ^ around[at + 1]) * np.uint32(0x01000193) ^ around[at + 2]
    return at, ((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)).astype(np.int64)


#: Words of the longest text times texts times languages that are decided at once.
_CELLS = 4_000_000


@dataclass
class LanguageModel:
    """Log-probabilities by trigram and language, and which languages write in which script."""

    languages: list[str]
    logs: np.ndarray
    candidates: np.ndarray

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of all texts: text, start and end in it, and language, plus (text, language)
        letter counts."""
        flat, bounds = code_points(texts)
        starts, ends = letter_runs(flat)
        count = len(self.languages)
        letters = np.zeros((len(texts), count), np.int64)
        if not len(starts) or not count:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty, letters
        at, grams = _trigrams(flat)
        first = np.searchsorted(at, starts)
        scores = np.add.reduceat(self.logs[grams], first, axis=0)
        allowed = np.minimum.reduceat(self.candidates[script_of(flat[at])], first, axis=0)
        allowed |= ~allowed.any(axis=1, keepdims=True)
        scores = np.where(allowed, scores, scores - np.float32(1e4))
        owner = np.searchsorted(bounds, starts, side="right") - 1
        path = _viterbi(scores, owner, len(texts), SWITCH_PENALTY)
        np.add.at(letters, (owner, path), ends - starts)
        return owner, starts - bounds[owner], ends - bounds[owner], path, letters


def _viterbi(scores: np.ndarray, owner: np.ndarray, texts: int, penalty: float) -> np.ndarray:
    """The best languages of the words of many texts, by groups of texts of like length."""
    per_text = np.bincount(owner, minlength=texts)
    group = np.zeros(texts, np.int64)
    number = held = 0
    for text in np.argsort(per_text, kind="stable").tolist():
        if held and (held + 1) * int(per_text[text]) * scores.shape[1] > _CELLS:
            number, held = number + 1, 0
        group[text] = number
        held += 1
    of_word = group[owner]
    order = np.argsort(of_word, kind="stable")
    path = np.empty(len(owner), np.int64)
    for words in np.split(order, np.flatnonzero(np.diff(of_word[order])) + 1):
        own = owner[words]
        path[words] = _viterbi_together(scores[words], np.cumsum(np.diff(own, prepend=own[0]) > 0), penalty)
    return path


def _viterbi_together(scores: np.ndarray, owner: np.ndarray, penalty: float) -> np.ndarray:
    """The same for texts at once, one word of each text a step."""
    per_text = np.bincount(owner)
    texts = len(per_text)
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    place = np.arange(len(owner)) - first[owner]
    steps, count = int(per_text.max()), scores.shape[1]
    padded = np.zeros((steps, texts, count), np.float32)
    padded[place, owner] = scores
    stay = np.zeros((steps, texts, count), bool)
    jump = np.zeros((steps, texts), np.int8 if count < 128 else np.int32)
    best = padded[0].copy()
    for t in range(1, steps):
        top = best.argmax(axis=1)
        switched = best.max(axis=1)[:, None] - np.float32(penalty)
        stay[t] = best >= switched
        jump[t] = top
        best = np.maximum(best, switched)
        best -= best.max(axis=1, keepdims=True)
        best += padded[t]
    state = best.argmax(axis=1)
    path = np.zeros((steps, texts), np.int64)
    rows = np.arange(texts)
    for t in range(steps - 1, -1, -1):
        path[t] = state
        state = np.where(stay[t, rows, state], state, jump[t])
    return path[place, owner]


def fit_languages(docs: DataFrame, learnable: F.Column | None = None) -> LanguageModel:
    """Counts trigrams and scripts of all documents with a language (and ``learnable``).

    The model has one row per distinct language; a column of thousands of labels is not meant.
    """
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    known = known.filter("lang IS NOT NULL AND text IS NOT NULL")
    if learnable is not None:
        known = known.filter(learnable)
    languages = sorted(row[0] for row in known.select("lang").distinct().collect())
    width = (1 << HASH_BITS) + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(languages)}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                into = totals.setdefault(number[lang], np.zeros(width, np.int64))
                for part in slices([len(t) for t in mine], 2_000_000):
                    flat, _ = code_points([mine[i] for i in part])
                    at, grams = _trigrams(flat)
                    into[: 1 << HASH_BITS] += np.bincount(grams, minlength=1 << HASH_BITS)
                    into[1 << HASH_BITS :] += np.bincount(script_of(flat[at]), minlength=len(SCRIPTS))
        for slot, values in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int64()), pa.array([values.tobytes()], pa.binary())], ["slot", "data"]
            )

    parts = known.select("text", "lang").mapInArrow(count, "slot bigint, data binary")
    logs = np.zeros((1 << HASH_BITS, len(languages)), np.float32)
    candidates = np.zeros((len(SCRIPTS), len(languages)), bool)
    for slot, data in merge_counters(parts, width).collect():  # one row per language
        counts = np.frombuffer(data, np.int64)
        grams, scripts = counts[: 1 << HASH_BITS], counts[1 << HASH_BITS :]
        logs[:, slot] = np.log((grams + 0.5) / (grams.sum() + 0.5 * len(grams)))
        candidates[:, slot] = scripts >= max(1.0, SCRIPT_SHARE * scripts.sum())
    return LanguageModel(languages, logs, candidates)


def language_spans(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, span, start, end, lang): the spans of one language, by place in the lower-cased text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, ids, out = batch.column(1).to_pylist(), batch.column(0).to_pylist(), []
            for part in slices([len(t or "") for t in texts], 1_000_000):
                owner, starts, ends, path, _ = fitted.label([texts[i] for i in part])
                if not len(owner):
                    continue
                new = np.flatnonzero(np.diff(owner, prepend=-1) | np.diff(path, prepend=-1))
                last = np.concatenate((new[1:], [len(owner)])) - 1
                span = 0
                for a, b in zip(new.tolist(), last.tolist(), strict=True):
                    span = 0 if a == 0 or owner[a] != owner[a - 1] else span + 1
                    out.append((ids[part[owner[a]]], span, int(starts[a]), int(ends[b]), fitted.languages[path[a]]))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            names = ["doc_id", "span", "start", "end", "lang"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        return step

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return map_batches(rows, make, "doc_id bigint, span int, start bigint, end bigint, lang string")


def document_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    The score is the share of the text's letters that are in spans of the predicted language.
    Texts that are NULL or have no letter are ``und`` with score 0, as is every text if nothing
    was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 256 KB per language

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(2).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for part in slices([len(t or "") for t in texts], 1_000_000):
                letters = fitted.label([texts[i] for i in part])[4]
                if not letters.shape[1]:
                    continue
                total, best = letters.sum(axis=1), letters.argmax(axis=1)
                for k, i in enumerate(part):
                    if total[k]:
                        names[i], scores[i] = fitted.languages[best[k]], letters[k, best[k]] / total[k]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

        return step

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select("doc_id", held_out(4, 2).alias("held_out"), "text")
    return map_batches(rows, make, "doc_id bigint, held_out boolean, lang_pred string, score double")
