"""Language identification of mixed text: script ranges narrow the candidates, Viterbi labels the words.

Every learned language has log probabilities of letter trigrams (with word edges) and the scripts that it uses. A word scores each
language by its trigrams; languages that do not use the word's script are no candidates. The best
labelling of a text's words under a penalty for each change of language is found exactly: texts are cut into blocks, blocks
are reduced to score matrices side by side, the matrices are chained, and each block is then traced back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textops import slices

# Fixed code point ranges of scripts, from the Unicode block chart.
SCRIPT_RANGES = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x3FFFF),
)
SCRIPTS = ("other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))
TOP = 0x40000
IMPOSSIBLE = np.float32(-1e4)


@dataclass(frozen=True)
class LanguageId:
    grams: int = 1 << 15
    most_languages: int = 200
    script_share: float = 0.01
    switch_penalty: float = 12.0
    block_words: int = 256


class Letters:
    """Per code point: its lower case if it is a letter, else 0, and its script."""

    def __init__(self):
        lower = np.zeros(TOP, np.uint32)
        for code in range(TOP):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                lower[code] = ord(low) if len(low) == 1 else code
        self.lower = lower
        self.script = np.zeros(TOP, np.uint8)
        for name, first, last in SCRIPT_RANGES:
            self.script[first : last + 1] = SCRIPTS.index(name)


class LetterWords:
    """Runs of letters: trigram code and script of each letter, first letter of each word, first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: Letters, grams: int):
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        self.row_code = lead[offsets]
        low = letters.lower[np.minimum(codes, TOP - 1)]
        at = np.flatnonzero(low)
        cut = np.zeros(len(codes) + 1, bool)
        cut[self.row_code] = True
        begins = np.ones(len(at), bool)
        begins[1:] = (at[1:] != at[:-1] + 1) | cut[at[1:]]
        ends = np.ones(len(at), bool)
        ends[:-1] = begins[1:]
        own = low[at]
        before, after = np.zeros(len(at), np.uint32), np.zeros(len(at), np.uint32)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[begins] = 0
        after[ends] = 0
        code = (before * np.uint32(0x9E3779B1)) ^ (own * np.uint32(0x85EBCA77)) + (after * np.uint32(0xC2B2AE3D))
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(13)
        self.gram = code % np.uint32(grams)
        self.script = letters.script[np.minimum(codes[at], TOP - 1)]
        self.begin = np.flatnonzero(begins)  # in letters
        self.length = np.diff(np.append(self.begin, len(at)))
        self.begin_code = at[self.begin]
        self.first = np.searchsorted(self.begin_code, self.row_code)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))


class Model:
    """Languages, log probabilities (grams x languages), and which scripts each language uses (scripts x languages)."""

    def __init__(self, languages: list[str], gram_counts: np.ndarray, script_counts: np.ndarray, params: LanguageId):
        self.languages, self.params = languages, params
        total = gram_counts.sum(0, keepdims=True)
        self.log = np.log((gram_counts + 0.5) / (total + 0.5 * len(gram_counts))).astype(np.float32)
        share = script_counts / np.maximum(script_counts.sum(0, keepdims=True), 1)
        self.uses = share >= params.script_share

    def word_scores(self, words: LetterWords) -> np.ndarray:
        scores = np.empty((len(words.begin), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            scores[:, k] = np.add.reduceat(self.log[:, k][words.gram], words.begin)
        able = self.uses[words.script[words.begin]]
        able |= ~able.any(1, keepdims=True)  # a script that no language uses rules nothing out
        scores[~able] = IMPOSSIBLE
        return scores


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float, block: int) -> np.ndarray:
    """Best label of every word; row r holds words first[r] to first[r + 1]. On ties a text stays in its language."""
    n_words, n = scores.shape
    labels = np.zeros(n_words, np.int64)
    lengths = np.diff(first)
    blocks = -(-lengths // block)
    if not n_words or n == 1:
        return labels
    row_block = np.concatenate([[0], np.cumsum(blocks)])  # first block of each row
    number = np.arange(row_block[-1]) - np.repeat(row_block[:-1], blocks)
    begin = np.repeat(first[:-1], blocks) + number * block
    size = np.minimum(block, np.repeat(first[1:], blocks) - begin)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, size.max() + 1), "right")  # blocks longer than t, as a prefix of order
    penalty = np.float32(penalty)
    change = np.where(np.eye(n, dtype=bool), np.float32(0), -penalty)

    value = np.tile(change, (len(begin), 1, 1))
    for t, m in enumerate(active):
        part = order[:m]
        now = scores[begin[part] + t][:, None, :]
        if t:
            best = value[:m].max(2, keepdims=True) - penalty
            value[:m] = np.maximum(value[:m], best) + now
        else:
            value = value[order] + now
    matrices = np.empty_like(value)
    matrices[order] = value

    enter = np.zeros((len(lengths), n), np.float32)
    came = np.zeros((len(begin), n), np.int64)
    for k in range(blocks.max()):
        rows = np.flatnonzero(blocks > k)
        own = row_block[rows] + k
        through = enter[rows][:, :, None] + matrices[own]
        came[own] = through.argmax(1)
        enter[rows] = through.max(1)
    state = enter.argmax(1)
    start, end = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    for k in range(blocks.max() - 1, -1, -1):
        rows = np.flatnonzero(blocks > k)
        own = row_block[rows] + k
        end[own] = state[rows]
        start[own] = state[rows] = came[own, state[rows]]

    back = np.zeros((len(active), len(begin), n), np.uint8)
    value = change[start[order]]
    same = np.arange(n, dtype=np.uint8)
    for t, m in enumerate(active):
        now = scores[begin[order[:m]] + t]
        if t:
            held = value[:m]
            best = held.max(1, keepdims=True) - penalty
            back[t, :m] = np.where(held >= best, same, held.argmax(1).astype(np.uint8)[:, None])
            value[:m] = np.maximum(held, best) + now
        else:
            value = value + now
    state = end[order]
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        labels[begin[order[:m]] + t] = state[:m]
        if t:
            state[:m] = back[t, np.arange(m), state[:m]]
    return labels


def _count_rows(languages: list[str], params: LanguageId):
    """(lang, text) to (language, slot, n): trigram counts, and script counts in slots after the trigrams."""
    place = {name: k for k, name in enumerate(languages)}
    slots = params.grams + len(SCRIPTS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        counts = np.zeros(len(languages) * slots, np.int64)
        for batch in batches:
            owner = np.array([place[name] for name in batch.column(0).to_pylist()], np.int64)
            for first, last, data, offsets in slices(batch.column(1)):
                words = LetterWords(data, offsets, letters, params.grams)
                own = np.repeat(owner[first:last][words.row] * slots, words.length)
                counts += np.bincount(own + words.gram, minlength=len(counts))
                counts += np.bincount(own + params.grams + words.script, minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held // slots), pa.array(held % slots), pa.array(counts[held])], ["language", "slot", "n"])

    return rows


def learn(docs: DataFrame, params: LanguageId = LanguageId(), text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from all rows with text and language; None without any. More than `most_languages` languages are an error: none is left out.

    The counts that reach the driver are bounded: one number for each language and slot.
    """
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    languages = sorted(row["lang"] for row in known.select("lang").distinct().limit(params.most_languages + 1).collect())
    if len(languages) > params.most_languages:
        raise ValueError(f"more than {params.most_languages} languages to learn")
    if not languages:
        return None
    counts = known.mapInArrow(_count_rows(languages, params), "language long, slot long, n long")
    table = np.zeros((params.grams + len(SCRIPTS), len(languages)))
    for row in counts.groupBy("language", "slot").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row["slot"], row["language"]] = row["n"]
    return Model(languages, table[: params.grams], table[params.grams :], params)


RESULT = "doc_id {id}, lang_pred string, score double, spans array<struct<begin:int,end:int,lang:string>>"


def _label_rows(shared):
    span_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def label(model: Model, words: LetterWords, rows: int):
        n = len(model.languages)
        labels = viterbi(model.word_scores(words), words.first, model.params.switch_penalty, model.params.block_words)
        letters = np.bincount(words.row * n + labels, weights=words.length, minlength=rows * n).reshape(rows, n)
        total = letters.sum(1)
        best = letters.argmax(1)
        score = letters[np.arange(rows), best] / np.maximum(total, 1)
        new = np.ones(len(labels), bool)
        new[1:] = (labels[1:] != labels[:-1]) | (words.row[1:] != words.row[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(labels)) - 1
        shift = words.row_code[words.row[head]]
        spans = pa.StructArray.from_arrays(
            [
                pa.array((words.begin_code[head] - shift).astype(np.int32)),
                pa.array((words.begin_code[tail] + words.length[tail] - shift).astype(np.int32)),
                pa.array([model.languages[k] for k in labels[head]], pa.string()),
            ],
            fields=list(span_type.value_type),
        )
        ends = np.searchsorted(words.row[head], np.arange(rows + 1)).astype(np.int32)
        names = [model.languages[k] if some else "und" for k, some in zip(best.tolist(), (total > 0).tolist())]
        return names, score, pa.ListArray.from_arrays(pa.array(ends), spans)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = shared.value, Letters()
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                n = last - first
                words = LetterWords(data, offsets, letters, model.params.grams) if model else None
                if words is None or not len(words.begin):
                    names, score, spans = ["und"] * n, np.zeros(n), pa.array([[]] * n, span_type)
                else:
                    names, score, spans = label(model, words, n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(names, pa.string()), pa.array(score), spans.cast(span_type)], ["doc_id", "lang_pred", "score", "spans"])

    return rows


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans) for every row of docs; spans are code point ranges of one language each.

    lang_pred is the language with most letters, the first by name of equals, and score its share of the letters.
    Null texts and texts without a letter are `und` with score 0 and no spans; so is every text if there is no model.
    Rows are judged one by one, so repeated rows and null ids need no rule; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = RESULT.format(id=docs.schema[id_col].dataType.simpleString())
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(_label_rows(shared), schema)
