"""Language of documents: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

Learning: from rows with text and a language. Languages are learned from at most ``per_language`` documents each, chosen by a
hash of the id (whole texts; the bound is the one sample of this operator). Words are hashed as character n-grams into a fixed
number of buckets, and counts of buckets per language become smoothed log shares. The table has a fixed size and is all that
the tasks are given.

Prediction: a word's score for a language is the mean log share of its n-grams. A word's script (by range of its first
letter) keeps only the languages in which at least 1 % of the learned words have that script; a word in a script that no
language has scores nothing. Viterbi with a price for switching then labels every word, so that text in several languages falls
into spans. The document's language is the one that labels most letters, and ``score`` is its share of all letters.

* Null text, and text without letters: ``und``, score 0. Letters in unknown scripts only: the most frequent learned language,
  score 0. No learned language at all: ``und``. Ties go to the language that comes first in code point order.
* Long texts are labelled whole. Repeated rows are predicted alike. Ids, sources and given languages are no inputs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import batch_slices

BUCKETS = 1 << 16
#: bytes of text that are words at a time, words that are scored at a time, and words whose scores a task remembers
DECODED, SCORED, CACHED = 1 << 20, 1 << 12, 1 << 17
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_NEVER = -50.0

#: fixed values: first and last code point of scripts (Unicode blocks)
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F),)),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
)


def script_of(word: str) -> str:
    """Script of a word's first letter; ``other`` outside all ranges."""
    c = ord(word[0])
    for name, ranges in SCRIPTS:
        if any(a <= c <= b for a, b in ranges):
            return name
    return "other"


def buckets_of(word: str) -> list[int]:
    """Hashed n-grams of one to three characters, and the whole word, with marked ends."""
    framed = f"^{word}$"
    found = [framed]
    for n in (2, 3, 4):
        found += [framed[i : i + n] for i in range(len(framed) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in found]


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class Model:
    """Languages, log shares of buckets, the scripts of each language, and the most frequent language."""

    def __init__(self, langs: list[str], logs: np.ndarray, scripts: list[set[str]], common: int) -> None:
        self.langs, self.logs, self.scripts, self.common = langs, logs, scripts, common

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words by language, and whether any language uses the word's script; a few thousand words at a time."""
        parts = [self._score(words[i : i + SCORED]) for i in range(0, len(words), SCORED)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        buckets = [buckets_of(w) for w in words]
        sizes = np.fromiter(map(len, buckets), np.int64, len(words))
        sums = np.add.reduceat(self.logs[np.fromiter(chain.from_iterable(buckets), np.int64, int(sizes.sum()))], np.cumsum(sizes) - sizes, axis=0)
        scripts = [script_of(w) for w in words]
        of = {s: [s in have for have in self.scripts] for s in set(scripts)}
        allowed = np.array([of[s] for s in scripts])
        known = allowed.any(1)
        return np.where(allowed, sums / sizes[:, None], np.where(known, _NEVER, 0.0)[:, None]).astype(np.float32), known


def fit(labelled: DataFrame, per_language: int = 1500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from rows with text and language; see the module's text."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), [], 0)
    # a hash of the id below a share of its range: the same sample in every run, about per_language documents each
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, per_language / sizes[lang])))])
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(place < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, Counter] = {}
            for part in batch_slices([b], "text", DECODED):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by.items():
                table, scripts = np.zeros(BUCKETS, np.int64), Counter()
                for w, n in words.items():
                    np.add.at(table, buckets_of(w), n)
                    scripts[script_of(w)] += n
                at = np.flatnonzero(table)
                keys = [str(k) for k in at.tolist()] + list(scripts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array([*table[at].tolist(), *scripts.values()])], ["lang", "key", "n"])

    # at most BUCKETS rows and a few scripts for each language
    counted = sample.mapInArrow(count, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((BUCKETS, len(langs)))
    scripts: list[Counter] = [Counter() for _ in langs]
    at = {lang: i for i, lang in enumerate(langs)}
    for lang, key, n in zip(*(counted.column(i).to_pylist() for i in range(3))):
        if key.isdigit():
            table[int(key), at[lang]] = n
        else:
            scripts[at[lang]][key] = n
    logs = np.log((table + 0.1) / (table.sum(0) + 0.1 * BUCKETS))
    kept = [{s for s, n in c.items() if n >= 0.01 * c.total()} for c in scripts]
    return Model(langs, logs.astype(np.float32), kept, max(range(len(langs)), key=lambda i: (sizes[langs[i]], -i)))


class _Scores:
    """Row of each distinct word in one table of scores, which doubles when it is full."""

    def __init__(self, model: Model) -> None:
        self.model, self.row, size = model, {}, 1 << 12
        self._table, self._known, self._letters = np.zeros((size, len(model.langs)), np.float32), np.zeros(size, bool), np.zeros(size, np.int32)

    def rows(self, words: list[list[str]], n: int) -> np.ndarray:
        """Row of each of the n words, new ones added."""
        row, at = self.row, len(self.row)
        new = list({w for ws in words for w in ws if w not in row})
        if new:
            row.update(zip(new, range(at, at + len(new))))
            while len(self._known) < len(row):
                self._table, self._known, self._letters = (np.concatenate([x, np.zeros_like(x)]) for x in (self._table, self._known, self._letters))
            self._table[at : len(row)], self._known[at : len(row)] = self.model.score(new)
            self._letters[at : len(row)] = np.fromiter(map(len, new), np.int32, len(new))
        return np.fromiter(map(row.__getitem__, chain.from_iterable(words)), np.int32, n)

    table = property(lambda self: self._table[: len(self.row)])
    known = property(lambda self: self._known[: len(self.row)])
    letters = property(lambda self: self._letters[: len(self.row)])


def label_type(langs: int) -> np.dtype:
    """The smallest type that numbers so many languages."""
    return np.min_scalar_type(max(langs - 1, 0))


def one_language(rows: np.ndarray, lengths: np.ndarray, table: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """(language, certain) by document: the best single language, and whether no path with a switch can score more.

    A stretch in other languages gains at most the sum of what the best other language gains per word, and costs a switch at
    least. If no stretch gains more than that, the single language is the best path.
    """
    ends = np.cumsum(lengths)
    language, certain = np.zeros(len(lengths), np.int64), np.ones(len(lengths), bool)
    for d, (a, b) in enumerate(zip((ends - lengths).tolist(), ends.tolist())):
        if a < b:
            e = table[rows[a:b]].astype(np.float64)
            best = int(e.sum(0).argmax())
            language[d] = best
            if e.shape[1] > 1:
                own = e[:, best].copy()
                e[:, best] = -np.inf
                gained = np.cumsum(e.max(1) - own)
                low = np.minimum.accumulate(np.concatenate(([0.0], gained[:-1])))
                certain[d] = (gained - low).max() <= switch
    return language, certain


def viterbi(rows: np.ndarray, lengths: np.ndarray, table: np.ndarray, switch: float) -> np.ndarray:
    """Label of every word. ``rows`` are the words of all documents in order, ``lengths`` their numbers by document.

    All documents advance together, one word a step, the longest first; the state is one score per document and language.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    langs = table.shape[1]
    label = np.zeros(len(rows), label_type(langs))
    if not len(rows):
        return label
    # documents that still have a word at step t
    active = len(lengths) - np.searchsorted(sorted_lengths[::-1], np.arange(sorted_lengths[0]), side="right")
    best_from = np.zeros(len(rows), label.dtype)
    switched = np.zeros((len(rows), langs), bool)
    state = np.zeros((len(lengths), langs), np.float32)
    for t, n in enumerate(active.tolist()):
        at = starts[:n] + t
        now = state[:n]
        first = now.argmax(1)
        most = now[np.arange(n), first] - switch
        jump = now < most[:, None]
        best_from[at], switched[at] = first, jump
        now = np.where(jump, most[:, None], now) + table[rows[at]]
        state[:n] = now - now.max(1, keepdims=True)
    last = state.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        at = starts[:n] + t
        label[at] = last[:n]
        jumped = switched[at, last[:n]]
        last[:n] = np.where(jumped, best_from[at], last[:n])
    return label


def label_texts(parts: Iterable[list[str | None]], model: Model, scores: _Scores, switch: float) -> tuple[list[str], list[float], list[list[tuple[str, int]]], list[float]]:
    """Language, score, spans (language, words) and the share of letters in any language, of each text of all parts.

    Texts are cut into words a part at a time; what is kept of a word is a number.
    """
    numbers, sizes = [], []
    for texts in parts:
        words = [words_of(t) for t in texts]
        sizes += map(len, words)
        numbers.append(scores.rows(words, sum(map(len, words))))
        del words
    rows, lengths = np.concatenate(numbers), np.array(sizes, np.int64)
    # a text in one language needs no search; the others are searched together
    language, certain = one_language(rows, lengths, scores.table, switch)
    label = np.repeat(language.astype(label_type(len(model.langs))), lengths)
    mixed = np.repeat(~certain, lengths)
    label[mixed] = viterbi(rows[mixed], lengths[~certain], scores.table, switch)
    letters = scores.letters[rows]
    counted = np.where(scores.known[rows], letters, 0)
    n, langs = len(lengths), len(model.langs)
    doc = np.repeat(np.arange(n, dtype=np.int32), lengths)
    by = np.bincount(doc * np.int64(langs) + label, counted, n * langs).reshape(n, langs)
    total = np.bincount(doc, letters, n)
    best = by.argmax(1)
    edge = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])]) if len(rows) else np.zeros(0, np.int64)
    width = np.diff(np.r_[edge, len(rows)])
    spans: list[list[tuple[str, int]]] = [[] for _ in range(n)]
    for d, l, w in zip(doc[edge].tolist(), label[edge].tolist(), width.tolist()):
        spans[d].append((model.langs[l], w))
    names, shares = [], []
    covered = (by.sum(1) / np.maximum(total, 1)).tolist()
    for i in range(n):
        if not total[i]:
            names.append(UNKNOWN)
            shares.append(0.0)
        else:
            names.append(model.langs[int(best[i]) if by[i, best[i]] else model.common])
            shares.append(float(by[i, best[i]] / total[i]))
    return names, shares, spans, covered


def predict(docs: DataFrame, model: Model, switch: float = 6.0, text_col: str = "text", batch_bytes: int = 1 << 22, added: tuple[str, ...] = ("lang_pred", "score", "spans")) -> DataFrame:
    """``docs`` with the columns ``added``: language, score, spans, (lang, words) in order, and, if a fourth is named, the share
    of letters whose word was scored for a language.

    Input columns of these names are replaced, all others stay as they are.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats for each language
    at = docs.columns.index(text_col)
    kept = [c for c in docs.columns if c not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept) + (
        f", `{added[0]}` string, `{added[1]}` double, `{added[2]}` array<struct<lang:string,words:long>>" + "".join(f", `{c}` double" for c in added[3:])
    )
    spans_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        scores = _Scores(m)
        for b in batch_slices(batches, text_col, batch_bytes):
            if m.langs:
                # decoded a megabyte at a time; texts with several languages are searched together
                decoded = (part.column(at).to_pylist() for part in batch_slices([b], text_col, DECODED))
                names, shares, spans, covered = label_texts(decoded, m, scores, switch)
            else:
                n = b.num_rows
                names, shares, spans, covered = [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)], [0.0] * n
            found = [pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array([[{"lang": a, "words": n} for a, n in s] for s in spans], spans_type)]
            found += [pa.array(covered, pa.float64())] * len(added[3:])
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), *found], [*kept, *added])
            if len(scores.row) > CACHED:  # the table of distinct words is made anew as needed
                scores = _Scores(m)
        # the worker stays; what it held goes back to the machine
        del scores
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 2 modulo 4 (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def keep_known(docs: DataFrame, least: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those of which under ``least`` of the letters are in learned languages, in one or in several."""
    found = predict(docs, fit(docs, text_col=text_col, **options), text_col=text_col, added=("__lang", "__score", "__spans", "__known"))
    return found.filter((F.col("__lang") != UNKNOWN) & (F.col("__known") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
