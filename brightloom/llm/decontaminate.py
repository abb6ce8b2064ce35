"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents of one partition. Its words become symbols, a piece of a text at a time: words of the
benchmark get a number each, all others break the text. Stretches between breaks that are shorter than the shortest test phrase cannot hold one and are not
indexed. Over the rest an index is built: suffix array (rank doubling), Burrows-Wheeler string, wavelet matrix with ranks, and
suffix positions sampled every ``SAMPLE`` words and at each stretch's start. All test phrases are searched backward at once, and
the rows found are walked to a sampled position. The removal spans of a document are the merged occurrences.

* A phrase is a window of ``window`` consecutive words of an item; an item with fewer words, but not none, is one phrase.
* The benchmark is the one table that goes to every task. Its phrases take at most about ``max_benchmark_bytes`` there; a larger
  benchmark is searched in blocks of items, one after the other, and the spans are merged per document.
* Null text has no words. Items with null text or without words hold no phrase. Words hit by an item whose id is null are hit;
  such an item is not listed. Items may repeat an id; it is listed once. Rows of ``docs`` stay as they are, repeated ids too.
* A document longer than a shard is a shard of its own, so no phrase is cut.
* A task holds one Arrow batch, the symbols of a shard (4 bytes a word) and its index (about 100 bytes an indexed word while it is
  made); texts are cut in the same pass, and what a worker held goes back to the machine after the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightloom.llm.common import batch_slices, release_memory, slices, texts_of
from brightloom.staging import stage

#: words of a shard
SHARD_WORDS = 1 << 20
#: bytes of text that are Python words at a time
PIECE = 1 << 18
#: distance of sampled suffix positions
SAMPLE = 8
#: bytes of memory for a byte of the benchmark's text
MEMORY = 32
#: bytes that are not part of a word become spaces, A-Z becomes a-z: words are [0-9a-z] and all bytes from 0x80
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: columns of what is found
ADDED = ["n_words", "n_hit", "spans", "items"]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def symbols_of(text: bytes | None, symbols: dict[bytes, int]) -> np.ndarray:
    """The words of a text as symbols, 0 for words that have none."""
    clean, found, at = (text or b"").translate(WORD_BYTES), [np.zeros(0, np.int32)], 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE) if at + PIECE < len(clean) else -1
        words = clean[at : end if end >= 0 else len(clean)].split()
        found.append(np.fromiter((symbols.get(w, 0) for w in words), np.int32, len(words)))
        at = end if end >= 0 else len(clean)
    return np.concatenate(found)


class Phrases:
    """The test phrases of a benchmark: words as symbols from 1, distinct phrases by length, and the items of each.

    ``tables`` holds (length, first phrase number, matrix of symbols) for each length; the items of phrase i are ``names`` at
    ``of[cut[i]:cut[i + 1]]``. A phrase of ten words takes about 60 bytes.
    """

    def __init__(self, items: list[tuple[object, bytes | None]], window: int) -> None:
        self.symbols: dict[bytes, int] = {}
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        self.names = sorted({str(item) for item, _ in items if item is not None})
        number = {name: i for i, name in enumerate(self.names)}
        for item, text in items:
            words = words_of(text)
            row = np.fromiter((self.symbols.setdefault(w, len(self.symbols) + 1) for w in words), np.int32, len(words))
            if len(row):
                n = min(len(row), window)
                rows.setdefault(n, []).append(np.lib.stride_tricks.sliding_window_view(row, n))
                owners.setdefault(n, []).append(np.full(len(row) - n + 1, number[str(item)] if item is not None else -1, np.int32))
        self.tables, cuts, of, total = [], [np.zeros(1, np.int64)], [], 0
        for n in sorted(rows):
            table, inverse = np.unique(np.concatenate(rows[n]), axis=0, return_inverse=True)
            pairs = np.unique(np.column_stack([inverse.ravel(), np.concatenate(owners[n])]), axis=0)
            named = pairs[pairs[:, 1] >= 0]
            self.tables.append((n, total, table))
            cuts.append(cuts[-1][-1] + np.searchsorted(named[:, 0], np.arange(1, len(table) + 1)))
            of.append(named[:, 1].astype(np.int32))
            total += len(table)
        self.cut, self.of = np.concatenate(cuts), np.concatenate(of) if of else np.zeros(0, np.int32)
        self.shortest = min(rows, default=0)

    def items(self, phrases: set[int]) -> list[str]:
        """Sorted names of the items that hold one of the phrases."""
        found = {int(i) for p in phrases for i in self.of[self.cut[p] : self.cut[p + 1]]}
        return [self.names[i] for i in sorted(found)]


class FMIndex:
    """Full-text index of a sequence of symbols >= 1, cut into stretches; no phrase crosses a stretch."""

    def __init__(self, stretches: list[np.ndarray], symbols: int) -> None:
        lengths = np.array([len(s) for s in stretches], np.int64)
        # a stretch is followed by symbol 0; such ends are ordered by place, so all suffixes differ
        self.text = np.zeros(int(lengths.sum()) + len(lengths), np.int32)
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        inside = np.ones(len(self.text), bool)
        inside[self.starts + lengths] = False
        if len(stretches):
            self.text[inside] = np.concatenate(stretches)
        self.n, self.levels = len(self.text), max(1, int(symbols).bit_length())
        self.sa = self._suffix_array()
        before = self.text[self.sa - 1]  # the first suffix is preceded by the last end
        counts = np.bincount(self.text, minlength=(1 << self.levels) + 1)
        self.first = np.cumsum(counts) - counts
        self._wavelet(before)
        self.bwt = before
        sampled = (self.sa % SAMPLE == 0)
        at_start = np.zeros(self.n, bool)
        at_start[self.starts] = True
        self.sampled = sampled | at_start[self.sa]
        self.sample_rank = np.cumsum(self.sampled, dtype=np.int32) - self.sampled
        self.samples = self.sa[self.sampled]
        del self.sa

    def _suffix_array(self) -> np.ndarray:
        """Sort by the first symbols, then double the sorted length; only suffixes that still tie are sorted again."""
        n, text = self.n, self.text
        # ends rank by place, below all words
        ends = np.flatnonzero(text == 0)
        rank0 = text + np.int32(len(ends))
        rank0[ends] = np.arange(len(ends))
        bits = max(1, int(rank0.max(initial=0) + 1).bit_length())
        take = max(1, min(n, 62 // bits))
        key, alive = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(take):
            # nothing after an end counts: the end is unique already
            key <<= bits
            np.bitwise_or(key[: n - i], rank0[i:] + 1, out=key[: n - i], where=alive[: n - i])
            alive[: n - i] &= text[i:] != 0
        del rank0, alive
        sa = np.argsort(key, kind="stable").astype(np.int32)
        key = key[sa]
        new = np.r_[True, key[1:] != key[:-1]]
        del key
        group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        rank = np.empty(n, np.int32)
        rank[sa] = group
        length = take
        while True:
            tied = np.flatnonzero(~new | np.r_[~new[1:], False])
            if not len(tied):
                return sa
            place = sa[tied]
            later = rank[np.minimum(place + min(length, n), n - 1)]  # tied suffixes are longer than what is sorted
            order = np.lexsort((later, group[tied]))
            sa[tied] = place[order]
            g, l = group[tied], later[order]
            fresh = np.r_[True, (g[1:] != g[:-1]) | (l[1:] != l[:-1])]
            new[tied] = fresh
            group[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
            rank[sa[tied]] = group[tied]
            length *= 2

    def _wavelet(self, seq: np.ndarray) -> None:
        """Each level: 64 bits to a number, the ones before each, and how many zeros there are."""
        self.bits, self.ones, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            packed = np.zeros(8 * (len(seq) // 64 + 1), np.uint8)
            packed[: -(-len(seq) // 8)] = np.packbits(bit, bitorder="little")
            self.bits.append(packed.view("<u8"))
            count = np.bitwise_count(self.bits[-1])
            self.ones.append(np.cumsum(count, dtype=np.int32) - count)
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        # where each symbol's rows begin below the last level
        every = np.arange(1 << self.levels, dtype=np.int32)
        self.base = self._below(every, np.zeros(len(every), np.int64))

    def _ones(self, k: int, row: np.ndarray) -> np.ndarray:
        """Ones of a level before each row."""
        block, inside = row >> 6, (np.uint64(1) << (row & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[k][block] + np.bitwise_count(self.bits[k][block] & inside)

    def _below(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows followed through all levels, each as if it had the symbol."""
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self._ones(k, at)
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the Burrows-Wheeler string before each row."""
        return self._below(symbol, row.astype(np.int64)) - self.base[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows (from, to) of phrases of one length: a row of symbols each."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for i in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, i]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
            if not len(live):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled position and add the steps."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            hit = self.sampled[rows[left]]
            done = left[hit]
            out[done] = self.samples[self.sample_rank[rows[done]]] + steps[done]
            left = left[~hit]
            c = self.bwt[rows[left]]
            rows[left] = self.first[c] + self.rank(c, rows[left])
            steps[left] += 1
        return out


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """(spans, items) of each document, given as its symbols; spans are word ranges, end exclusive, merged."""
    stretches, origin = [], []
    for d, ids in enumerate(docs):
        inside = np.r_[False, ids > 0, False]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= phrases.shortest:
                stretches.append(ids[a:b])
                origin.append((d, a))
    out: list[tuple[list[tuple[int, int]], list[str]]] = [([], []) for _ in docs]
    if not stretches:
        return out
    index = FMIndex(stretches, len(phrases.symbols))
    places, sizes, which = [], [], []
    for n, first, table in phrases.tables:
        at = first + np.arange(len(table))
        lo, hi = index.search(table)
        count = hi - lo
        rows = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        places.append(index.locate(rows).astype(np.int32))
        sizes.append(np.full(len(rows), n, np.int32))
        which.append(np.repeat(at.astype(np.int32), count))
    place, size, phrase = np.concatenate(places), np.concatenate(sizes), np.concatenate(which)
    stretch = np.searchsorted(index.starts, place, side="right") - 1
    doc_of, first_of = (np.array(x, np.int64) for x in zip(*origin))
    doc, begin = doc_of[stretch], first_of[stretch] + place - index.starts[stretch]
    order = np.lexsort((begin, doc))
    doc, begin, end, phrase = doc[order], begin[order], (begin + size)[order], phrase[order]
    edge = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)] if len(doc) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        items = phrases.items(set(phrase[a:b].tolist()))
        out[int(doc[a])] = (_merged(list(zip(begin[a:b].tolist(), end[a:b].tolist()))), items)
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[tuple[list[tuple[str | None, bytes]], bool]]:
    """The benchmark in blocks of about ``most`` bytes of memory, each with whether it is the last: one, unless the table is larger. The size
    is counted first.

    A byte of text is a sixth of a word or less, and a word begins a phrase of ten numbers; with the words themselves and what is held while
    the tables are made, that is about MEMORY bytes for one of text.
    """
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total * MEMORY // most))
    for k in range(blocks):
        yield [(r[0], r[1].encode()) for r in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()], k == blocks - 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def find_phrases(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, max_benchmark_bytes: int = 256 << 20,
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (word ranges, end exclusive) and items (ids as strings, sorted).

    Input columns of these names are replaced, all others stay.
    """
    return _all_blocks(docs, benchmark, text_col, item_col, item_text_col, window, max_benchmark_bytes)


def _all_blocks(
    docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str = "item_id", item_text_col: str = "text",
    window: int = 10, max_benchmark_bytes: int = 256 << 20, gap: bytes | None = None,
) -> DataFrame:
    """``find_phrases``; with a gap, ``docs`` without the spans instead, cut in the pass over the last block."""
    found = docs.drop(*[c for c in ADDED if c != text_col])
    for k, (block, last) in enumerate(_blocks(benchmark, item_col, item_text_col, max_benchmark_bytes)):
        if k:  # one block is live at a time: what the earlier ones found is written first
            found = stage(found, "finds", "zstd")
        found = _search(found, Phrases(block, window), text_col, more=k > 0, gap=gap if last else None)
    return found


def _search(docs: DataFrame, phrases: Phrases, text_col: str, more: bool, gap: bytes | None) -> DataFrame:
    """One block of the benchmark; with ``more``, its finds are added to those that ``docs`` already carries."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema if f.name not in ADDED}
    if gap is not None:
        kinds[text_col] = "string"
    schema = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
    if gap is None:
        schema += ", n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from searched(batches, shared.value, text_col, list(kinds), more, gap)
        release_memory()

    return docs.mapInArrow(run, schema)


def searched(batches: Iterator[pa.RecordBatch], phrases: Phrases, text_col: str, kept: list[str], more: bool = False, gap: bytes | None = None) -> Iterator[pa.RecordBatch]:
    """The rows with the columns ``kept`` and ``ADDED``, a batch for each shard; with a gap, only those kept, and the text cut."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def shard(rows: pa.RecordBatch, docs: list[np.ndarray]) -> pa.RecordBatch:
        column = lambda c: rows.column(rows.schema.get_field_index(c))
        found = search_shard(docs, phrases)
        if more:
            before = zip(column("spans").to_pylist(), column("items").to_pylist())
            found = [(_merged([*s, *((x["start"], x["end"]) for x in old)]), sorted({*i, *items})) for (s, i), (old, items) in zip(found, before)]
        if gap is not None:
            return pa.RecordBatch.from_arrays([_cut_texts(column(c), found, gap) if c == text_col else column(c) for c in kept], kept)
        values = [
            pa.array(map(len, docs), pa.int64()), pa.array([sum(e - s for s, e in f[0]) for f in found], pa.int64()),
            pa.array([[{"start": s, "end": e} for s, e in f[0]] for f in found], spans_type), pa.array([f[1] for f in found], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays([*map(column, kept), *values], [*kept, *ADDED])

    for b in batches:
        lo = 0
        texts = (t for part in batch_slices([b], text_col, PIECE) for t in texts_of(part.column(part.schema.get_field_index(text_col))))
        for docs in slices((symbols_of(t, phrases.symbols) for t in texts), len, SHARD_WORDS):
            yield shard(b.slice(lo, len(docs)), docs)
            lo += len(docs)


def _cut_texts(texts: pa.Array, found: list[tuple[list[tuple[int, int]], list[str]]], gap: bytes) -> pa.Array:
    """A string column without the spans found in its rows."""
    if not any(spans for spans, _ in found):
        return texts.cast(pa.string())
    return pa.array([cut(t, spans, gap) if spans else t for t, (spans, _) in zip(texts_of(texts), found)], pa.binary()).cast(pa.string())


def cut(text: bytes, spans: list[tuple[int, int]], gap: bytes = b" ") -> bytes:
    """``text`` without the bytes between the first and the last word of each span of words."""
    is_word = np.frombuffer(text.translate(WORD_BYTES), np.uint8) != 32
    starts = np.flatnonzero(is_word & ~np.r_[False, is_word[:-1]])
    ends = np.flatnonzero(is_word & ~np.r_[is_word[1:], False]) + 1
    out, at = [], 0
    for s, e in spans:
        out += [text[at : int(starts[s])], gap]
        at = int(ends[e - 1])
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", gap: str = " ", **options) -> DataFrame:
    """``docs`` without the benchmark's passages: the same columns, with ``gap`` in place of each removal span of the text."""
    packed = docs.select(F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"))
    cleaned = _all_blocks(packed, benchmark, "_text", **options, gap=gap.encode())
    return cleaned.select(*[F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
