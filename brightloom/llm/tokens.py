"""Token counts by a linear longest-match automaton, without building pieces.

Greedy longest match takes, from the left, the longest vocabulary entry that begins what is left of a word. The automaton reads
each byte of a word once: a trie of the vocabulary, and for each node a failure link to the node of what remains once the
leading pieces are popped, with their number counted beforehand. When no child fits, the counts of the links are added up.

* Words: runs of letters, single digits, runs of other signs, of the lower-cased text; white space separates. The vocabulary
  may mark word ends: an entry with the mark fits only at the end of a word, and the mark alone is no piece.
* A byte that no entry begins with is one piece. Null and empty texts have no tokens. Rows are counted one by one, whole.
* The vocabulary is a file of a public tokenizer, read by the driver; the automaton (of a size fixed by the file) goes to the
  tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from brightloom.llm.common import id_and_text

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
END = 256
_WORDS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: distinct words whose counts a task keeps
CACHE_WORDS = 1 << 19


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str = VOCABULARY, end_mark: str = "</w>") -> list[tuple[int, ...]]:
    """Entries of a byte-level tokenizer file as tuples of bytes, with ``END`` for the end mark. Special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"] for t in data.get("added_tokens", []) if t.get("special")}
    byte, out = _byte_of_char(), []
    for entry in data["model"]["vocab"]:
        body = entry.removesuffix(end_mark)
        if entry not in special and body and all(c in byte for c in body):
            out.append((*(byte[c] for c in body), *([END] if body != entry else [])))
    return out


class Automaton:
    """Trie with failure links and popped counts; node 0 is the root."""

    def __init__(self, entries: Iterable[tuple[int, ...]]) -> None:
        self.children: list[dict[int, int]] = [{}]
        self.is_entry = [False]
        for entry in entries:
            self._add(entry)
        for b in range(256):
            self._add((b,))
        # links by breadth, so that a parent's link is there first
        self.link, self.popped = [0] * len(self.children), [0] * len(self.children)
        if END not in self.children[0]:
            self.children[0][END] = self._node()
            self.link.append(0)
            self.popped.append(0)
        self.rest = [0] * len(self.children)
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in self.children[u].items():
                    below.append(v)
                    if u == 0 and c == END:
                        continue  # the mark alone: nothing popped
                    if self.is_entry[v]:
                        self.link[v], self.popped[v] = 0, 1
                    else:
                        z, n = self.link[u], self.popped[u]
                        while c not in self.children[z]:
                            z, n = self.link[z], n + self.popped[z]
                        self.link[v], self.popped[v] = self.children[z][c], n
                    self.rest[v] = self.popped[v] + self.rest[self.link[v]]
            level = below

    def _node(self) -> int:
        self.children.append({})
        self.is_entry.append(False)
        return len(self.children) - 1

    def _add(self, entry: tuple[int, ...]) -> None:
        at = 0
        for c in entry:
            if c not in self.children[at]:
                self.children[at][c] = self._node()
            at = self.children[at][c]
        self.is_entry[at] = True

    def count(self, word: bytes) -> int:
        """Pieces of a word, each byte read once."""
        children, link, popped = self.children, self.link, self.popped
        at, n = 0, 0
        for c in (*word, END):
            while c not in children[at]:
                n += popped[at]
                at = link[at]
            at = children[at][c]
        return n + self.rest[at]


class _Counts(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        self[word] = n = self.automaton.count(word.encode())
        return n


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, end_mark: str = "</w>", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens): one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(read_vocabulary(vocabulary, end_mark)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared.value)
        for b in batches:
            words, tokens = [], []
            for text in b.column(1).to_pylist():
                found = _WORDS.findall(text.lower()) if text else []
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
                if len(counts) > CACHE_WORDS:
                    counts = _Counts(shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
