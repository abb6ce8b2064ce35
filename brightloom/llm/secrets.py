"""Secret scan: keywords found by one Aho-Corasick pass, patterns tried only at the hits, checksums validated.

Three kinds are the base: ``assign`` (a secret-like name, a sign and a value), ``access`` (access key ids) and ``hex`` (long
runs of lower-case hexadecimal digits). For these the hits, taken from the left and skipping what a match has covered, give
exactly the leftmost non-overlapping matches, as a match can only begin at its keyword. The keyword of ``hex`` is a run of 24
digits in the text with all digits made one letter. Further kinds carry a checksum and count only if it is right: ``github``
and ``npm`` tokens (CRC-32 of the body in base 62, the last six characters) and ``card`` numbers after the word card (Luhn).

* Texts are scanned as UTF-8 bytes, whole; spans are told in code points, end exclusive. Letters in either case are ASCII.
* Null text is empty and has no spans. Rows, repeated ones too, are scanned one by one. Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from brightloom.llm.common import ascii_lower_table, id_and_text, texts_of

#: fixed values: kinds in their order, keywords (lower case) of each, and the pattern tried at a keyword
KINDS = ("assign", "access", "hex", "github", "npm", "card")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "card": ("card",),
}
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
TOKEN = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CARD = re.compile(rb"card(?:\x20?(?:number|no\.?|nr\.?))?[\x20:=#\"']{1,4}([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])", re.IGNORECASE)
DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = 24
#: hexadecimal digits become x, all else a space
HEX_BYTES = bytes(120 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))


def crc62(body: bytes) -> bytes:
    """CRC-32 in base 62, six digits."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = DIGITS62[r : r + 1] + out
    return out


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _try(kind: str, raw: bytes, at: int) -> tuple[int, int, int, bool] | None:
    """(start, end, end of what is covered, whether it counts) of the pattern at a keyword."""
    if kind == "assign":
        m = ASSIGN.match(raw, at)
        return m and (m.start(), m.end(), m.end(), len(m[2]) >= 6)
    if kind == "access":
        m = ACCESS.match(raw, at)
        return m and (m.start(), m.end(), m.end(), len(m[0]) >= 20)
    if kind == "card":
        m = CARD.match(raw, at)
        return m and (m.start(1), m.end(1), m.end(), luhn(re.sub(rb"[\x20-]", b"", m[1])))
    m = TOKEN.match(raw, at)
    return m and (m.start(), m.end(), m.end(), crc62(m[1]) == m[2])


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def scan(raw: bytes, words: ahocorasick.Automaton, lower: bytes) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans of a text, in bytes."""
    out, covered = [], dict.fromkeys(KINDS, 0)
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in words.iter(raw.translate(lower).decode("latin-1")))
    for at, kind in hits:
        if at < covered[kind]:
            continue
        found = _try(kind, raw, at)
        if found:
            start, end, covered[kind], good = found
            if good:
                out.append((start, kind, end))
    runs = raw.translate(HEX_BYTES)
    at = runs.find(b"x" * HEX_RUN)
    while at >= 0:
        end = runs.find(b" ", at)
        end = len(raw) if end < 0 else end
        out.append((at, "hex", end))
        at = runs.find(b"x" * HEX_RUN, end)
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def in_code_points(raw: bytes, spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    if not spans or raw.isascii():
        return spans
    places = sorted({p for s in spans for p in (s[0], s[2])})
    chars, at, n = {}, 0, 0
    for p in places:
        n += len(raw[at:p].decode())
        at = p
        chars[p] = n
    return [(chars[a], k, chars[b]) for a, k, b in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end) in code points, by start, then kind in the order of ``KINDS``."""
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lower = automaton(), ascii_lower_table()
        for b in batches:
            found = []
            for raw in texts_of(b.column(1)):
                spans = in_code_points(raw, scan(raw, words, lower)) if raw else []
                found.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, spans_type)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
