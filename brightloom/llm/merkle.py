"""Document fingerprints: Merkle trees over sections, paragraphs and phrases.

A text is cut at blank lines into sections, at line ends into paragraphs, and each paragraph into phrases: pieces of 6 to 16
code points that end where the text itself has a character of a fixed class (about one in four), in texts of every length and
in runs without white space. So pieces fall into step again behind an edit. A phrase is hashed; a paragraph's digest covers its
phrases, a section's its paragraphs and the blank line behind it, the root all sections; each covers the number of its children too.
The fingerprint is the root (32 hexadecimal digits), a dot, and the sections between ``/``: the section's digest (12 digits), ``:``,
the digests of its paragraphs (8 each), ``:``, and its ``SKETCH`` smallest different phrase hashes (6 each, ``*`` and a count if not 1)
between ``,``, with ``+`` before them if there were more. So roots test equality, and a comparison descends only into branches whose digests
differ. The size is bounded by paragraphs and sections, whatever their length.

* The likeness of two fingerprints is 1 if the roots are equal, else the share of phrases they have in common,
  2 * common / (both numbers of phrases), as multisets and below 1; 0 if neither has a phrase. Where sections had more phrases than
  the sketch keeps, the share is that of the phrases whose hash is within what both kept.
* Null text is empty; its fingerprint is a root alone. White space alone is a phrase.
* "Next" is the next row in descending (id, text digest), null ids last; after the last row comes the first. Repeated rows are
  rows of their own, so equal neighbours have likeness 1. A table of one row is its own next.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightloom.llm.common import id_and_text, partitions

#: a phrase ends at a code point that leaves 1 modulo 4 (of the basic plane), after 16 code points, or with its paragraph
_ENDS = re.escape("".join(chr(c) for c in range(1, 1 << 16, 4) if not 0xD800 <= c < 0xE000))
_PIECES = re.compile(rf"[\s\S]{{5,15}}?[{_ENDS}]|[\s\S]{{1,16}}")
_SECTION = re.compile(r"(\n[^\S\n]*\n)")
#: different phrase hashes that a section keeps: the likeness of longer ones is within about 0.04 (one deviation)
SKETCH = 128
_FIRST = -(1 << 63)


def fingerprint(text: str) -> str:
    leaf_hash, digest = xxhash.xxh64_digest, lambda parts: hashlib.md5(len(parts).to_bytes(8, "little") + b"".join(parts), usedforsecurity=False)
    shown, sections = [], []
    # sections and the blank lines between them, in turn
    for at, part in enumerate(_SECTION.split(text) if text else ()):
        if at % 2:
            sections.append(leaf_hash(part))
            continue
        held: Counter = Counter()
        nodes = []
        for paragraph in part.split("\n"):
            leaves = [leaf_hash(p) for p in _PIECES.findall(paragraph)]
            held.update([x[:3] for x in leaves])
            nodes.append(digest(leaves).digest())
        own = digest(nodes)
        sections.append(own.digest())
        least = sorted(held)[:SKETCH]
        kept = ",".join([h.hex() if held[h] == 1 else f"{h.hex()}*{held[h]}" for h in least])
        shown.append(f"{own.hexdigest()[:12]}:{''.join([n[:4].hex() for n in nodes])}:{'+' if len(held) > SKETCH else ''}{kept}")
    return f"{digest(sections).hexdigest()}.{'/'.join(shown)}"


def _sections(fp: str) -> list[tuple[str, str, str]]:
    """(digest, paragraphs, sketch) of each section."""
    return [tuple(s.split(":")) for s in fp[33:].split("/")] if len(fp) > 33 else []


def _sketch(fp: str) -> tuple[dict[str, int], str]:
    """Counts of phrase hashes, and the hash up to which all phrases are in them."""
    counts: dict[str, int] = {}
    most = "ffffff"
    for _, _, kept in _sections(fp):
        names = kept.lstrip("+").split(",")
        for entry in names:
            if entry:
                counts[entry[:6]] = counts.get(entry[:6], 0) + int(entry[7:] or 1)
        if kept.startswith("+"):
            most = min(most, names[-1][:6])
    return counts, most


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, see the module's text."""
    if a[:32] == b[:32]:
        return 1.0
    (x, x_most), (y, y_most) = _sketch(a), _sketch(b)
    most = min(x_most, y_most)
    total = sum(n for h, n in x.items() if h <= most) + sum(n for h, n in y.items() if h <= most)
    common = sum(min(n, y[h]) for h, n in x.items() if h <= most and h in y)
    return min(2.0 * common / total, 1.0 - 1.0 / (total + 1)) if total else 0.0


def changed(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of the branches of ``b`` that ``a`` does not have at that place or elsewhere.

    Equal roots and equal sections are not opened; of the others, paragraphs are matched with those of ``a``'s sections that have no match.
    """
    if a[:32] == b[:32]:
        return []
    cut = lambda section: [section[1][i : i + 8] for i in range(0, len(section[1]), 8)]
    mine = _sections(a)
    whole = Counter(s[0] for s in mine)
    open_ = []
    for i, section in enumerate(_sections(b)):
        if whole[section[0]]:
            whole[section[0]] -= 1
        else:
            open_.append((i, section))
    have: Counter = Counter()
    for section in mine:
        if whole[section[0]]:
            whole[section[0]] -= 1
            have.update(cut(section))
    out = []
    for i, section in open_:
        for j, p in enumerate(cut(section)):
            if have[p]:
                have[p] -= 1
            else:
                out.append((i, j))
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, extra, doc_id, text) so that each row's next one follows it: sorted inside partitions by descending id.

    Ids are cut into ranges by approximate quantiles. The first row of a range is needed by the range before it, so it is repeated
    there as an ``extra`` row: one for each range.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_FIRST)).alias("_id"))
    wide = partitions(docs)
    ranges = 4 * wide
    cuts = rows.agg(F.percentile_approx("_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    edges = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("long")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.int64), side="left"))

    # a row per range: where its largest id goes as an extra
    first = F.max(F.struct("_id", F.md5("text").alias("_digest")))
    tops = sorted((r[0], *r[1]) for r in rows.select(bucket_of("_id").alias("b"), "_id", "text").groupBy("b").agg(first).collect())
    spark = docs.sparkSession
    extra = spark.createDataFrame([(top, digest, tops[(i + 1) % len(tops)][0]) for i, (_, top, digest) in enumerate(tops)], "_id long, _top string, _to long")
    own = rows.withColumn("bucket", bucket_of("_id"))
    marked = own.withColumn("extra", F.lit(False)).select("bucket", "extra", "doc_id", "_id", "text")
    top = rows.join(F.broadcast(extra), (rows["_id"] == extra["_id"]) & (F.md5("text") == F.col("_top"))).drop(extra["_id"])
    copies = top.dropDuplicates(["_to"]).select(F.col("_to").alias("bucket"), F.lit(True).alias("extra"), "doc_id", "_id", "text")
    return (
        marked.unionByName(copies).withColumn("_digest", F.md5("text")).repartition(wide, "bucket")
        .sortWithinPartitions("bucket", "extra", F.desc("_id"), F.desc("_digest")).select("bucket", "extra", "doc_id", "text")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint): one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edits by the next text, with the likeness to the edit and to the next document."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_changed"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def pair(doc_id: int | None, text: str, fp: str, following: str, next_fp: str) -> tuple:
        new = edited(text, following)
        new_fp = fingerprint(new)
        return doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), fp, new_fp, likeness(fp, new_fp), likeness(fp, next_fp), len(changed(fp, new_fp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one; None after a range's extra row
        for b in batches:
            out = []
            for bucket, extra, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                if extra and (held is None or held[0] != bucket):
                    continue  # only the first extra row of a range is its next
                fp = fingerprint(text)
                if held is not None:
                    out.append(pair(*held[1:], text, fp))
                held = None if extra else (bucket, doc_id, text, fp)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_changed long"
    return in_order(docs, id_col, text_col).mapInArrow(run, schema)
