"""Source divergence audit: how differently the sources of each language use its terms.

The counts of one language form a matrix of groups (sources) and terms. It is cut into tiles of groups by blocks of terms; each tile is
a K-squared tree (here k = 2): a quadrant is one bit, set if anything in it is above zero, and only set quadrants have children. Two
sources are compared by walking their rows down the tree together. A quadrant that is empty in both is priced at once: its number of
terms times the fixed distance of two zero counts. What remains at the leaves is compared term by term, in whole numbers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from brightloom.llm.common import ascii_lower_table, batch_slices
from brightloom.staging import stage
from brightloom.unions import union_all

#: groups of a tile and terms of a block: a task holds two tiles of one block
TILE = 256
BLOCK_TERMS = 4096
#: states of one step of the walk
STEP = 1 << 17

SLICE_BYTES = 4 << 20
HELD_TERMS = 1 << 17

_LOWER = ascii_lower_table()
_BYTES = bytes(_LOWER[b] if b >= 0x80 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
SCALE = 1_000_000_000


def count_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a row with a null term for every group that has documents."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))

    def count(batches):
        n: dict[tuple, Counter] = {}
        seen: dict[tuple, Counter] = {}

        def flush():
            for group, words in n.items():
                names = list(words)
                terms = pa.array([*names, None], pa.binary()).cast(pa.string())
                each = [pa.array([g] * (len(names) + 1), pa.string()) for g in group]
                numbers = [pa.array([*(c[w] for w in names), 0], pa.int64()) for c in (words, seen[group])]
                yield pa.record_batch([*each, terms, *numbers], schema=COUNTS)
            n.clear()
            seen.clear()

        for part in batch_slices(batches, "text", SLICE_BYTES):
            for lang, source, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist()):
                group = (lang, source)
                if group not in n:
                    n[group], seen[group] = Counter(), Counter()
                plain, own, at = body.translate(_BYTES), set(), 0
                while at < len(plain):
                    cut = plain.find(b" ", at + (1 << 20))
                    until = cut if cut >= 0 else len(plain)
                    words = plain[at:until].split()
                    n[group].update(words)
                    own.update(words)
                    at = until
                seen[group].update(own)
            if sum(map(len, n.values())) > HELD_TERMS:
                yield from flush()
        yield from flush()

    found = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    # dealt by language and term, so that the sums over a language need no second shuffle; a row for every source has no term
    return found.repartition(F.col("lang"), F.coalesce("term", F.concat(F.lit(" "), F.col("source")))).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Tree:
    """K-squared tree of a matrix given by its cells above zero: a bit array per level, children found by counting set bits."""

    def __init__(self, row: np.ndarray, col: np.ndarray, levels: int):
        self.levels, self.bits, self.ranks = levels, [], []
        parents = np.zeros(min(1, len(row)), np.int64)  # Morton codes of the set quadrants of the level above
        code = np.zeros(len(row), np.int64)
        for level in range(levels):
            shift = levels - 1 - level
            code = code * 4 + ((row >> shift) & 1) * 2 + ((col >> shift) & 1)
            quadrants = np.unique(code)
            bits = np.zeros(4 * len(parents), bool)
            bits[4 * np.searchsorted(parents, quadrants >> 2) + (quadrants & 3)] = True
            self.bits.append(bits)
            self.ranks.append(np.cumsum(bits) - 1)
            parents = quadrants
        self.leaves = parents  # one per cell above zero, in the order of its code
        self.order = np.argsort(code, kind="stable")

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Number of the child of each node in the next level, -1 where the quadrant (or the node) is empty."""
        out = np.full(len(node), -1, np.int64)
        some = np.flatnonzero(node >= 0)
        at = 4 * node[some] + quadrant[some]
        full = self.bits[level][at]
        out[some[full]] = self.ranks[level][at[full]]
        return out


def scaled(count: np.ndarray, total: np.ndarray | int, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 v)), by long division in steps of 1,000 so that nothing passes 64 bits."""
    under = np.asarray(total, np.int64) + 2 * v
    whole, rest = np.divmod(np.asarray(count, np.int64) + 2, under)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, under)
        whole = whole * 1000 + digit
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def compare_tiles(a: tuple, b: tuple, terms: int) -> np.ndarray:
    """Sums of the distances of all terms for every row of tile ``a`` with every row of tile ``b``.

    A tile is (row, col, p of the cells, p of a zero count for each row).
    """
    if not terms:
        return np.zeros((len(a[3]), len(b[3])), np.int64)
    rows = max(len(a[3]), len(b[3]))
    levels = max(1, int(max(rows, terms) - 1).bit_length())
    trees = [Tree(t[0], t[1], levels) for t in (a, b)]
    prices = [t[2][tree.order] for t, tree in zip((a, b), trees)]
    side = 1 << levels
    sums = np.zeros((len(a[3]), len(b[3])), np.int64)
    # terms in quadrants that are empty in both rows, for each level and pair of row quadrants
    blocks = [-(-rows // (side >> level)) for level in range(levels + 1)]
    empty = [np.zeros(n * n, np.int64) for n in blocks]
    start = [np.zeros(1, np.int64) - (len(t[0]) == 0) for t in (a, b)]
    stack = [(0, start[0], start[1], np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]

    while stack:
        level, na, nb, ra, rb, c = stack.pop()
        if len(na) > STEP:
            half = len(na) // 2
            stack.append((level, *(x[half:] for x in (na, nb, ra, rb, c))))
            stack.append((level, *(x[:half] for x in (na, nb, ra, rb, c))))
            continue
        none = (na < 0) & (nb < 0)
        if none.any():
            width = np.clip(terms - c[none] * (side >> level), 0, side >> level)
            empty[level] += np.bincount(ra[none] * blocks[level] + rb[none], weights=width, minlength=len(empty[level])).astype(np.int64)
            na, nb, ra, rb, c = (x[~none] for x in (na, nb, ra, rb, c))
        if not len(na):
            continue
        if level == levels:
            p = np.where(na >= 0, prices[0][na] if len(prices[0]) else 0, a[3][ra])
            q = np.where(nb >= 0, prices[1][nb] if len(prices[1]) else 0, b[3][rb])
            found = np.bincount(ra * sums.shape[1] + rb, weights=distance(p, q), minlength=sums.size)  # below 2^17 x 2^32, exact in a double
            sums += found.astype(np.int64).reshape(sums.shape)
            continue
        shift = levels - 1 - level
        step = np.arange(8)
        qa, qb, qc = step >> 2, (step >> 1) & 1, step & 1
        many = lambda x, q: (x[:, None] * 2 + q).ravel()
        ra2, rb2, c2 = many(ra, qa), many(rb, qb), many(c, qc)
        inside = (ra2 << shift < len(a[3])) & (rb2 << shift < len(b[3])) & (c2 << shift < terms)
        na2 = trees[0].child(level, np.repeat(na, 8)[inside], (np.tile(qa * 2 + qc, len(na)))[inside])
        nb2 = trees[1].child(level, np.repeat(nb, 8)[inside], (np.tile(qb * 2 + qc, len(nb)))[inside])
        stack.append((level + 1, na2, nb2, ra2[inside], rb2[inside], c2[inside]))
    zero = distance(a[3][:, None], b[3][None, :])
    for level, (n, grid) in enumerate(zip(blocks, empty)):
        reach = side >> level
        sums += grid.reshape(n, n)[np.arange(len(a[3]))[:, None] // reach, np.arange(len(b[3]))[None, :] // reach] * zero
    return sums


def _matrix(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(cells above zero of the kept terms, with the language's count of the term; groups with their totals, numbers and tiles)."""
    counts = stage(counts, "terms")
    by_term = W.partitionBy("lang", "term")  # at most a row for each source of the language
    kept = counts.filter("term IS NOT NULL").withColumns({"lang_n": F.sum("n").over(by_term), "lang_docs": F.sum("docs").over(by_term)})
    cells = stage(kept.filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "cells")
    langs = cells.groupBy("lang").agg(F.count_distinct("term").alias("v"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "v"])
    by_lang = W.partitionBy("lang")  # at most a row for each source, fewer than the pairs of sources that the result lists
    return cells, stage(groups.withColumns({"lang_total": F.sum("total").over(by_lang), "number": F.row_number().over(by_lang.orderBy("source")) - 1}), "groups")


PARTS = "lang string, part string, source string, item string, value long"


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances to all other sources of the language (``pair``), and the ``top`` terms that a
    source uses more than its language does (``term``).

    Null text, language and source are empty strings; groups without terms are compared too; an empty table gives no rows; repeated rows
    count as often as they stand there; other columns are not read. Ranks go by value, then by item in UTF-8 order.
    """
    cells, groups = _matrix(count_terms(docs, lang_col, source_col, text_col), min_docs)
    groups = groups.withColumn("tile", F.floor(F.col("number") / TILE).cast("int"))
    size = groups.groupBy("lang").agg(F.max("v").alias("v"), (F.max("tile") + 1).alias("tiles")).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK_TERMS)))
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    sides = lambda c: [F.least(c, "other").alias("ta"), F.greatest(c, "other").alias("tb")]
    # both sides of the cogroup come from one table, so the columns of one side get names of their own
    whose = groups.select("lang", "source", F.col("number").alias("row"), F.col("tile").alias("own"))
    placed = cells.join(whose, ["lang", "source"]).join(size, "lang").select("lang", block.alias("block"), "row", "own", "term", "n", "lang_n", other)
    left = placed.select("lang", "block", *sides("own"), "row", "term", "n", "lang_n")
    facts = groups.join(size.drop("v"), "lang").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).select("*", other)
    # terms of a block that neither tile uses are priced too, so their number goes along
    counts = cells.select("lang", "term").distinct().join(size, "lang").groupBy(F.col("lang").alias("_l"), block.alias("_b")).agg(F.count(F.lit(1)).alias("terms"))
    facts = facts.join(counts, (F.col("lang") == F.col("_l")) & (F.col("block") == F.col("_b")), "left").fillna(0, ["terms"])
    right = facts.select("lang", "block", *sides("tile"), "source", "number", "total", "lang_total", "v", "terms")

    def compare(key, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        lang, _, ta, tb = key
        groups = groups.sort_values("number", ignore_index=True)
        numbers, names, v = groups["number"].to_numpy(), groups["source"].to_numpy(dtype=object), int(groups["v"].iloc[0])
        # terms of most groups first, so that empty quadrants are large
        col, terms = pd.factorize(cells["term"], sort=True)
        place = np.argsort(np.argsort(-np.bincount(col, minlength=len(terms)), kind="stable"), kind="stable")
        row = np.searchsorted(numbers, cells["row"].to_numpy())
        n, totals = cells["n"].to_numpy(np.int64), groups["total"].to_numpy(np.int64)
        if v == 0:
            p, zero = n, np.ones(len(groups), np.int64)
        else:
            p, zero = scaled(n, totals[row], v), scaled(np.zeros(len(groups), np.int64), totals, v)
        out = []
        tile = numbers // TILE
        sides = []
        for t in (ta, tb):
            rows = np.flatnonzero(tile == t)
            mine = (row >= rows[0]) & (row <= rows[-1])
            sides.append((rows, (row[mine] - rows[0], place[col[mine]], p[mine], zero[rows])))
        sums = compare_tiles(sides[0][1], sides[1][1], int(groups["terms"].iloc[0]))
        i, j = np.divmod(np.arange(sums.size), sums.shape[1])
        i, j, value = sides[0][0][i], sides[1][0][j], sums.ravel()
        for x, y in ([(i, j)] if ta == tb else [(i, j), (j, i)]):
            differ = x != y
            out.append(pd.DataFrame({"lang": lang, "part": "pair", "source": names[x[differ]], "item": names[y[differ]], "value": value[differ]}))
        if ta == tb and len(cells):
            whole = scaled(cells["lang_n"].to_numpy(np.int64), int(groups["lang_total"].iloc[0]), v)
            over = np.flatnonzero(p > whole)
            best = pd.DataFrame({"lang": lang, "part": "term", "source": names[row[over]], "item": cells["term"].to_numpy(dtype=object)[over], "value": distance(p[over], whole[over])})
            best["_key"] = [t.encode() for t in best["item"]]  # UTF-8 order
            best = best.sort_values(["source", "value", "_key"], ascending=[True, False, True]).groupby("source", sort=False).head(top)
            out.append(best.drop(columns="_key"))
        return pd.concat(out, ignore_index=True)

    keys = ["lang", "block", "ta", "tb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, PARTS)
    found = stage(found, "compared")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(by))
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return union_all(*[d.select("lang", "source", "part", "item", "value", "rank") for d in (pairs, terms)])
