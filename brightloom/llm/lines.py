"""Line de-duplication by a segment-partition edit join (DataFrame functions only).

A line goes if the same line, or a line within ``max_edits`` edits of it, stands earlier in the table; the order is document
id, text digest, line number. So the first of a group of equal lines stays, unless an earlier line is near to it.

* Equal lines are one line from the start (one row per digest, combined before the shuffle), so a line that makes up a third
  of all lines is one row. Lines of at least ``min_length`` code points take part in the edit join; shorter ones are compared
  exactly. Lines of white space alone are never removed and never counted as repeated.
* A line is cut into ``max_edits + 1`` segments; with at most ``max_edits`` edits, one segment of the shorter line stands
  unchanged in the longer one, near its place. Segments are indexed by (number, line length, hash); a line probes the lengths
  down to ``max_edits`` below its own, at the only starts that multi-match-aware selection leaves.
* A segment that more than ``HEAVY`` lines share does not emit its pairs: its lines are compared with its first line, and those
  that are not settled by that meet the others under a condition inside the join, on their letter counts (an edit changes
  the sum of differences by two at most). The lines of such a segment are dealt over all tasks on the way there.
* What meets is verified, after the same test of letter counts, by a bit-parallel automaton over the 2 * max_edits + 1
  diagonals of the band.
* Null text has no lines and stays null. An empty text has one empty line and stays. Rows that are equal in id and text are
  one document for the decisions, and all of them stay. Null ids come last. A document that loses all lines stays, empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.staging import stage

MAX_EDITS = 2
MIN_LENGTH = 20
#: lines with one segment from which its pairs are not emitted any more
HEAVY = 32
#: bytes of ids or hashes (about 16 each) up to which they are sent to every task; above, the other side is shuffled to them
SMALL_IDS = 4 << 20
LETTERS = "abcdefghijklmnopqrstuvwxyz "
_LAST = (1 << 63) - 1


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _doc, _no, _line): ``_doc`` is the digest of the text, ``_no`` counts from 0."""
    text = F.col(text_col).cast("string")
    return (
        docs.filter(text.isNotNull())
        .select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_id"), F.unhex(F.md5(text)).alias("_doc"), F.posexplode(F.split(text, "\n", -1)).alias("_no", "_line"))
    )


def is_solid(line: Column) -> Column:
    """Whether a line has anything but blanks, tabs and the controls 11 to 13; the search ends at the first such character."""
    return line.rlike("[^\\x20\\x09\\x0B-\\x0D]")


def first_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line: (_first: its first place, _line, _n: how often it stands in the table)."""
    solid = lines.filter(is_solid(F.col("_line")))
    return (
        solid.groupBy(F.unhex(F.md5("_line")).alias("_digest"))
        .agg(F.min(F.struct("_id", "_doc", "_no", "_line")).alias("_m"), F.count(F.lit(1)).alias("_n"))
        .select(F.col("_m").dropFields("_line").alias("_first"), F.col("_m")["_line"].alias("_line"), "_n")
    )


def _segment(i: int, length: str, edits: int) -> tuple[str, str]:
    """(start, size) of segment i (from 1) of a line of ``length``, as SQL; the last ones take the remainder."""
    base, rest = f"({length} div {edits + 1})", f"({length} % {edits + 1})"
    extra = f"greatest(0, {i - 1} - ({edits + 1} - {rest}))"
    return f"(1 + {i - 1} * {base} + {extra})", f"({base} + if({i} > {edits + 1} - {rest}, 1, 0))"


def _hash(i: int, length: str, start: str, size: str) -> str:
    return f"xxhash64({i}, {length}, substring(_line, {start}, {size}))"


def segment_rows(edits: int) -> tuple[Column, Column, list[int]]:
    """(index, probes, own): arrays of hashes of a line ``_line`` of ``_len`` code points, and which probes are its index.

    The starts lie inside the line, as a line has at least as many code points as segments.
    """
    index, probes, own = [], [], []
    for delta in range(edits + 1):
        length = f"cast(_len - {delta} as int)"
        for i in range(1, edits + 2):
            start, size = _segment(i, length, edits)
            low = max(-(i - 1), delta - (edits + 1 - i))
            high = min(i - 1, delta + (edits + 1 - i))
            for off in range(low, high + 1):
                made = _hash(i, length, f"{start} + {off}", size)
                if delta == off == 0:
                    index.append(made)
                    own.append(len(probes))
                probes.append(made)
    return F.expr(f"array({', '.join(index)})"), F.expr(f"array({', '.join(probes)})"), own


def letter_counts(line: str = "_line") -> Column:
    return F.array(*[F.char_length(line) - F.char_length(F.replace(F.col(line), F.lit(c))) for c in LETTERS])


def counts_apart(a: str, b: str) -> Column:
    """Sum of the differences of two arrays of letter counts."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)


def within_edits(a: str, b: str, edits: int) -> Column:
    """Whether two strings are at most ``edits`` edits apart, by a banded bit-parallel automaton.

    State e is a bit set over the diagonals -edits..edits: those on which the prefixes read so far are at most e edits apart.
    A character of ``b`` keeps the diagonals on which it equals the character of ``a``; substitutions keep the diagonal,
    insertions and deletions move by one.
    """
    band = (1 << (2 * edits + 1)) - 1
    same = " | ".join(f"if(get(p, s.j + {d}) <=> c, {1 << (d + edits)}, 0)" for d in range(-edits, edits + 1))
    # state e needs the new state e - 1: written out as nested expressions, over x, the diagonals that match
    new = ["(s.s0 & x)"]
    for e in range(1, edits + 1):
        new.append(f"(((s.s{e} & x) | s.s{e - 1} | shiftright(s.s{e - 1}, 1) | shiftleft({new[-1]}, 1)) & {band})")
    states = ", ".join(f"'s{e}', {v}" for e, v in enumerate(new))
    step = f"transform(array({same}), x -> named_struct('j', s.j + 1, {states}))[0]"  # binds x once
    begin = ", ".join(f"'s{e}', {(((1 << (e + 1)) - 1) << edits) & band}" for e in range(edits + 1))
    first = f"named_struct('j', 0, {begin})"
    read = f"transform(array(split({a}, '')), p -> aggregate(split({b}, ''), {first}, (s, c) -> {step}))[0]"
    last = f"pmod(cast(char_length({a}) - char_length({b}) + {edits} as int), 32)"
    return F.expr(f"abs(char_length({a}) - char_length({b})) <= {edits} and ({read}.s{edits} & shiftleft(1, {last})) != 0")


def _small(df: DataFrame) -> DataFrame:
    """``df`` (staged, rows of about 16 bytes), to be sent to every task if its counted size allows it."""
    return F.broadcast(df) if df.count() * 16 <= SMALL_IDS else df


def _later(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """(_first): the later places of those pairs (a, b) of ids whose lines are near."""
    one = texts.select(F.col("id").alias("a"), F.col("_first").alias("fa"), F.col("_line").alias("la"), F.col("counts").alias("ca"))
    two = texts.select(F.col("id").alias("b"), F.col("_first").alias("fb"), F.col("_line").alias("lb"), F.col("counts").alias("cb"))
    near = F.when(counts_apart("ca", "cb") <= 2 * edits, within_edits("la", "lb", edits)).otherwise(F.lit(False))
    return pairs.join(one, "a").join(two, "b").filter(near & (F.col("la") != F.col("lb"))).select(F.greatest("fa", "fb").alias("_first")).distinct()


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_earlier(firsts: DataFrame, max_edits: int = MAX_EDITS, min_length: int = MIN_LENGTH) -> DataFrame:
    """(_first): the places of distinct lines to which an earlier distinct line is within ``max_edits``.

    ``firsts`` is staged, see ``first_lines``. Lines meet under a 64-bit id; should two lines share one, both are verified.
    """
    sized = firsts.select(F.xxhash64("_line").alias("id"), "_line", F.char_length("_line").alias("_len")).filter(F.col("_len") >= max(min_length, max_edits + 1))
    index, probes, own = segment_rows(max_edits)
    stored = sized.select("id", F.explode(index).alias("h"))
    asked = sized.select(F.col("id").alias("id2"), F.posexplode(probes).alias("_pos", "h")).select("id2", "h", F.col("_pos").isin(own).alias("own"))
    heavy = _small(stage(stored.groupBy("h").count().filter(F.col("count") > HEAVY).select("h", F.lit(True).alias("heavy")), "heavy"))
    # probes of heavy segments meet nothing here: they go through, dealt by their line
    marked = asked.join(heavy, "h", "left").withColumn("key", F.when(F.col("heavy"), F.xxhash64("id2", "h")).otherwise(F.col("h")))
    light = stored.join(heavy, "h", "left_anti").select(F.col("h").alias("key"), "id")
    met = stage(marked.join(light, "key", "left").filter("heavy or id <> id2").select("heavy", "h", "own", "id", "id2"), "met")
    pairs = stage(met.filter("heavy is null").select(*_ordered("id", "id2")).distinct(), "line-pairs")
    members = stage(met.filter("heavy").select("h", F.col("id2").alias("id"), "own").distinct(), "members")
    ids = stage(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).union(members.select("id")).distinct(), "line-ids")
    texts = firsts.select(F.xxhash64("_line").alias("id"), "_first", "_line").join(_small(ids), "id", "left_semi")
    texts = stage(texts.withColumn("counts", letter_counts()), "line-texts")
    near = stage(_later(pairs, texts, max_edits), "near-lines")
    if members.isEmpty():
        return near
    placed = stage(members.join(texts.select("id", "_first", "counts"), "id"), "placed")
    pivots = placed.filter("own").groupBy("h").agg(F.min(F.struct("_first", "id"))["id"].alias("pivot"))
    first_round = members.join(pivots, "h").filter("id <> pivot").select(*_ordered("id", "pivot")).distinct()
    near = stage(near.union(_later(first_round, texts, max_edits)).distinct(), "near-lines")
    open_ = stage(placed.join(near.withColumn("gone", F.lit(True)), "_first", "left").withColumn("gone", F.coalesce("gone", F.lit(False))), "open")
    one = open_.filter("own").select("h", F.col("id").alias("x"), F.col("_first").alias("fx"), F.col("counts").alias("cx"), F.col("gone").alias("gx"))
    two = open_.select("h", F.col("id").alias("y"), F.col("_first").alias("fy"), F.col("counts").alias("cy"), F.col("gone").alias("gy"))
    # only pairs whose later line is still open
    ask = (F.col("x") != F.col("y")) & F.when(F.col("fx") < F.col("fy"), ~F.col("gy")).otherwise(~F.col("gx")) & (counts_apart("cx", "cy") <= 2 * max_edits)
    second_round = one.join(two, "h").filter(ask).select(*_ordered("x", "y")).distinct()
    return near.union(_later(second_round, texts, max_edits)).distinct()


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS, min_length: int = MIN_LENGTH) -> DataFrame:
    """Staged distinct lines (_first, _line, _n, _near): the first place of a line is kept unless ``_near``; others go."""
    firsts = stage(first_lines(split_lines(docs, id_col, text_col)), "first-lines", "zstd")
    near = near_earlier(firsts, max_edits, min_length).withColumn("_near", F.lit(True))
    return firsts.join(stage(near, "near-lines"), "_first", "left").withColumn("_near", F.coalesce("_near", F.lit(False)))


def count_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, n_kept, n_near): per row of ``docs``, its lines, those that stay, and first lines that go as near.

    White-space lines count as lines that stay.
    """
    marked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_id"), F.unhex(F.md5(F.col(text_col).cast("string"))).alias("_doc"),
        F.split(F.col(text_col).cast("string"), "\n", -1).alias("_all"),
    ).select(
        "doc_id", "_id", "_doc", F.coalesce(F.size("_all"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("_all").isNull(), 0).otherwise(F.size(F.filter("_all", lambda x: ~is_solid(x)))).cast("long").alias("_blank"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    per = (
        line_decisions(docs, id_col, text_col, **options).groupBy(F.col("_first")["_id"].alias("_id"), F.col("_first")["_doc"].alias("_doc"))
        .agg(F.sum((~F.col("_near")).cast("long")).alias("_kept"), F.sum(F.col("_near").cast("long")).alias("_gone"))
    )
    return marked.join(per, ["_id", "_doc"], "left").select(
        "doc_id", "n_lines", (F.col("_blank") + F.coalesce("_kept", F.lit(0))).alias("n_kept"), F.coalesce("_gone", F.lit(0)).alias("n_near")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with the lines that stay; all columns and rows of ``docs`` are kept."""
    kept = line_decisions(docs, id_col, text_col, max_edits, min_length).filter(~F.col("_near")).select(
        F.col("_first")["_id"].alias("_id"), F.col("_first")["_doc"].alias("_doc"), F.col("_first")["_no"].alias("_no"), "_line"
    )
    blank = split_lines(docs, id_col, text_col).filter(~is_solid(F.col("_line"))).dropDuplicates(["_id", "_doc", "_no"])
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_no", "_line"))), lambda x: x["_line"]), "\n")
    texts = kept.unionByName(blank.select("_id", "_doc", "_no", "_line")).groupBy("_id", "_doc").agg(joined.alias("_kept"))
    packed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_id"), F.unhex(F.md5(F.col(text_col).cast("string"))).alias("_doc"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row"),
    )
    whole = packed.join(texts, ["_id", "_doc"], "left")
    text = F.when(F.col("_doc").isNull(), F.lit(None)).otherwise(F.coalesce("_kept", F.lit(""))).cast("string")
    return whole.select(*[text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
