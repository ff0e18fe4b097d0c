"""Line deduplication within one edit, by deletion-neighbourhood joins.

Two lines within one edit share a deletion variant: a line without one
character equals the other line (insertion), or both lines without the
character at the same place are equal (substitution).  Variants are hashed
keys; lines with an equal key meet in an aggregation that keeps the earliest
of them, so a key with many lines makes no pairs, and each line's earliest
partner is verified by its edit distance.

Writing out all variants of all lines would multiply the corpus by the length
of its lines.  So the places at which a line could differ from another one are
narrowed first, without loss: whatever lies outside the window that holds the
edit is equal in both lines.  A line keeps a window only if another line has
the same text outside it; windows are halved, then cut in ``PARTS``, until
they are at most ``WINDOW`` characters wide.  Variants are made for the places
in the windows that are left.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage, id_and_text

#: Lines of fewer characters are compared for equality only, if ``dedup_lines`` is not told another floor.
NEAR_CHARS = 16
WINDOW, PARTS = 16, 16
_BLANK = " \t\x0b\x0c\r"


def hash_pair(*columns: Column) -> list[Column]:
    """128 bits of the columns, as two longs ``k1, k2``."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("second"), *columns).alias("k2")]


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, line_no`` (from 0)``, line`` (without white space at its ends)."""
    found = id_and_text(docs, id_col, text_col).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return found.withColumn("line", F.btrim("line", F.lit(_BLANK)))


def place() -> Column:
    """Where a line stands; places compare by id, null ids last, then line."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("line_no"))


def outside(line: Column, length: Column, m: Column, a: Column, b: Column) -> Column:
    """Hash of what a line has outside window [a, b), counted in the ``m``
    characters of the shorter line of a pair."""
    return F.xxhash64(m, a, b, F.substring(line, F.lit(1), a), F.substring(line, length - (m - b) + 1, m - b))


def shared(windows: DataFrame) -> DataFrame:
    """The ``windows`` (``k1, k2, m, a, b, is_m, tag``) that another line
    shares, at least one of the lines being of length m."""
    tags = (windows.groupBy("tag").agg(F.count("*").alias("n"), F.sum(F.col("is_m").cast("int")).alias("s"))
            .where((F.col("n") > 1) & (F.col("s") > 0)).select(F.col("tag").alias("t")))
    return windows.join(tags, F.col("tag") == F.col("t"), "left_semi").select("k1", "k2", "m", "a", "b")


def narrowed(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """Windows cut in parts until none is wider than ``WINDOW``."""
    while (suspects.agg(F.max(F.col("b") - F.col("a"))).first()[0] or 0) > WINDOW:
        wide = suspects.where(F.col("b") - F.col("a") > WINDOW).join(texts, ["k1", "k2"])
        step = F.ceil((F.col("b") - F.col("a")) / F.lit(PARTS)).cast("int")
        parts = wide.select("k1", "k2", "m", "b", "len", "line", step.alias("step"),
                            F.explode(F.sequence(F.col("a"), F.col("b") - 1, step)).alias("a"))
        parts = parts.withColumn("b", F.least(F.col("a") + F.col("step"), F.col("b")))
        tagged = parts.select("k1", "k2", "m", "a", "b", (F.col("len") == F.col("m")).alias("is_m"),
                              outside(F.col("line"), F.col("len"), F.col("m"), F.col("a"), F.col("b")).alias("tag"))
        done = suspects.where(F.col("b") - F.col("a") <= WINDOW)
        suspects = cut_lineage(done.unionByName(shared(tagged)), "windows")
    return suspects


def variants(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """Variant keys: ``v1, v2, whole, exchanged, k1, k2, first``.  ``whole``:
    the key is that of the line itself; ``exchanged``: a character was struck
    out of a line of length m, else of the longer line."""
    rows = suspects.join(texts, ["k1", "k2"])
    is_m = F.col("len") == F.col("m")
    at = F.sequence(F.col("a"), F.when(is_m, F.col("b") - 1).otherwise(F.col("b")))
    struck = rows.select("k1", "k2", "first", "m", "line", is_m.alias("exchanged"), F.explode(at).alias("i"))
    rest = F.concat(F.substring(F.col("line"), F.lit(1), F.col("i")),
                    F.substring(F.col("line"), F.col("i") + 2, F.col("m") + 1))
    struck = struck.select("k1", "k2", "first", "exchanged", F.when(F.col("exchanged"), F.col("i")).otherwise(-1).alias("i"),
                           rest.alias("rest"), F.lit(False).alias("whole"))
    itself = rows.where(is_m).select("k1", "k2", "first", F.lit(False).alias("exchanged"), F.lit(-1).alias("i"),
                                     F.col("line").alias("rest"), F.lit(True).alias("whole")).distinct()
    v1, v2 = hash_pair(F.col("i"), F.col("rest"))
    return struck.unionByName(itself).select(v1.alias("v1"), v2.alias("v2"), "whole", "exchanged", "k1", "k2", "first")


def near_lines(classes: DataFrame, texts_of, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``k1, k2, keep``: lines that have an earlier line within one edit, and
    the place of the earliest (of different lines in one place, that with the smaller hash).  ``classes``: one row per distinct line;
    ``texts_of(suspects)`` gives their texts."""
    windows = classes.where(F.col("len") >= near_chars).select("k1", "k2", F.inline(F.array(*[
        F.struct((F.col("len") - d).alias("m"), F.lit(side).alias("left_equal"), F.lit(d == 0).alias("is_m"), F.col(f"tag{d}{int(side)}").alias("tag"))
        for d in (0, 1) for side in (False, True)])))
    half = F.floor(F.col("m") / 2).cast("int")
    windows = windows.select("k1", "k2", "m", F.when(F.col("left_equal"), half).otherwise(0).alias("a"),
                             F.when(F.col("left_equal"), F.col("m")).otherwise(half).alias("b"), "is_m", "tag")
    suspects = cut_lineage(shared(windows), "suspects")
    texts = texts_of(suspects)
    keys = cut_lineage(variants(narrowed(suspects, texts), texts), "variants")
    who = F.struct("first", "k1", "k2")
    met = keys.groupBy("v1", "v2").agg(F.min(F.when(F.col("whole"), who)).alias("w"), F.min(F.when(~F.col("whole"), who)).alias("v"))
    partner = F.when(F.col("exchanged") | F.col("whole"), F.col("v")).otherwise(F.col("w"))
    pairs = (keys.join(met, ["v1", "v2"]).withColumn("p", partner).where(F.col("p") < who)  # in one place the hashes decide
             .select("k1", "k2", F.col("p.k1").alias("p1"), F.col("p.k2").alias("p2"), F.col("p.first").alias("keep")).distinct())
    own = texts.select("k1", "k2", "line")
    theirs = texts.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("line").alias("other"))
    checked = pairs.join(own, ["k1", "k2"]).join(theirs, ["p1", "p2"]).where(F.levenshtein("line", "other", 1) >= 0)
    return checked.groupBy("k1", "k2").agg(F.min("keep").alias("keep"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """One row per line: ``doc_id, line_no, kept, keep_doc_id, keep_line_no``.

    A line goes if an earlier line (by id, then line number) equals it, or
    lies within one edit of it and both have at least ``near_chars`` (from 2) characters;
    ``keep_*`` is the place of the earliest such line, or its own.  It names the line
    that made this one go; that line may itself go for a still earlier one, within
    one edit of it but not of this one.  White space at the ends of a line does not count;
    blank lines stay; null texts are one blank line; null ids come last.  Rows that
    repeat an id, or have none, share their places: of equal lines in one place one
    stays (either, they cannot be told apart), of different ones that are near the one with the
    smaller hash.  Other columns are not read; an empty table gives an empty result.
    """
    if near_chars < 2:
        raise ValueError("any two lines of one character are within one edit")
    line, n = F.col("line"), F.char_length("line")
    tags = [outside(line, n, n - d, (F.floor((n - d) / 2) if side else F.lit(0)).cast("int"),
                    (n - d if side else F.floor((n - d) / 2)).cast("int")).alias(f"tag{d}{int(side)}")
            for d in (0, 1) for side in (False, True)]
    found = lines(docs, id_col, text_col)
    rows = found.where(line != "").select("doc_id", "line_no", *hash_pair(line), n.alias("len"), *tags,
                                          F.monotonically_increasing_id().alias("copy"))
    rows = cut_lineage(rows, "lines")
    tag_names = [f"tag{d}{s}" for d in (0, 1) for s in (0, 1)]
    classes = cut_lineage(rows.groupBy("k1", "k2", "len", *tag_names)
                          .agg(F.min(F.struct(place().alias("at"), "copy")).alias("f"), F.count("*").alias("n"))
                          .withColumns({"first": F.col("f.at"), "own": F.col("f.copy")}).drop("f"), "classes")

    def texts_of(suspects: DataFrame) -> DataFrame:
        wanted = suspects.select("k1", "k2").distinct().join(classes.select("k1", "k2", "len", "first"), ["k1", "k2"])
        at = [F.col("first.doc_id").alias("d"), F.col("first.line_no").alias("l")]
        texts = found.join(wanted.select("k1", "k2", "len", "first", *at),
                           F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")))
        # rows that repeat an id give a place several texts; the hash tells which is meant
        k1, k2 = hash_pair(F.col("line"))
        return cut_lineage(texts.where((F.col("k1") == k1) & (F.col("k2") == k2))
                           .select("k1", "k2", "len", "first", "line").dropDuplicates(["k1", "k2"]), "texts")

    near = near_lines(classes, texts_of, near_chars)
    told = classes.join(near, ["k1", "k2"], "left").where((F.col("n") > 1) | F.col("keep").isNotNull())
    told = cut_lineage(told.select("k1", "k2", F.coalesce("keep", "first").alias("keep"),
                                   F.when(F.col("keep").isNull(), F.col("own")).otherwise(-1).alias("stays")), "verdicts")
    mine = F.coalesce(F.col("keep"), place())
    kept = F.coalesce(F.col("stays") == F.col("copy"), F.lit(True))
    out = rows.select("doc_id", "line_no", "k1", "k2", "copy").join(told, ["k1", "k2"], "left").select(
        "doc_id", "line_no", kept.alias("kept"), mine["doc_id"].alias("keep_doc_id"), mine["line_no"].alias("keep_line_no"))
    blank = found.where(line == "").select("doc_id", "line_no", F.lit(True).alias("kept"), F.col("doc_id").alias("keep_doc_id"),
                                           F.col("line_no").alias("keep_line_no"))
    return out.unionByName(blank)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: the documents with only the lines that stay (one row
    per id; ids without lines that stay have an empty text)."""
    stay = dedup_lines(docs, id_col, text_col).where("kept").select("doc_id", "line_no").distinct()
    whole = id_and_text(docs, id_col, text_col).select(F.col("doc_id").alias("d"), F.split("text", "\n").alias("all")) \
        .dropDuplicates(["d"])
    numbers = stay.groupBy("doc_id").agg(F.sort_array(F.collect_list("line_no")).alias("numbers"))
    rows = whole.join(numbers, F.col("d").eqNullSafe(F.col("doc_id")), "left")
    text = F.array_join(F.transform(F.coalesce("numbers", F.array().cast("array<int>")), lambda i: F.get("all", i)), "\n")
    return rows.select(F.col("d").alias("doc_id"), text.alias("text"))
