"""Texts cut off by a field's limit or in mid-transfer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.session import materialize

# White space and invisible characters that may trail a text.
TRAILING = " \t\n\r\x0b\x0c      ​‌‍   　﻿"
# What ends a sentence, what may stand behind that, and an ellipsis that ends a text.
SENTENCE_END = r"[.!?。！？؟।]"
BEHIND_END = r"[\"'»”’」』)\]]*"
ELLIPSIS = r"(\.\.\.|…)$"
COMPLETE_BEFORE_ELLIPSIS = r"[!?。！？]\s*(\.\.\.|…)$|\.\s*…$|\.\s+\.\.\.$|\.{4}$"

PROSE, LIST, ROW, HEADING, BRACKET, EMPTY = "prose", "list", "row", "heading", "bracket", "empty"


def _count(c: Column, part: str) -> Column:
    return F.floor((F.octet_length(c) - F.octet_length(F.replace(c, F.lit(part), F.lit("")))) / len(part.encode()))


# classes of bytes that add to a length: one for each character below, one each for the lead bytes
# of characters of two or three bytes and of four, and one for the other bytes of such characters
NEWLINE, QUOTE, AND, ANGLE, APOSTROPHE, BACKSLASH, CONTROL, BEYOND, ASTRAL, INSIDE = range(1, 11)
_CLASS = np.zeros(256, np.uint8)
for _text, _kind in (("\n", NEWLINE), ('"', QUOTE), ("&", AND), ("<>", ANGLE), ("'", APOSTROPHE), ("\\", BACKSLASH), ("\r\t", CONTROL)):
    _CLASS[list(_text.encode())] = _kind
_CLASS[0x80:0xC0], _CLASS[0xC0:0xF0], _CLASS[0xF0:] = INSIDE, BEYOND, ASTRAL
_PIECE = 1 << 22


def _classes(texts: pa.Array) -> np.ndarray:
    """Bytes of each class in each text (texts x 11), NULL as the empty text; in pieces of a few megabytes, or of one text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    out, n = np.zeros((len(texts), 11), np.int64), len(texts)
    if not n:
        return out
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _PIECE, "right")) - 1)
        kinds = _CLASS[data[ends[lo] : ends[hi]]]
        at = np.flatnonzero(kinds)
        row = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))[at]
        out[lo:hi] = np.bincount(row * 11 + kinds[at], minlength=(hi - lo) * 11).reshape(-1, 11)
        out[lo:hi, 0] = np.diff(ends[lo : hi + 1])  # all bytes
        lo = hi
    return out


ENCODINGS = ("chars", "utf8", "utf16", "xml", "xml_utf8", "html", "html_utf8", "json", "json_utf8", "json_ascii", "crlf", "crlf_utf8")


@F.arrow_udf(T.StructType([T.StructField(k, T.LongType()) for k in ENCODINGS]))
def _lengths(texts: pa.Array) -> pa.Array:
    c = _classes(texts).T
    utf8, lines, beyond, astral = c[0], c[NEWLINE], c[BEYOND] + c[ASTRAL], c[ASTRAL]
    chars = utf8 - c[INSIDE]
    xml = c[AND] * 4 + c[ANGLE] * 3
    html = xml + c[QUOTE] * 5 + c[APOSTROPHE] * 4
    json = c[QUOTE] + c[BACKSLASH] + lines + c[CONTROL]
    kinds = {
        "chars": chars, "utf8": utf8, "utf16": chars + astral,
        "xml": chars + xml, "xml_utf8": utf8 + xml, "html": chars + html, "html_utf8": utf8 + html,
        "json": chars + json, "json_utf8": utf8 + json, "json_ascii": chars + json + beyond * 5 + astral * 6,
        "crlf": chars + lines, "crlf_utf8": utf8 + lines,
    }
    return pa.StructArray.from_arrays([pa.array(kinds[k]) for k in ENCODINGS], list(ENCODINGS))


def length_encodings(c: Column) -> dict[str, Column]:
    """The length that a text has, or had before its export, under each way a field may be stored.

    All of them follow from the bytes of a few classes, counted in one pass over Arrow batches.
    """
    lengths = _lengths(c)
    return {k: lengths[k] for k in ENCODINGS}


def inspect_ending(c: Column) -> dict[str, Column]:
    """``line`` (the last one), ``form`` (what kind of line it is) and ``ending``: whole, cut or unsure.

    ``unsure`` are endings that only other evidence can settle: a line that ends in a letter or
    digit could be a fixed last line, a plain list item could be cut, and a last bracket of two
    could be missing because of a cut or of broken markup.
    """
    text = F.rtrim(c, F.lit(TRAILING))
    line = F.trim(F.substring_index(text, "\n", -1), F.lit(TRAILING))
    opens, closes = _count(line, "["), _count(line, "]")
    braces = _count(line, "{") - _count(line, "}")
    has = lambda r: line.rlike(r)
    form = (
        F.when(line == "", EMPTY)
        .when(has(r"^#\p{L}+\s*:?\s*\[\["), BRACKET)
        .when(has(r"^[*#:;]"), LIST)
        .when(has(r"^(\{\||[|!])") & ~has(r"^\|\}"), ROW)
        .when(has(r"^(\|\}|\}+)\s*$"), EMPTY)
        .when(has(r"^="), HEADING)
        .when(has(r"^\[\[[^\[\]]*\]?$") | has(r"^\[?$") | has(r"^(\[\[[^\[\]]*\]\]?\s*)+$"), BRACKET)
        .when(has(r"^\{") & (has(r"\}$") | (braces > 0)), BRACKET)
        .otherwise(PROSE)
    )
    # templates and references behind a sentence don't count
    bare = F.regexp_replace(line, r"(?i)(\s*(\{\{([^{}]|\{+[^{}]*\}+)*\}\}|<ref[^<>]*>[^<]*</ref>|<nowiki>[^<]*</nowiki>|<ref[^<>]*/>))+$", "")
    ended = bare.rlike(SENTENCE_END + BEHIND_END + "$") | (F.rtrim(bare) == "")
    inside_ref = has(r"(?i)<ref[^<>/]*>[^<]{0,200}$") & (~ended | has(r"p+\. \p{N}+\.$"))
    letter = has(r"[\p{L}\p{N}]$")
    item_open = (F.locate("[[", F.substring_index(line, "]", -1)) > 0) | has(r"\[$") | (F.locate("(", F.substring_index(line, ")", -1)) > 0) | (braces > 0)
    by_form = (
        F.when(form == EMPTY, "whole")
        .when(form == LIST, F.when(item_open | inside_ref, "cut").when(has(r"^[*#:;]+\s*$"), "cut").when(letter | has(r"[^\]]\]$"), "unsure").otherwise("whole"))
        .when(form == ROW, F.when(has(r"\]\]$") & ~has(r"^!"), "unsure").when(ended & ~has(r"\p{N}\.$"), "whole").otherwise("cut"))
        .when(form == HEADING, F.when(has(r"^(=+)[^=].*[^=]\1$") | ended, "whole").otherwise("cut"))
        .when((form == BRACKET) & has(r"^\{"), F.when(has(r"\}$") & (braces <= 0) | ended, "whole").when(has(r"\}$"), "unsure").otherwise("cut"))
        .when(form == BRACKET, F.when(has(r"\]\]$") | ended & (closes > 0), "whole").when(has(r"\]$") & (opens > closes), "unsure").otherwise("cut"))
        .otherwise(F.when(inside_ref, "cut").when(ended, "whole").when(letter & (braces <= 0) & (opens <= closes), "unsure").otherwise("cut"))
    )
    ending = F.when(has(ELLIPSIS), F.when(has(COMPLETE_BEFORE_ELLIPSIS), "whole").otherwise("cut")).when(has("�$"), "cut").otherwise(by_form)
    return {"line": line, "form": form, "ending": ending}


def _features(df: DataFrame, doc: str, text: str, source: str, group: str) -> DataFrame:
    c = F.col(text)
    rows = df.filter(c.isNotNull() & (F.rtrim(c, F.lit(TRAILING)) != ""))
    rows = rows.select(F.col(doc).alias("doc"), F.col(source).alias("source"), F.col(group).alias("page"), F.xxhash64(c).alias("hash"), F.struct(*[v.alias(k) for k, v in length_encodings(c).items()]).alias("len"), *[v.alias(k) for k, v in inspect_ending(c).items()])
    # runs of digits are one: fixed lines count passes and the like
    line = F.when(F.col("ending") != "whole", F.regexp_replace("line", r"\p{N}+", "0"))
    rows = materialize(rows.select("doc", "source", "page", "hash", *[F.col(f"len.{k}").alias(f"len_{k}") for k in ENCODINGS], line.alias("line"), "form", "ending"), "endings")
    # pages of one text are one piece of evidence, so that a table repeated under other ids tells no more than itself
    pages = rows.groupBy("hash").agg(F.min("page").alias("grp"))
    return materialize(rows.join(pages, "hash").drop("hash", "page"), "features")


def storage_limits(features: DataFrame, least: int = 4, times: float = 10.0, near: int = 30) -> DataFrame:
    """Hidden limits: ``(source, encoding, limit, n_groups, expected)``.

    A length under an encoding is a limit of a source if groups (pages) reach it far more often than
    the lengths near it: at least ``least`` more than ``times`` their mean. A text at several such
    lengths counts for the one most reached, so that a limit on characters isn't listed again under
    every encoding that adds a fixed number to most texts. NULL sources have no limits.
    """
    kinds = [c for c in features.columns if c.startswith("len_")]
    long = features.filter(F.col("source").isNotNull()).select("source", "grp", F.explode(F.array(*[F.struct(F.lit(k[4:]).alias("encoding"), F.col(k).alias("length")) for k in kinds])).alias("e")).select("source", "grp", "e.*")
    # groups, not texts: a text restored many times is one piece of evidence
    counts = long.groupBy("source", "encoding", "length", "grp").agg(F.lit(1).alias("one")).groupBy("source", "encoding", "length").agg(F.count(F.lit(1)).alias("n_groups"))
    w = Window.partitionBy("source", "encoding").orderBy("length").rangeBetween(-near, near)
    spikes = counts.withColumn("expected", (F.sum("n_groups").over(w) - F.col("n_groups")) / (2.0 * near)).filter(F.col("n_groups") >= least + times * F.col("expected"))
    own = long.join(spikes, ["source", "encoding", "length"])
    first = {k[4:]: i for i, k in enumerate(kinds)}
    place = F.element_at(F.create_map(*[x for k, i in first.items() for x in (F.lit(k), F.lit(-i))]), F.col("encoding"))
    best = own.groupBy("source", "grp").agg(F.max(F.struct("n_groups", place.alias("place"), "encoding", "length", "expected")).alias("b"))
    return best.groupBy("source", F.col("b.encoding").alias("encoding"), F.col("b.length").alias("limit")).agg(F.max("b.n_groups").alias("n_groups"), F.max("b.expected").alias("expected"), F.count(F.lit(1)).alias("own")).filter(F.col("own") >= least).drop("own")


def fixed_lines(endings: DataFrame, least: int = 2, length: int = 8, near: int = 64) -> DataFrame:
    """``(line)``: last lines that stand where texts end, not where something cut them.

    Cuts fall anywhere: where many texts share a sentence, they leave all of its beginnings alike. So
    a line of at least ``length`` characters is fixed if it ends texts of at least ``least`` groups
    away from every limit, and of more groups than all its beginnings and continuations of up to
    ``near`` characters together. Both sides grow alike with the corpus. ``endings`` has ``line, grp,
    free`` of prose that isn't whole.
    """
    per = endings.groupBy("line", "grp").agg(F.max("free").alias("free")).groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.sum("free").alias("n_free"))
    lines = materialize(per.withColumn("key", F.xxhash64("line")), "lines")
    sure = lines.filter((F.char_length("line") >= length) & (F.col("n_free") >= least))
    shorter = F.transform(F.sequence(F.greatest(F.char_length("line") - near, F.lit(1)), F.char_length("line") - 1), lambda i: F.xxhash64(F.substring(F.col("line"), F.lit(1), i)))
    begun = lambda df: df.filter(F.char_length("line") > 1).select("key", "n", F.explode(shorter).alias("start"))
    before = begun(sure).join(lines.select(F.col("key").alias("start"), F.col("n").alias("m")), "start").select("key", "m")
    after = begun(lines).join(sure.select(F.col("key").alias("start")), "start").select(F.col("start").alias("key"), F.col("n").alias("m"))
    around = before.unionByName(after).groupBy("key").agg(F.sum("m").alias("around"))
    return sure.join(around, "key", "left").filter(F.col("n_free") > F.coalesce("around", F.lit(0))).select("line")


def truncated_texts(df: DataFrame, doc: str, text: str, source: str, group: str, fixed_least: int = 2, fixed_length: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(judged, limits, features)``; judged has ``(doc, source, form, at_limit, truncated)`` of every text that isn't blank.

    Lengths under the encodings of :func:`length_encodings` expose each source's hidden limits
    (:func:`storage_limits`); then the last line is inspected. Endings that are cut or whole by
    themselves are so at any length: full texts that happen to have a limit's length are common. An
    unsure ending is settled by other texts and by the limits: prose is whole if its last line
    (digits aside) is a fixed one, which is told by texts away from the limits
    (:func:`fixed_lines`), and cut otherwise; a list item or bracket is cut only at a limit, and
    there not if a text away from the limits ends with the same line.

    NULL, empty and blank texts are no cases and get no row; a NULL source is a source without
    limits; repeated rows are each judged; an empty table gives no rows. Whole texts are read, once.
    """
    features = _features(df, doc, text, source, group)
    limits = materialize(storage_limits(features), "limits")
    kinds = [c for c in features.columns if c.startswith("len_")]
    # limits per source as a map encoding -> lengths: one row per source
    per = limits.groupBy("source").agg(F.collect_list(F.struct("encoding", "limit")).alias("limits"))
    # a cut between bytes of one character may fall short of the limit, or exceed it by a replacement character
    slack = lambda e, n, m: F.when(e.contains("utf8"), (n >= m - 3) & (n <= m + 2)).otherwise(n == m)
    own = F.create_map(*[x for k in kinds for x in (F.lit(k[4:]), F.col(k))])
    known = features.select("doc", "source", "grp", "line", "form", "ending", own.alias("own")).join(per, "source", "left")
    known = known.withColumn("at_limit", F.coalesce(F.exists("limits", lambda x: slack(x["encoding"], F.element_at(F.col("own"), x["encoding"]), x["limit"])), F.lit(False))).drop("own", "limits")
    free = F.when(F.col("at_limit"), 0).otherwise(1).alias("free")
    prose = F.col("form") == PROSE
    fixed = fixed_lines(known.filter(prose & (F.col("ending") != "whole")).select("line", "grp", free), fixed_least, fixed_length).withColumn("settled", F.lit(True))
    unsure = known.filter(F.col("ending") == "unsure")
    items = unsure.filter(~prose & ~F.col("at_limit")).select("line").distinct().withColumn("settled", F.lit(True))
    columns = ["doc", "source", "form", "at_limit", "truncated"]
    # a line that ends very many texts is a hot key on one side only, which the join may split
    judged = known.filter(F.col("ending") != "unsure").withColumn("truncated", F.col("ending") == "cut").select(*columns)
    judged = judged.unionByName(unsure.filter(prose).join(fixed, "line", "left").withColumn("truncated", F.col("settled").isNull()).select(*columns))
    judged = judged.unionByName(unsure.filter(~prose).join(items, "line", "left").withColumn("truncated", F.col("at_limit") & F.col("settled").isNull()).select(*columns))
    return judged.withColumnRenamed("doc", doc), limits, features
