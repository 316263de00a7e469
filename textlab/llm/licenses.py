"""Operator 3: licence scan by the Dice coefficient over word bigrams. Native.

A text's units are its lines, its paragraphs (split at empty lines) and the
whole. Each unit and each template is normalised to lower-case words; the score
is 2 |A n B| / (|A| + |B|) over the sets of word bigrams. Two exact bounds spare
work: a unit can reach the threshold t with a template of b bigrams only if its
own bigrams number between b t / (2 - t) and b (2 - t) / t, and only if it shares
at least b t / (2 - t) of them. From the second follows a third, checked on the
lower-case text before anything is normalised: a unit must hold certain words of
a template (``anchors``), or too many of its bigrams are missing.

Nulls: a null or empty text has no unit and gives no row. Long texts are taken
whole. Of equal units of a text the first is reported once; a tie between
templates goes to the first name. Repeated rows give repeated rows, an empty
table an empty one; further columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices of well-known licences, in normal form apart from case.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)

#: Words of nearly every text: anchors only where no others do. They change no result.
COMMON = frozenset("a an and any are as at by for in is it may not of on or that the this to under with you".split())


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(grams: list[str], need: int) -> tuple[list[str], bool]:
    """(words, all): words of a template of which a unit that shares ``need`` of
    its bigrams holds all, or else at least one."""
    pairs = [g.split(" ") for g in grams]

    def left(missing: set[str]) -> int:
        return sum(not missing & set(p) for p in pairs)

    words = sorted({w for p in pairs for w in p}, key=lambda w: (w in COMMON, -len(w), w))
    if each := [w for w in words if left({w}) < need]:
        return each, True
    some: list[str] = []
    while left(set(some)) >= need:
        some.append(words[len(some)])
    return some, False


def holds_anchors(text: Column, wanted: list[tuple[list[str], bool]]) -> Column:
    """Whether the words of some template are in the text. The lower-case text
    is bound by ``exists``, so that it is made once for all the comparisons."""
    return F.exists(F.array(F.lower(text)), lambda low: reduce(or_, [
        reduce(and_ if every else or_, [F.contains(low, F.lit(w)) for w in words]) for words, every in wanted]))


def scan_licenses(docs: DataFrame, threshold: float = 0.8, templates=TEMPLATES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, license, shared, unit_bigrams, template_bigrams, unit_text),
    one row for each unit of a document that reaches the threshold; ``unit`` is
    the number of its first line (0-based), paragraphs after lines after that."""
    t = Fraction(str(threshold))
    known = [(name, g) for name, text in templates if (g := template_bigrams(text))]
    low, high = t / (2 - t), (2 - t) / t
    least = min(math.ceil(len(g) * low) for _, g in known)
    most = max(math.floor(len(g) * high) for _, g in known)
    wanted = [anchors(g, math.ceil(len(g) * low)) for _, g in known]
    vocabulary = sorted({b for _, g in known for b in g})
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines, paragraphs = F.split(text, "\n"), F.split(text, r"\n[ \t]*\n\s*")
    distinct = F.array_distinct(F.concat(
        lines, F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast("array<string>")), F.array(text)))
    numbered = F.transform(distinct, lambda u, i: F.struct(i.alias("unit"), u.alias("unit_text")))
    units = (docs.where(holds_anchors(text, wanted))
        .select(F.col(id_col).alias("doc_id"),
                F.explode(F.filter(numbered, lambda x: holds_anchors(x["unit_text"], wanted))).alias("u"))
        .select("doc_id", "u.unit", "u.unit_text")
        # n bigrams take n + 1 words of a character or more and n separators.
        .where(F.length("unit_text") >= 2 * least + 1))
    # Words lie between single separators after normalising, so counting them first prunes by size cheaply.
    norm = F.trim(F.regexp_replace(F.lower("unit_text"), r"[^\p{L}\p{N}]+", " "))
    sized = units.withColumn("norm", norm).where(
        (F.length("norm") - F.length(F.translate("norm", " ", "")) >= least))
    pairs = sized.select("doc_id", "unit", "unit_text", F.split("norm", " ").alias("w")).select(
        "doc_id", "unit", "unit_text",
        F.array_distinct(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1),
                                    lambda a, b: F.concat_ws(" ", a, b))).alias("b"))
    near = pairs.select(
        "doc_id", "unit", "unit_text", F.size("b").alias("unit_bigrams"),
        F.filter("b", lambda x: x.isin(vocabulary)).alias("hits")).where(
        F.col("unit_bigrams").between(least, most) & (F.size("hits") >= least))
    scored = []
    for name, g in known:
        shared = F.size(F.array_intersect("hits", F.array(*map(F.lit, g))))
        reach = (2 * shared * t.denominator >= t.numerator * (F.col("unit_bigrams") + len(g))) & \
            F.col("unit_bigrams").between(math.ceil(len(g) * low), math.floor(len(g) * high))
        scored.append(F.when(reach, F.struct(
            (shared * 2.0 / (F.col("unit_bigrams") + len(g))).alias("dice"), F.lit(name).alias("license"),
            shared.alias("shared"), F.lit(len(g)).alias("template_bigrams"))))
    best = F.aggregate(
        F.array(*scored), F.lit(None).cast("struct<dice:double,license:string,shared:int,template_bigrams:int>"),
        lambda acc, x: F.when(acc.isNull() | (x["dice"] > acc["dice"]) |
                              ((x["dice"] == acc["dice"]) & (x["license"] < acc["license"])), x).otherwise(acc))
    return near.withColumn("m", best).where("m is not null").select(
        "doc_id", "unit", F.col("m.license").alias("license"), F.col("m.shared").alias("shared"),
        "unit_bigrams", F.col("m.template_bigrams").alias("template_bigrams"), "unit_text")
