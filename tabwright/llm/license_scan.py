"""Licence notices found by the Dice coefficient over word bigrams: lines, whole texts and runs of words inside them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import let

#: Wordings of common licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ],
}

#: From this many letters on a word of a template is taken to be rare enough to look for alone.
LONGER_WORD = 5


def words(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", -1), lambda w: w != "")


def bigrams(tokens: Column) -> Column:
    """The distinct word bigrams."""
    return let(tokens, lambda w: F.array_distinct(F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))).otherwise(F.array().cast("array<string>"))))


def sizes(n: int, least: float) -> range:
    """Bigram counts that a text may have to reach Dice ``least`` with a template of ``n`` bigrams."""
    return range(max(1, math.ceil(least / (2 - least) * n - 1e-9)), math.floor((2 - least) / least * n + 1e-9) + 1)


def pairs_in_order(tokens: Column) -> Column:
    """All word bigrams in the order of the text, repeats included."""
    return let(tokens, lambda w: F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))).otherwise(F.array().cast("array<string>")))


def patterns(spark: SparkSession, templates: dict[str, list[str]]) -> list[Row]:
    """(``license``, ``template_no``, ``pattern``) of every template; one of one word or none is refused."""
    notices = spark.createDataFrame([(name, i, t) for name, texts in templates.items() for i, t in enumerate(texts)], "license string, template_no long, wording string")
    notices = notices.select("license", "template_no", bigrams(words(F.col("wording"))).alias("pattern")).collect()
    if any(not r.pattern for r in notices):
        raise ValueError("a template needs two words at least")
    return notices


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``scan_units`` and ``scan_runs`` together; ``line_no`` is null for runs, ``first_word`` and ``n_words`` for units."""
    units = scan_units(docs, templates, least, id_col, text_col)
    units = units.select(id_col, "line_no", F.lit(None).cast("int").alias("first_word"), F.lit(None).cast("int").alias("n_words"), "license", "template_no", "dice")
    runs = scan_runs(docs, templates, least, id_col, text_col)
    return units.unionAll(runs.select(id_col, F.lit(None).cast("long").alias("line_no"), "first_word", "n_words", "license", "template_no", "dice"))


def scan_runs(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ``first_word`` from 1, ``n_words``, ``license``, ``template_no``, ``dice``): the best run of words of a text for every template that it reaches.

    Words run on over line ends, so notices are found that are wrapped over lines or stand inside a paragraph. A run reaches from
    the start of a stretch of template bigrams to the end of one, and has no more words than a text of the largest admissible
    bigram count: cutting other words off the ends of a run, or adding template bigrams to them, never lowers its Dice, so no run
    of such words does better unless bigrams repeat in it. Ties go to the earlier, then the shorter run.

    Pruning is by size alone. A run of Dice ``least`` lacks so few of a template's bigrams that it holds at least one of any
    group of one more; the longest bigrams of the template are that group, and a text without them never meets the template. Runs with
    fewer hits than the smallest admissible size are left out before they are compared. Texts are not shuffled and no two of them meet.
    Null and empty texts give no row; repeated rows are scanned each.
    """
    table = []
    for r in patterns(docs.sparkSession, templates):
        admissible = sizes(len(r.pattern), least)
        marks = sorted(r.pattern, key=lambda b: (-len(b), b))[: len(r.pattern) - admissible[0] + 1]
        table.append((r.license, r.template_no, r.pattern, marks, admissible[0], admissible[-1]))
    strings = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    known = F.array(*[F.struct(*[e.alias(n) for n, e in zip(("license", "template_no", "pattern", "marks", "fewest", "most"), (F.lit(a), F.lit(b).cast("long"), strings(c), strings(d), F.lit(e), F.lit(f)))]) for a, b, c, d, e, f in table])
    every_mark = strings(sorted({m for r in table for m in r[3]}))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def runs(t: Column, hits: Column, starts: Column, ends: Column) -> Column:
        """Runs (first bigram, number of bigrams) that size admits; starts and ends of stretches are indices of hits."""
        length = lambda start, end: F.get(hits, end) - F.get(hits, start) + 1
        of = lambda start, j: F.transform(F.filter(F.slice(ends, j + 1, t["most"]), lambda end: (length(start, end) <= t["most"]) & (end - start + 1 >= t["fewest"])), lambda end: F.struct(F.get(hits, start).alias("first"), length(start, end).alias("length")))
        return F.flatten(F.transform(starts, of))

    def best(b: Column, t: Column) -> Column:
        """(-Dice, first bigram, number of bigrams) of the best run; null without one."""
        hits = F.filter(upto(F.size(b)), lambda i: F.array_contains(t["pattern"], F.get(b, i)))
        starts = lambda h: F.filter(upto(F.size(h)), lambda k: (k == 0) | (F.get(h, k - 1) < F.get(h, k) - 1))
        ends = lambda h: F.filter(upto(F.size(h)), lambda k: (k == F.size(h) - 1) | (F.get(h, k + 1) > F.get(h, k) + 1))
        dice = lambda w: 2.0 * F.size(F.array_intersect(w, t["pattern"])) / (F.size(F.array_distinct(w)) + F.size(t["pattern"]))
        valued = lambda r: F.struct((-let(F.slice(b, r["first"] + 1, r["length"]), dice)).alias("minus"), r["first"].alias("first"), r["length"].alias("length"))
        return let(hits, lambda h: let(starts(h), lambda s: let(ends(h), lambda e: F.array_min(F.transform(runs(t, h, s, e), valued)))))

    # One generator from text to rows: all that is named in it is computed once, and no filter can move into it.
    valued = lambda b: F.transform(F.filter(known, lambda t: F.arrays_overlap(b, t["marks"])), lambda t: F.struct(t["license"].alias("license"), t["template_no"].alias("template_no"), best(b, t).alias("best")))
    reached = let(pairs_in_order(words(F.col("__text"))), lambda b: F.when(F.arrays_overlap(b, every_mark), F.filter(valued(b), lambda m: m["best"]["minus"] <= -least)))
    # A mark with a longer word is looked for by that word, the others as they stand, so that a text without any need not be cut into words.
    marks = {m: max(m.split(), key=lambda w: (len(w), w)) for r in table for m in r[3]}
    parts = {w for w in marks.values() if len(w) >= LONGER_WORD}
    parts = strings(sorted(w for w in parts if not any(v != w and v in w for v in parts)))
    short = "|".join(sorted("[^a-z0-9]+".join(m.split()) for m, w in marks.items() if len(w) < LONGER_WORD))
    hopeful = let(F.lower("__text"), lambda x: F.exists(parts, lambda w: F.contains(x, w)) | (F.rlike(x, F.lit(short)) if short else F.lit(False)))
    found = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(hopeful).select("__id", F.explode(reached).alias("m"))
    best_run = F.col("m.best")
    return found.select(F.col("__id").alias(id_col), (best_run["first"] + 1).alias("first_word"), (best_run["length"] + 1).alias("n_words"), "m.license", "m.template_no", (-best_run["minus"]).alias("dice"))


def scan_units(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ``line_no``, ``license``, ``template_no``, ``dice``) of every text unit that reaches ``least`` with a template.

    Units are all lines of the whole text (from 1) and, for texts of several lines, the whole text (line 0). A unit meets only
    templates whose size admits ``least``: units with too few words or too many distinct ones for any template go first, and the templates are laid out by admissible bigram count and joined on the unit's
    count. That table is as long as the caller's templates, never as the data, so it is broadcast; the texts are not shuffled.
    Null and empty texts have no units with bigrams and give no row; repeated rows are scanned each; a template of one word or none is refused.
    """
    spark = docs.sparkSession
    notices = patterns(spark, templates)
    by_size = [(n, r.license, r.template_no, r.pattern) for r in notices for n in sizes(len(r.pattern), least)]
    table = spark.createDataFrame(by_size, "n int, license string, template_no long, pattern array<string>")
    fewest, most = min(r[0] for r in by_size), max(r[0] for r in by_size)
    lines = F.transform(F.split(F.coalesce(F.col("__text"), F.lit("")), "\n", -1), words)
    units = let(lines, lambda x: F.when(F.size(x) > 1, F.concat(F.array(F.flatten(x)), x)).otherwise(F.concat(F.array(F.array().cast("array<string>")), x)))
    numbered = F.transform(units, lambda w, i: F.struct(i.cast("long").alias("line_no"), w.alias("w")))
    # Bigrams are one fewer than words at most and one fewer than distinct words at least.
    admissible = F.filter(numbered, lambda u: (F.size(u["w"]) > fewest) & (F.size(F.array_distinct(u["w"])) <= most + 1))
    found = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).select("__id", F.explode(admissible).alias("u"))
    found = found.select("__id", "u.line_no", bigrams(F.col("u.w")).alias("__b"))
    found = found.select("__id", "line_no", "__b", F.size("__b").alias("n")).join(F.broadcast(table), "n")
    dice = 2.0 * F.size(F.array_intersect("__b", "pattern")) / (F.col("n") + F.size("pattern"))
    return found.select(F.col("__id").alias(id_col), "line_no", "license", "template_no", dice.alias("dice")).filter(F.col("dice") >= least)
