"""Licence notices: lines compared with templates by Dice coefficient over word bigrams.

Lines and templates are normalised alike (A-Z lower-cased, runs of ASCII letters and digits as
words). The coefficient is 2 * distinct common bigrams / (bigrams of the line + bigrams of the
template). A coefficient of t needs sizes within a factor t / (2 - t) of each other, so a line is
compared only with templates in that range, and lines outside the range of all templates go no
further than the count of their words. Before that, a document must hold one of a few bigrams
without which no line can reach the threshold. DataFrame functions only.

Defined cases: null and empty texts, and lines of fewer than two words, match nothing; of equal
coefficients the template last in code point order wins; every row of ``docs`` gives one row of
``scanned``; rows that share a doc_id (null included) report the notices of all of them.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
# Public licence notices, name and text.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU Affero General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
                         "not use this file except in compliance with the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it "
                      "under the terms of the GNU General Public License as published by the Free "
                      "Software Foundation, either version 3 of the License, or (at your option) "
                      "any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
           "or without fee is hereby granted, provided that the above copyright notice and this "
           "permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                 "this software and associated documentation files (the \"Software\"), to deal in "
                 "the Software without restriction, including without limitation the rights to "
                 "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
                 "of the Software, and to permit persons to whom the Software is furnished to do "
                 "so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
               "2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[0-9a-z]+"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def telltale_bigrams(templates: dict[str, str], threshold: float) -> list[str]:
    """Bigrams of which every matching line has at least one.

    A line reaches the threshold with a template of n bigrams only by sharing ``least`` of them,
    so any n - least + 1 of them will do; the longest ones are the rarest.
    """
    chosen: set[str] = set()
    for text in templates.values():
        own = sorted(set(template_bigrams(text)), key=lambda b: (-len(b), b))
        least = math.ceil(threshold * len(own) / (2 - threshold) - 1e-9)
        chosen.update(own[:len(own) - least + 1])
    return sorted(chosen)


def _suspects(docs: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """Documents with a telltale bigram: one pattern over the text, before lines are cut out."""
    gap = "[^0-9a-z]+"
    grams = "|".join(b.replace(" ", gap) for b in telltale_bigrams(templates, threshold))
    pattern = f"(?<![0-9a-z])(?:{grams})"
    return docs.filter(F.lower("text").rlike(pattern))


def _best(templates: dict[str, str], threshold: float) -> Column:
    """Best (dice, template) of a line from its words, null below the threshold."""
    words, n = F.col("words"), F.size("words") - 1
    grams = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    reach = threshold / (2 - threshold)

    def score(line: Column) -> Column:
        scores = []
        for name, text in sorted(templates.items()):
            own = template_bigrams(text)
            near = (n >= len(own) * reach) & (n <= len(own) / reach)
            common = F.size(F.array_intersect(line, F.array(*map(F.lit, own))))
            scores.append(F.struct(
                F.when(near, common * 2.0 / (n + len(own))).otherwise(0.0).alias("dice"),
                F.lit(name).alias("template")))
        return F.array_max(F.array(*scores))

    # The one-element transform keeps the bigrams from being built once per template.
    return F.transform(F.array(grams), score)[0]


def matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
            threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line_no, template, dice) of every line that reaches the threshold."""
    suspects = _suspects(docs.select("doc_id", "text"), templates, threshold)
    return _matched(suspects.select("doc_id", F.split("text", "\n").alias("lines")), templates,
                    threshold)


def _matched(lines: DataFrame, templates, threshold: float) -> DataFrame:
    reach = threshold / (2 - threshold)
    sizes = [len(template_bigrams(t)) for t in templates.values()]
    carried = [c for c in lines.columns if c != "lines"]
    count = F.regexp_count("line", F.lit(WORD)) - 1
    return (lines.select(*carried, F.posexplode("lines").alias("line_no", "line"))
            .withColumn("line", F.translate("line", _UPPER, _LOWER))
            .filter((count >= min(sizes) * reach) & (count <= max(sizes) / reach))
            .withColumn("words", F.regexp_extract_all("line", F.lit(WORD), F.lit(0)))
            .withColumn("best", _best(templates, threshold))
            .filter(F.col("best.dice") >= threshold)
            .select(*carried, "line_no", F.col("best.template").alias("template"),
                    F.col("best.dice").alias("dice")))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
            threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_notices, templates (distinct, sorted, joined by comma) and best_dice of every row.

    Only ids of lines that match are grouped; a document id that several rows share reports the
    notices of all of them.
    """
    found = (matches(docs, templates, threshold).groupBy("doc_id")
             .agg(F.count("*").alias("n"), F.array_sort(F.collect_set("template")).alias("names"),
                  F.max("dice").alias("dice"))
             .select(F.col("doc_id").alias("id"), "n", "names", "dice"))
    return (docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
                    F.coalesce(F.array_join("names", ","), F.lit("")).alias("templates"),
                    F.coalesce("dice", F.lit(0.0)).alias("best_dice")))
