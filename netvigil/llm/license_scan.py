"""Licence notices in texts, by the Dice coefficient over word bigrams.

A text is normalised (lower case, runs of other characters than letters and
digits become one space, "licence" becomes "license") and cut into units: its
lines, its paragraphs of several lines, and, if it has several paragraphs, the
whole. The bigrams of a unit and of a licence template are sets, and
dice = 2 * common / (unit + template). For dice >= t the sizes must satisfy
``t / (2 - t) <= unit / template <= (2 - t) / t``: units outside the bounds of
all templates are dropped before their bigrams are built (a unit with w words,
d of them distinct, has at most w - 1 and at least d - 1 bigrams), and a table
of all admissible (size, template) pairs, whose size depends on the templates
alone, joins each remaining unit to its candidates.

Only DataFrame expressions are used.

Results of ``scan`` (one row per unit that reaches the threshold):

* the best template counts, of equal ones the one with the smallest name, then the smallest number;
* null and empty texts and units of fewer than two words have no bigrams and never match;
* repeated rows are reported each for itself; null ids stay; an empty table gives an empty table;
* of the input only the two named columns are read, so other columns never clash.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import column_of, read_table

THRESHOLD = 0.8

# Names as they stand in notices. Every phrase below makes a template with every name.
NAMES = {
    "Apache-2.0": "the Apache License, Version 2.0",
    "MIT": "the MIT License",
    "BSD-2-Clause": "the BSD 2-Clause License",
    "BSD-3-Clause": "the BSD 3-Clause License",
    "GPL-2.0": "the GNU General Public License, version 2",
    "GPL-3.0": "the GNU General Public License, version 3",
    "LGPL-2.1": "the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "the GNU Affero General Public License, version 3",
    "MPL-2.0": "the Mozilla Public License, version 2.0",
    "EPL-2.0": "the Eclipse Public License, version 2.0",
    "ISC": "the ISC License",
    "CC0-1.0": "CC0 1.0 Universal",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
}
PHRASES = ("Licensed under {}.", "Released under {}.", "This work is licensed under {}.",
           "This file is distributed under the terms of {}.")
# Opening paragraphs of licence texts and of the notices that they ask for.
PARAGRAPHS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions:""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met:""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
        your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

NOT_WORD = r"[^\p{L}\p{N}\n]+"


def templates() -> list[tuple[int, str, str]]:
    """(number, licence, text) of all templates."""
    texts = [(name, phrase.format(text)) for name, text in NAMES.items() for phrase in PHRASES]
    return [(i, name, text) for i, (name, text) in enumerate(texts + list(PARAGRAPHS.items()))]


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower().replace("licence", "license")).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest number of bigrams of a unit that can reach the threshold with a template."""
    ratio = threshold / (2 - threshold)
    return max(1, math.ceil(size * ratio - 1e-9)), math.floor(size / ratio + 1e-9)


def candidates(spark: SparkSession, texts: list[tuple[int, str, str]], threshold: float) -> tuple[DataFrame, int, int]:
    """One row per template and admissible unit size, and the bounds over all templates."""
    rows, bounds = [], []
    for number, name, text in texts:
        bigrams = template_bigrams(text)
        bounds.append(size_bounds(len(bigrams), threshold))
        quoted = ", ".join(f"'{b}'" for b in bigrams)  # letters, digits and spaces only
        rows.append(f"({number}, '{name}', array({quoted}), {bounds[-1][0]}, {bounds[-1][1]})")
    table = spark.sql("SELECT explode(sequence(low, high)) AS size, number, license, template FROM VALUES "
                      f"{', '.join(rows)} AS t(number, license, template, low, high)")
    return table, min(low for low, _ in bounds), max(high for _, high in bounds)


def units(text: Column, low: int, high: int) -> Column:
    """Array of (unit, position, words) of a normalised text, without those outside the size bounds."""
    def cut(kind: str, parts: Column) -> Column:
        made = F.transform(parts, lambda body, i: F.struct(
            F.lit(kind).alias("unit"), (i + 1).alias("position"), F.split(F.trim(body, F.lit(" \n")), "[ \n]+").alias("words"),
            F.contains(F.trim(body, F.lit(" \n")), F.lit("\n")).alias("several")))
        return F.filter(made, lambda u: (F.size(u["words"]) - 1 >= low) & (F.size(F.array_distinct(u["words"])) - 1 <= high))

    paragraphs = F.split(text, r"\n(?: ?\n)+")
    whole = F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.concat(cut("line", F.split(text, "\n")), F.filter(cut("paragraph", paragraphs), lambda u: u["several"]),
                    cut("text", whole))


def scan(docs: DataFrame, texts: list[tuple[int, str, str]] | None = None, threshold: float = THRESHOLD,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The units of all texts that are close to a licence template."""
    spark = docs.sparkSession
    table, low, high = candidates(spark, templates() if texts is None else texts, threshold)
    text = F.replace(F.lower(column_of(docs, text_column, "string")), F.lit("licence"), F.lit("license"))
    # Each explode keeps the optimizer from computing what it yields once per use.
    plain = docs.select(column_of(docs, id_column, "long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        F.explode(F.array(F.regexp_replace(text, NOT_WORD, " "))).alias("body"))
    cut = plain.select("doc_id", "row", F.inline(units(F.col("body"), low, high)))
    following = F.slice("words", F.lit(2), F.size("words") - 1)
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), following, lambda a, b: F.concat_ws(" ", a, b))
    sized = cut.select("doc_id", "row", "unit", "position", F.explode(F.array(F.array_distinct(pairs))).alias("bigrams"))
    joined = sized.withColumn("size", F.size("bigrams")).join(F.broadcast(table), "size")
    common = F.size(F.array_intersect("bigrams", "template"))
    scored = joined.withColumn("dice", 2.0 * common / (F.col("size") + F.size("template"))).where(F.col("dice") >= threshold)
    best = scored.groupBy("row", "doc_id", "unit", "position").agg(
        F.min(F.struct((-F.col("dice")).alias("below"), "license", "number")).alias("best"))
    return best.select("doc_id", "unit", "position", "best.license", "best.number", (-F.col("best.below")).alias("dice"))


def oracle(threshold: float = THRESHOLD) -> str:
    """The same in DuckDB, without any pruning."""
    quoted = ", ".join("({}, '{}', [{}])".format(i, name, ", ".join("'" + b + "'" for b in template_bigrams(text)))
                       for i, name, text in templates())
    return rf"""
WITH template(number, license, template) AS (VALUES {quoted}),
plain AS (
  SELECT doc_id, regexp_replace(replace(lower(text), 'licence', 'license'), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS body
  FROM documents),
cut AS (
  SELECT doc_id, 'line' AS unit, string_split(body, chr(10)) AS parts FROM plain
  UNION ALL SELECT doc_id, 'paragraph', regexp_split_to_array(body, '\n(?: ?\n)+') FROM plain
  UNION ALL SELECT doc_id, 'text', [body] FROM plain WHERE len(regexp_split_to_array(body, '\n(?: ?\n)+')) > 1),
unit AS (SELECT doc_id, unit, unnest(parts) AS part, generate_subscripts(parts, 1) AS position FROM cut),
worded AS (
  SELECT doc_id, unit, position, list_filter(string_split_regex(part, '[ \n]+'), lambda w: w <> '') AS words
  FROM unit WHERE unit <> 'paragraph' OR contains(trim(part, chr(10) || ' '), chr(10))),
paired AS (
  SELECT doc_id, unit, position,
         list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigrams
  FROM worded),
scored AS (
  SELECT doc_id, unit, position, license, number,
         2.0::DOUBLE * len(list_intersect(bigrams, template)) / (len(bigrams) + len(template)) AS dice
  FROM paired, template)
SELECT doc_id, unit, position::INT AS position, license, number::INT AS number, dice
FROM scored WHERE dice >= {threshold}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, position ORDER BY dice DESC, license, number) = 1
"""


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
