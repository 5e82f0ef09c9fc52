"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

Templates are put into classes of similar length. Each class has windows so long, and so close to each other, that any
occurrence of one of its templates lies within a window, and so many bands that such a window meets its template with the
probability ``SURE`` at least. What meets is verified on the shingles themselves. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a shingle, and the share of a template's shingles that a window must hold.
SHINGLE = 5
CONTAINED = 0.8
#: Least probability that a window that holds enough of a template shares a band with it.
SURE = 0.9999
#: Longest template of each class in words; windows are a quarter longer and half of that apart.
CLASSES = (12, 48, 192, 768)
#: Template bands, of at most a few kB each, that are broadcast; more are joined by shuffles.
BROADCAST_ROWS = 20_000

WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"

#: Notices by which works are licensed.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "MIT-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""",
    "GPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version.""",
    "BSD-redistribution": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer.""",
}

#: Words by which texts are picked before anything else; see :func:`marked`.
MARKERS = (
    "license", "licensed", "licenses", "sublicense", "software", "copyright", "permission", "redistribution",
    "redistributions", "modification",
)


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def shingles_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def marked(words: list[str], markers: tuple[str, ...]) -> bool:
    """Whether any text that holds enough of a template holds a marker too: too few shingles do without."""
    shingles = shingles_of(words)
    return sum(not set(s.split(" ")) & set(markers) for s in shingles) < CONTAINED * len(shingles)


@dataclass(frozen=True)
class TemplateClass:
    """Templates of one class and the settings of its windows."""

    longest: int
    templates: dict[str, list[str]]

    @property
    def step(self) -> int:
        return max(1, self.longest // 8)

    @property
    def window(self) -> int:
        """A template that starts within a step of a window ends in that window, with as much again for insertions."""
        return self.longest + 2 * self.step

    @property
    def bands(self) -> int:
        """Bands of one hash that give the probability ``SURE`` at the least similarity of window and template."""
        fewest = min(len(shingles_of(words)) for words in self.templates.values())
        shared = max(1, math.ceil(CONTAINED * fewest))
        similarity = shared / (self.window - SHINGLE + 1 + fewest - shared)
        return math.ceil(math.log(1 - SURE) / math.log(1 - min(similarity, 0.999999)))


def template_classes(templates: dict[str, str] = TEMPLATES, markers: tuple[str, ...] = MARKERS) -> list[TemplateClass]:
    found: dict[int, dict[str, list[str]]] = {}
    for name, text in templates.items():
        words = words_of(text)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        if not marked(words, markers):
            raise ValueError(f"template {name} could be found in texts without a marker")
        longest = next((c for c in CLASSES if len(words) <= c), len(words))
        found.setdefault(longest, {})[name] = words
    return [TemplateClass(longest, found[longest]) for longest in sorted(found)]


def windows_of(words: Column, length: int, step: int) -> Column:
    """Windows of an array of words, each with the place of its first word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda i: F.struct(i.alias("word"), F.slice(words, i + 1, length).alias("words")))


def shingle_array(words: Column) -> Column:
    """Distinct shingles of an array of words; fewer words have none."""
    starts = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)
    shingles = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))
    return F.when(F.size(words) >= SHINGLE, shingles).otherwise(F.array().cast("array<string>"))


def band_values(shingles: Column, bands: int) -> Column:
    """The least hash of the shingles under each of as many hash functions."""
    return F.transform(F.sequence(F.lit(1), F.lit(bands)),
                       lambda k: F.array_min(F.transform(shingles, lambda s: F.xxhash64(k, s))))


def template_bands(spark: SparkSession, of_class: TemplateClass) -> DataFrame:
    """``band``, ``value``, ``template`` and ``wanted`` (its shingles), one row for each template and band.

    Up to ``BROADCAST_ROWS`` rows are broadcast, so windows need not move to meet them.
    """
    rows = [(name, sorted(shingles_of(words))) for name, words in of_class.templates.items()]
    table = spark.createDataFrame(rows, "template string, wanted array<string>")
    bands = table.select("template", "wanted", F.posexplode(band_values(F.col("wanted"), of_class.bands)).alias("band", "value"))
    return F.broadcast(bands) if len(rows) * of_class.bands <= BROADCAST_ROWS else bands


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES,
         markers: tuple[str, ...] = MARKERS) -> DataFrame:
    """Templates found in each text: id, ``template``, ``containment`` (the best), ``word`` (start of the first window
    that has it) and ``windows`` (how many hold enough).

    Texts without a match, null and empty ones give no rows. Rows that repeat id and text count as one; null ids are
    reported as such. Case and punctuation between words do not count. Whole texts are read, however long.
    """
    spark = docs.sparkSession
    pattern = r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(sorted(markers)) + r")(?![\p{L}\p{N}])"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.regexp_like("text", F.lit(pattern)))
    worded = texts.select("id", F.xxhash64("text").alias("version"),
                          F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    marks = F.array(*[F.lit(m) for m in markers])
    found = None
    for of_class in template_classes(templates, markers):
        windows = windows_of(F.col("words"), of_class.window, of_class.step)
        held = F.filter(windows, lambda w: F.arrays_overlap(w["words"], marks))
        cut = worded.select("id", "version", F.explode(held).alias("w")).select(
            "id", "version", "w.word", shingle_array(F.col("w.words")).alias("shingles")).where(F.size("shingles") > 0)
        banded = cut.select("id", "version", "word", "shingles",
                            F.posexplode(band_values(F.col("shingles"), of_class.bands)).alias("band", "value"))
        met = banded.join(template_bands(spark, of_class), ["band", "value"])
        share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
        sure = met.withColumn("containment", share).where(F.col("containment") >= CONTAINED)
        of_windows = sure.groupBy("id", "version", "template", "word").agg(F.max("containment").alias("containment"))
        found = of_windows if found is None else found.unionByName(of_windows)
    best = found.groupBy("id", "version", "template").agg(
        F.max("containment").alias("containment"),
        (-F.max(F.struct("containment", (-F.col("word")).alias("back")))["back"]).cast("long").alias("word"),
        F.count("*").alias("windows"))
    return best.select(F.col("id").alias(id_col), "template", "containment", "word", "windows")
