"""Licence scan: normalised text against licence templates by the Dice
coefficient over distinct word bigrams; size bounds prune the templates.

Units are each line and the whole text. DataFrame functions only, no shuffle:
the templates are literals, so every document is judged where it is read.

Dice(A, B) = 2|A n B| / (|A| + |B|) can reach ``threshold`` t only if
|B| t / (2 - t) <= |A| <= |B| (2 - t) / t; other templates are not compared.

Defined cases: null, empty and one-word units match nothing; ties go to the
template that comes first in the list; repeated rows are judged alike; an empty
table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence notices and short licence texts.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
     "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
     "copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Proprietary", "All rights reserved."),
]
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    """Distinct hashes of neighbouring words."""
    pairs = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))
    return F.when(F.size(words) >= 2, F.array_distinct(F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(1))))) \
        .otherwise(F.array().cast("array<bigint>"))


def _template_bigrams(docs: DataFrame, texts: list[str]) -> list[list[int]]:
    """The templates' bigrams by the same expressions as the documents'."""
    rows = docs.sparkSession.createDataFrame(list(enumerate(texts)), "i int, t string") \
        .select("i", words_of(F.col("t")).alias("w")).select("i", bigrams_of(F.col("w")).alias("b")).collect()
    return [r["b"] for r in sorted(rows, key=lambda r: r["i"])]


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the best licence (null: none), its Dice value, the
    line it stands in (from 1; 0: the whole text) and the number of matching lines."""
    templates = TEMPLATES if templates is None else templates
    names = [name for name, _ in templates]
    grams = _template_bigrams(docs, [text for _, text in templates]) if templates else []
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = [len(g) for g in grams if g]
    fewest, most = (min(sizes) * low, max(sizes) * high) if sizes else (1, 0)

    def best(b: Column) -> Column:
        options = [F.when((F.size(b) >= len(g) * low) & (F.size(b) <= len(g) * high), F.struct(
            (2.0 * F.size(F.array_intersect(b, F.array(*(F.lit(x).cast("bigint") for x in g))))
             / (F.size(b) + F.lit(len(g)))).alias("dice"), F.lit(-i).alias("rank")))
            for i, g in enumerate(grams) if g]
        none = F.lit(None).cast("struct<dice:double,rank:int>")
        return F.when((F.size(b) >= fewest) & (F.size(b) <= most), F.greatest(none, none, *options))

    df = docs.select(F.col(id_col).alias("doc_id"),
                     F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("_lines"))
    # the whole text is one more unit unless it is a single line
    whole = F.when(F.size("_lines") > 1, F.array(F.array_join("_lines", "\n"))) \
        .otherwise(F.array().cast("array<string>"))
    df = df.select("doc_id", F.size("_lines").alias("_n"), F.concat("_lines", whole).alias("_units"))
    df = df.select("doc_id", "_n", F.transform("_units", words_of).alias("_w"))
    # k words have k - 1 distinct bigrams at most
    df = df.select("doc_id", "_n", F.transform("_w", lambda w: F.when(
        F.size(w) - 1 >= fewest, bigrams_of(w)).otherwise(F.array().cast("array<bigint>"))).alias("_b"))
    df = df.select("doc_id", "_n", F.transform("_b", lambda b, k: F.struct(
        best(b).alias("m"), k.alias("k"))).alias("_m"))
    df = df.select("doc_id", "_n", F.filter("_m", lambda m: m["m"]["dice"] >= threshold).alias("_hits"))
    # largest Dice first, then the template's place in the list, then the earlier unit
    top = F.array_max(F.transform("_hits", lambda m: F.struct(
        m["m"]["dice"].alias("dice"), m["m"]["rank"].alias("rank"), (-m["k"]).alias("k"))))
    df = df.select("doc_id", "_n", "_hits", top.alias("_top"))
    name = F.get(F.array(*(F.lit(n) for n in names)) if names else F.array().cast("array<string>"),
                 -F.col("_top")["rank"])
    return df.select("doc_id", name.alias("license"), F.col("_top")["dice"].alias("dice"),
                     F.when(-F.col("_top")["k"] < F.col("_n"), 1 - F.col("_top")["k"])
                     .when(F.col("_top").isNotNull(), 0).cast("long").alias("line"),
                     F.size(F.filter("_hits", lambda m: m["k"] < F.col("_n"))).cast("long").alias("n_lines"))
