"""License scans, with DataFrame functions only.

A text is read at three levels: sentences, lines and paragraphs (blocks between
blank lines; a text without one is a paragraph as a whole). Each segment is
normalised (A-Z lowered, every run of other than a-z0-9 becomes one space) and
compared with every licence template by the Dice coefficient of the sets of word
bigrams, ``2 |A n B| / (|A| + |B|)``.

Pruning, none of which can lose a match. A match shares at least
``t / (2 - t)`` of the template's bigrams, so for each template some words are
chosen without which too few bigrams are left; a text, and then a segment, in
which none of these words occurs is dropped before it is normalised. Of the
segments left, a template is compared only if the number of its bigrams lies
within ``t / (2 - t)`` and ``(2 - t) / t`` of the segment's.

The templates are a handful of literals, so they travel in the plan and nothing
is shuffled until matches are grouped per document.

Defined results: null and empty texts, and segments of fewer than two words,
match nothing. A segment may match several templates. Repeated rows of a
document add up. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 70  # smallest Dice coefficient, in hundredths

# Wording of public licences and of the usual notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def normal_words(segment: Column) -> Column:
    low = F.translate(segment, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(low, "[^a-z0-9]+", " "), " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def needed_words(bigram_sets: list[list[str]], percent: int) -> list[str]:
    """Words of which every match holds at least one: without them fewer than
    ``t / (2 - t)`` of each template's bigrams are left. Greedy, longest first."""
    chosen: set[str] = set()
    for grams in bigram_sets:
        least = -(-percent * len(grams) // (200 - percent))
        left = [g.split(" ") for g in grams if not set(g.split(" ")) & chosen]
        while len(left) >= least:
            words = {w for g in left for w in g}
            best = max(sorted(words), key=lambda w: (len(w) >= 5, sum(w in g for g in left), len(w)))
            chosen.add(best)
            left = [g for g in left if best not in g]
    return sorted(chosen)


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license, segment (normalised), dice: one row per match of a
    distinct segment of a document row."""
    sets = {k: template_bigrams(v) for k, v in (templates or TEMPLATES).items()}
    sets = {k: v for k, v in sets.items() if v}
    words = needed_words(list(sets.values()), percent)

    def may_match(c: Column) -> Column:
        low = F.lower(c)
        hit = F.contains(low, F.lit(words[0]))
        for w in words[1:]:
            hit = hit | F.contains(low, F.lit(w))
        return hit

    whole = F.col("text")
    sentences = F.split(F.regexp_replace(whole, "([.!?]) ", "$1\n"), "\n")
    segments = F.array_distinct(F.concat(sentences, F.split(whole, "\n"), F.split(whole, "\n[ \t\r]*\n")))
    table = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(len(v)).alias("n"),
                               F.array(*[F.lit(b) for b in v]).alias("b")) for k, v in sets.items()])
    a = F.size("grams")

    def shared(t: Column) -> Column:
        return F.size(F.array_intersect(F.col("grams"), t.b))

    def fits(t: Column) -> Column:
        return ((t.n * (200 - percent) >= a * percent) & (a * (200 - percent) >= t.n * percent)
                & (200 * shared(t) >= percent * (a + t.n)))

    found = (df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
             .where(may_match(whole))
             .select("doc_id", F.explode(segments).alias("segment"))
             .where(may_match(F.col("segment")))
             .select("doc_id", normal_words(F.col("segment")).alias("words"))
             .where(F.size("words") >= 2)
             .select("doc_id", F.array_join("words", " ").alias("segment"), bigrams(F.col("words")).alias("grams")))
    return (found.select("doc_id", "segment", "grams", F.explode(F.filter(table, fits)).alias("t"))
            .select("doc_id", F.col("t.license").alias("license"), "segment",
                    (F.lit(2.0) * shared(F.col("t")) / (a + F.col("t.n"))).alias("dice")))
