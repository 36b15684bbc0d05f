"""Licence notices in texts, by the Dice coefficient of word bigrams.

Lines, paragraphs and the whole text are normalised and compared with licence
templates. A template can only be similar to a unit of about its own size, so
most templates are left out before anything is compared. All of it is Spark
functions inside one projection; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import let, plain_text, quoted

SIMILARITY = 0.8

# Notices that authors put into texts, by SPDX name. A licence may
# have several.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Reserved", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def normalised_words(unit: Column) -> Column:
    """Runs of ASCII letters and digits, in lower case."""
    plain = F.trim(F.lower(F.regexp_replace(unit, "[^A-Za-z0-9]+", " ")))
    return F.array_remove(F.split(plain, " "), "")


def bigram_hashes(words: Column) -> Column:
    """Different pairs of neighbouring words, as 64-bit hashes; fewer than two
    words have none."""

    def pairs(w: Column) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)),
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= 2, F.array_distinct(found)).otherwise(none)

    return let(words, pairs)


def text_units(text: Column) -> Column:
    """Lines; paragraphs of several lines; and the whole text if it has several
    paragraphs. Paragraphs end at lines without anything but white space."""
    paragraphs = F.split(text, "\n[ \t\r]*\n")

    def units(p: Column) -> Column:
        return F.concat(
            F.split(text, "\n"),
            F.filter(p, lambda x: F.contains(x, F.lit("\n"))),
            F.when(F.size(p) > 1, F.array(text)).otherwise(F.array().cast("array<string>")),
        )

    return let(paragraphs, units)


def scan_licences(
    docs: DataFrame,
    text_column: str = "text",
    hits_column: str = "hits",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows with ``hits_column``: (unit, licence, dice) for every unit of the
    text that is similar to a template, in the order of ``text_units``.

    dice is 2 * common / (unit + template), over different bigrams. The most
    similar template names the licence; on a tie the first licence by name.
    Templates whose size alone rules the similarity out are not compared.
    Templates are a short list that travels in the plan; templates of fewer than
    two words are refused.

    NULL and empty texts have no hits. A column already named like the new one
    is replaced. Rows and repeats are kept as they are.
    """
    spark = docs.sparkSession
    listed = [
        (name, sorted(set(row["b"])))
        for name, row in zip(
            [name for name, _ in templates],
            spark.createDataFrame([(i, t) for i, (_, t) in enumerate(templates)], "i int, t string")
            .select("i", bigram_hashes(normalised_words(F.col("t"))).alias("b"))
            .orderBy("i")
            .collect(),
            strict=True,
        )
    ]
    if not all(bigrams for _, bigrams in listed):
        raise ValueError("a template needs two words at least")
    # The size of a unit that can be similar to a template of size s lies between
    # s * t / (2 - t) and s * (2 - t) / t.
    narrow = similarity / (2 - similarity)
    smallest = min(len(b) for _, b in listed) * narrow
    largest = max(len(b) for _, b in listed) / narrow
    ranked = sorted(listed, key=lambda x: x[0])
    table = F.array(
        *[
            F.struct(
                F.lit(-i).alias("rank"),
                F.lit(name).alias("licence"),
                F.lit(len(bigrams)).alias("size"),
                F.array(*[F.lit(b).cast("bigint") for b in bigrams]).alias("bigrams"),
            )
            for i, (name, bigrams) in enumerate(ranked)
        ]
    )

    def best(bigrams: Column) -> Column:
        """The most similar template of a unit, NULL if none is possible."""
        size = F.size(bigrams)
        possible = F.filter(
            table, lambda t: (size >= t["size"] * narrow - 1e-9) & (size <= t["size"] / narrow + 1e-9)
        )
        return F.array_max(
            F.transform(
                possible,
                lambda t: F.struct(
                    (2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (size + t["size"])).alias(
                        "dice"
                    ),
                    t["rank"].alias("rank"),
                    t["licence"].alias("licence"),
                ),
            )
        )

    def hit(unit: Column, place: Column) -> Column:
        found = let(
            bigram_hashes(normalised_words(unit)),
            lambda b: F.when(F.size(b).between(smallest - 1e-9, largest + 1e-9), best(b)),
        )
        return let(
            found,
            lambda f: F.struct(
                place.cast("long").alias("unit"), f["licence"].alias("licence"), f["dice"].alias("dice")
            ),
        )

    hits = F.filter(
        F.transform(text_units(plain_text(text_column)), hit), lambda h: h["dice"] >= similarity
    )
    columns = [quoted(c) for c in docs.columns if c.lower() != hits_column.lower()]
    return docs.select(*columns, hits.alias(hits_column))


def templates_sql() -> str:
    """The templates as rows of a VALUES list."""
    return ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES
    )
