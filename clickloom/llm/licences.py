"""Licence scans by votes on diagonals.

Texts and templates are cut into words and rolling k-grams. Every k-gram of every
text is joined by hash and wording to the template positions that hold it; a match
votes for its diagonal, the difference of the two positions. A text that contains
a template puts many votes on one diagonal, or on neighbouring ones where words
were added or dropped. k is two, so that the shortest phrases can vote. Votes for a
notice only count in runs on their diagonal, each run being a longer k-gram, so that
common pairs of words say nothing. Votes of neighbouring diagonals are merged, and a
span is verified by the share of different template positions it holds and by those it
must hold: the words that tell licences of one family apart. Where spans of a family
overlap, the one with the most votes stands for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.frames import take

GRAM = 2
RUN = 3  # k-grams in a row that vote for a notice together: four words
BROADCAST_CHARS = 4_000_000  # templates up to this size are sent to all executors
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False  # a phrase: only its words in a row count, every place
    coverage: float | None = None  # of a short statement: the share that one diagonal must hold, in place of that of Votes
    family: str | None = None  # templates that cannot stand on the same words; its own label if not given
    needs: tuple[str, ...] = ()  # k-grams of the text that a span must hold

    @property
    def run(self) -> int:
        return 1 if self.exact or self.coverage is not None else RUN


@dataclass(frozen=True)
class Votes:
    slack: int = 8  # diagonals so far apart are merged
    coverage: float = 0.6  # share of the template's k-grams that a span must hold


# The phrases and their labels.
PHRASES = [
    Template("cc-by", "cc by", exact=True),
    Template("gpl", "general public license", exact=True),
    Template("reserved", "all rights reserved", exact=True),
]


def _creative_commons(label: str, terms: str, *needs: str) -> Template:
    text = f"This work is licensed under a Creative Commons {terms} 4.0 International License"
    return Template(label, text, family="cc", needs=needs)


def _gnu(label: str, thing: str, licence: str, version: str, need: str) -> Template:
    return Template(
        label,
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} "
        f"as published by the Free Software Foundation, either version {version} of the License, or (at your "
        f"option) any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        family="gnu", needs=(need,),
    )


# The notices that licences ask to keep with a work.
NOTICES = [
    _gnu("agpl", "program", "Affero General Public License", "3", "gnu affero"),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    _creative_commons("cc-by-4.0", "Attribution", "attribution 4"),
    _creative_commons("cc-by-nc-4.0", "Attribution-NonCommercial", "attribution noncommercial", "noncommercial 4"),
    _creative_commons("cc-by-nc-nd-4.0", "Attribution-NonCommercial-NoDerivatives", "attribution noncommercial", "noncommercial noderivatives"),
    _creative_commons("cc-by-nc-sa-4.0", "Attribution-NonCommercial-ShareAlike", "attribution noncommercial", "noncommercial sharealike"),
    _creative_commons("cc-by-nd-4.0", "Attribution-NoDerivatives", "attribution noderivatives"),
    _creative_commons("cc-by-sa-4.0", "Attribution-ShareAlike", "attribution sharealike"),
    _gnu("gpl-notice", "program", "General Public License", "3", "gnu general"),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    _gnu("lgpl", "library", "Lesser General Public License", "2.1", "gnu lesser"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def _named(label: str, *texts: str) -> list[Template]:
    family = "cc" if label.startswith("cc") else "gnu" if label.endswith("gpl") else label
    return [Template(label, text, coverage=0.99, family=family) for text in texts]


# What one-line statements call a licence by.
STATEMENTS = [
    *_named("agpl", "affero general public license", "gnu agpl", "agpl v3", "agpl 3 0", "agplv3 license"),
    *_named("apache-2.0", "apache license version 2 0", "apache license v2 0", "apache license 2 0", "apache 2 0"),
    *_named(
        "bsd", "bsd license", "bsd licence", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd", "bsd style license",
    ),
    *_named("cc0", "cc0 1 0", "cc0 license", "cc0 public domain", "creative commons zero"),
    *_named("cc-by-4.0", "cc by 4 0", "creative commons attribution 4 0"),
    *_named("cc-by-nc", "cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    *_named(
        "cc-by-nc-nd", "cc by nc nd", "creative commons attribution noncommercial noderivatives",
        "creative commons attribution noncommercial noderivs",
    ),
    *_named("cc-by-nc-sa", "cc by nc sa", "creative commons attribution noncommercial sharealike"),
    *_named("cc-by-nd", "cc by nd", "creative commons attribution noderivatives", "creative commons attribution noderivs"),
    *_named("cc-by-sa", "cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    *_named("gpl", "gnu gpl", "gpl v2", "gpl v3", "gpl 2 0", "gpl 3 0", "gplv2 license", "gplv3 license"),
    *_named("isc", "isc license", "isc licence"),
    *_named("lgpl", "lesser general public license", "library general public license", "gnu lgpl", "lgpl v2", "lgpl v3", "lgpl 2 1", "lgpl 3 0"),
    *_named("mit", "mit license", "mit licence", "mit licensed", "licensed under mit"),
    *_named("mpl-2.0", "mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"),
    *_named("unlicense", "the unlicense"),
]

EVERY = PHRASES + NOTICES + STATEMENTS


def _words(text: Column) -> Column:
    """Words of A-Z lowered text. The Kelvin sign is the only other letter that lowers into a-z alone."""
    lowered = F.when(F.contains(text, F.lit("K")), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    # a word before and one behind, so that both ends are cut like the rest
    return F.split(F.concat(F.lit("x "), lowered, F.lit(" x")), GAP)


def _grams(words: Column, first: Column, last: Column) -> Column:
    """The k-grams that start at the words from ``first`` to ``last``."""
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(GRAM)]))


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(template, n_grams, place, gram, hash) of all templates, and an empty k-gram for template -1."""
    for t in templates:
        if len(t.text.split()) < GRAM:
            raise ValueError(f"a template needs at least {GRAM} words: {t.text!r}")
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)])
    cut = spark.range(1).select(F.inline(rows)).select("template", _words(F.col("text")).alias("words"))
    grams = cut.select(
        "template", (F.size("words") - 1 - GRAM).alias("n_grams"),
        F.posexplode(_grams(F.col("words"), F.lit(1), F.size("words") - 1 - GRAM)).alias("place", "gram"),
    )
    every = spark.range(1).select(F.lit(-1).alias("template"), F.lit(1).alias("n_grams"), F.lit(0).alias("place"), F.lit("").alias("gram"))
    return grams.union(every).withColumn("hash", F.xxhash64("gram"))


def _rules(spark: SparkSession, templates: list[Template], votes: Votes, grams: DataFrame) -> DataFrame:
    """Per template: label, family, whether it is exact or stands alone on one diagonal, the run and share it takes, the places it needs."""
    fields = {"template": "int", "label": "string", "family": "string", "exact": "boolean", "alone": "boolean", "run": "int", "least": "double"}

    def row(i: int, t: Template) -> Column:
        alone = t.exact or t.coverage is not None
        least = 1.0 if t.exact else votes.coverage if t.coverage is None else t.coverage
        values = (i, t.label, t.family or t.label, t.exact, alone, t.run, least)
        needs = F.array(*map(F.lit, t.needs)).cast("array<string>").alias("needs")
        return F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, fields.items())], needs)

    none = row(-1, Template("", "", coverage=2.0))
    named = spark.range(1).select(F.inline(F.array(none, *[row(i, t) for i, t in enumerate(templates)])))
    needed = grams.join(named.select("template", F.explode("needs").alias("gram")), ["template", "gram"])
    places = needed.groupBy("template").agg(F.collect_set("place").alias("needed"))
    return named.drop("needs").join(places, "template", "left").withColumn("needed", F.coalesce("needed", F.array().cast("array<int>")))


def _in_runs(places: str) -> Column:
    """The places that stand in runs of three or more."""
    held = lambda p, *steps: [F.array_contains(places, p + F.lit(step)) for step in steps]

    def strong(p: Column) -> Column:
        before, after, further_before, further_after = held(p, -1, 1, -2, 2)
        return (before & after) | (before & further_before) | (after & further_after)

    return F.filter(places, strong)


def scan(docs: DataFrame, templates: list[Template], votes: Votes = Votes()) -> DataFrame:
    """Phrases and licences found in every row's whole text.

    Returns doc_id, n_words, n_base (places of exact templates), first_word and
    last_word (their smallest and largest start, null without any), base_labels and
    labels (distinct, sorted, comma-joined; empty without any), score (largest
    share of a template's k-grams found in a verified span, 1 for a phrase, else 0)
    and spans (label, start, end in words, share) in order.

    A null or wordless text has no places. Repeated rows give repeated results, rows
    without a doc_id too. Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    rules = _rules(spark, templates, votes, grams)
    if sum(len(t.text) for t in templates) <= BROADCAST_CHARS:
        grams, rules = F.broadcast(grams), F.broadcast(rules)
    rows = take(docs, {"doc_id": "doc_id", "text": "text"}).select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), _words(F.coalesce("text", F.lit(""))).alias("words")
    )
    n_words = F.size("words") - 2
    held = rows.select(
        "row", "doc_id", n_words.cast("long").alias("n_words"),
        # the empty k-gram in front matches template -1, so that every row stays
        F.posexplode(F.concat(F.array(F.lit("")), _grams(F.col("words"), F.lit(1), n_words + 1 - GRAM))).alias("at", "gram"),
    ).withColumn("hash", F.xxhash64("gram"))
    of_row = ["row", "doc_id", "n_words"]
    hits = held.join(grams, ["hash", "gram"]).withColumn("diagonal", F.col("at") - 1 - F.col("place"))
    diagonals = hits.groupBy(*of_row, "template", "n_grams", "diagonal").agg(F.collect_list("place").alias("places")).join(rules, "template")
    voting = diagonals.withColumn("places", F.when(F.col("run") == 1, F.col("places")).otherwise(_in_runs("places"))).filter(
        (F.size("places") > 0) | (F.col("template") < 0)
    )
    near = Window.partitionBy(*of_row, "template").orderBy("diagonal").rangeBetween(-votes.slack, votes.slack)
    merged = F.array_distinct(F.flatten(F.collect_list("places").over(near)))
    # phrases and short statements stand on one diagonal, and every place counts
    voted = voting.withColumn("merged", F.when(F.col("alone"), F.col("places")).otherwise(merged)).withColumn(
        "share", F.size("merged") / F.col("n_grams")
    )
    full = (F.col("share") >= F.col("least")) & (F.size(F.array_except("needed", "merged")) == 0) & (F.col("template") >= 0)
    # the strongest of the diagonals that were merged stands for them
    strength = F.struct("share", F.size("places"), -F.col("diagonal"))
    found = voted.withColumn("hit", full & (F.col("alone") | (strength == F.max(strength).over(near))))
    first = F.greatest(F.col("diagonal") + F.array_min("merged"), F.lit(0))
    last = F.least(F.col("diagonal") + F.array_max("merged") + GRAM, F.col("n_words"))
    spans = found.filter(F.col("hit") | (F.col("template") < 0)).select(
        *of_row, "template", "label", "family", "exact", "hit", "diagonal", "share", F.size("merged").alias("votes"),
        first.cast("long").alias("start"), last.cast("long").alias("end"),
    )
    # spans of a family that overlap are one stretch, for which the one with most votes stands
    in_family = Window.partitionBy(*of_row, "family", "exact").orderBy("start", "end", "template")
    earlier = F.max("end").over(in_family.rowsBetween(Window.unboundedPreceding, -1))
    stretch = F.sum(F.when(F.col("start") < earlier, 0).otherwise(1)).over(in_family.rowsBetween(Window.unboundedPreceding, 0))
    strongest = F.struct("votes", "share", -F.col("template"))
    of_stretch = Window.partitionBy(*of_row, "family", "exact", "stretch")
    judged = spans.withColumn("stretch", stretch).withColumn(
        "hit", F.col("hit") & (F.col("exact") | (strongest == F.max(strongest).over(of_stretch)))
    )
    base = F.col("hit") & F.col("exact")
    labels = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(kind, F.col("label")))), ",")
    return judged.groupBy(*of_row).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("hit")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("hit"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("hit"), F.struct("start", "end", "label", "share")))).alias("spans"),
    ).drop("row")
