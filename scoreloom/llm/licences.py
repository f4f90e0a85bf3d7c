"""Licence scans with DataFrame functions alone: Dice coefficient over word bigrams, pruned by size."""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.common import stage

# Notices by licence name.  The whole texts are in licence_texts/.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def whole_texts() -> list[tuple[str, str]]:
    """(name, text) of the whole licences in ``licence_texts/``."""
    folder = resources.files("scoreloom.llm").joinpath("licence_texts")
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def normal_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_bigrams(templates: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """(name, distinct bigrams in order) of each template."""
    out = []
    for name, text in templates:
        words = normal_words(text)
        out.append((name, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return out


def _segments(text: Column) -> Column:
    """The lines of a text and, if there are several, the whole text."""
    lines = F.split(text, "\n")
    return F.array_distinct(F.when(F.size(lines) > 1, F.concat(lines, F.array(text))).otherwise(lines))


def needed_bigrams(own: list[str], percent: int) -> list[str]:
    """Bigrams of a template of which every text that reaches the threshold has at least one.

    A text with b bigrams must share at least percent * (a + b) / 200 of the template's a, and b has its least value where
    the size bound ends.  So it shares one of any a - that + 1 bigrams; the longest are taken, as the least common.
    """
    least = -(-len(own) * percent // (200 - percent))
    shared = -(-percent * (len(own) + least) // 200)
    return sorted(own, key=lambda g: (-min(map(len, g.split())), -len(g), g))[: len(own) - shared + 1]


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that later filters and lambdas read instead of computing it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _best(bigrams: Column, templates: list[tuple[str, list[str]]], percent: int) -> Column:
    """Struct of the best template's ``common, total, name``; null below the threshold.

    With a and b bigrams, the Dice coefficient is at most 2 min(a, b) / (a + b); templates beyond that bound are not
    compared.  Comparison of coefficients is exact, by whole numbers.
    """
    listed = F.array(*(
        F.struct(F.lit(name).alias("name"), F.lit(len(own)).alias("size"), F.array(*map(F.lit, own)).alias("own"))
        for name, own in templates
    ))
    size = F.size(bigrams)
    close = F.filter(listed, lambda t: 200 * F.least(t["size"], size) >= percent * (t["size"] + size))
    scored = F.transform(close, lambda t: F.struct(
        F.size(F.array_intersect(t["own"], bigrams)).alias("common"), (t["size"] + size).alias("total"), t["name"].alias("name")
    ))
    hits = F.filter(scored, lambda s: 200 * s["common"] >= percent * s["total"])
    return F.try_element_at(F.array_sort(
        F.transform(hits, lambda s: F.struct((-2.0 * s["common"] / s["total"]).alias("dice"), s["name"].alias("name")))
    ), F.lit(1))


def shared_least(size: int, percent: int) -> int:
    """Bigrams of a template of ``size`` that any text which reaches the threshold shares."""
    return -(-percent * (size + -(-size * percent // (200 - percent))) // 200)


def _listed(values: list[str]) -> Column:
    """An array constant, as one literal however long it is."""
    return F.split(F.lit("|".join(values)), "\\|")


def window_hits(rows: DataFrame, known: list[tuple[str, list[str]]], percent: int) -> DataFrame:
    """``row, licence, dice`` of runs of words, wherever they begin and end, that reach the threshold.

    ``rows`` has ``row, pairs``: the bigrams of a whole text in order.  A bigram of the template at an end of a window never
    lowers its coefficient, so the best windows begin and end where a run of such bigrams does.  A run too short to be a hit
    that is followed (or, at the end, preceded) by so many bigrams found only there that any hit is better without is no end.
    Of overlapping windows of different licences the one that shares most counts (then the larger coefficient, the first name).
    """
    spark = rows.sparkSession
    listed = F.array(*(
        F.struct(F.lit(i).alias("tid"), _listed(own).alias("own"), _listed(needed_bigrams(own, percent)).alias("needed"),
                 F.lit(shared_least(len(own), percent)).alias("shared"))
        for i, (_, own) in enumerate(known)
    ))
    distinct = F.array_distinct("pairs")
    fit = F.filter(listed, lambda t: (F.size("distinct") >= t["shared"]) & F.arrays_overlap("distinct", t["needed"])
                   & (F.size(F.array_intersect(t["own"], "distinct")) >= t["shared"]))
    fits = F.transform(fit, lambda t: t["tid"])
    found = stage(
        _once(_once(rows, "distinct", distinct).select("row", "pairs", fits.alias("fits")).filter(F.size("fits") > 0), "tid", F.lit(0))
        .select("row", "pairs", F.explode("fits").alias("tid")), "licence-rows"
    )
    owned = spark.createDataFrame([(i, g) for i, (_, own) in enumerate(known) for g in own], "tid int, pair string")
    sizes = spark.createDataFrame(
        [(i, name, own, shared_least(len(own), percent)) for i, (name, own) in enumerate(known)],
        "tid int, licence string, own array<string>, shared int",
    )
    each = found.select("row", "tid", F.posexplode("pairs").alias("at", "pair"))
    each = each.join(F.broadcast(owned.withColumn("hit", F.lit(1))), ["tid", "pair"], "left").withColumn(
        "lone", (F.count(F.lit(1)).over(W.partitionBy("row", "tid", "pair")) == 1) & F.col("hit").isNull()
    )
    text = W.partitionBy("row", "tid").orderBy("at")
    upto = text.rowsBetween(W.unboundedPreceding, 0)
    marks = each.withColumns({
        "hits": F.sum(F.coalesce("hit", F.lit(0))).over(upto), "lones": F.sum(F.col("lone").cast("int")).over(upto),
        "opens": F.col("hit").isNotNull() & F.lag("hit").over(text).isNull(),
        "closes": F.col("hit").isNotNull() & F.lead("hit").over(text).isNull(),
    }).filter("opens or closes").join(F.broadcast(sizes.select("tid", "shared")), "tid")

    def ends(flag: str, other: Column, run: Column) -> DataFrame:
        return marks.filter(flag).withColumn("gap", other).withColumn("run", run).filter(
            f"gap is null or run >= shared or {200 - percent} * run >= {percent} * gap"
        )

    opens = W.partitionBy("row", "tid").orderBy("at")
    first = ends("opens", F.lead("lones").over(opens) - F.col("lones"), F.lead("hits").over(opens) - F.col("hits"))
    last = ends("closes", F.col("lones") - F.lag("lones").over(opens), F.col("hits") - F.lag("hits").over(opens))
    spans = first.groupBy("row", "tid").agg(F.collect_list(F.struct("at", "hits")).alias("first")).join(
        last.groupBy("row", "tid").agg(F.collect_list(F.struct("at", "hits")).alias("last")), ["row", "tid"]
    ).join(F.broadcast(sizes), "tid").join(found, ["row", "tid"])
    near = F.transform("first", lambda a: F.transform(
        F.filter("last", lambda z: (z["at"] >= a["at"]) & (z["hits"] - a["hits"] + 1 >= F.col("shared"))),
        lambda z: F.struct(a["at"].alias("a"), z["at"].alias("z")),
    ))
    windows = spans.select("row", "licence", "own", "pairs", F.explode(F.flatten(near)).alias("w"))
    cut = F.array_distinct(F.slice("pairs", F.col("w.a") + 1, F.col("w.z") - F.col("w.a") + 1))
    scored = windows.select(
        "row", "licence", "w.a", "w.z", F.size(F.array_intersect("own", cut)).alias("common"), (F.size("own") + F.size(cut)).alias("total")
    ).filter(f"200 * common >= {percent} * total")
    scored = scored.withColumn("dice", 2.0 * F.col("common") / F.col("total"))
    rival = F.struct("a", "z", "common", "dice", "licence")
    grouped = scored.groupBy("row").agg(F.collect_list(rival).alias("all"))

    def beaten(x: Column, y: Column) -> Column:
        better = (y["common"] > x["common"]) | ((y["common"] == x["common"]) & (
            (y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["licence"] < x["licence"]))
        ))
        return (y["licence"] != x["licence"]) & (y["a"] <= x["z"]) & (y["z"] >= x["a"]) & better

    kept = F.filter("all", lambda x: ~F.exists("all", lambda y: beaten(x, y)))
    return grouped.select("row", F.explode(kept).alias("x")).groupBy("row", F.col("x.licence").alias("licence")).agg(
        F.max("x.dice").alias("dice")
    )


def licence_scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85,
    templates: list[tuple[str, str]] = TEMPLATES, whole: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """``key, licence, dice, n_segments``: a row per document and licence found, with its best coefficient.

    Every line of the text and the whole text are lower-cased, cut into words of ASCII letters and digits and compared
    with the templates; a segment counts for its best template (ties: the first name) if the Dice coefficient of distinct
    word bigrams is at least ``percent`` hundredths.  Licences that no line and no whole text of a row gives are looked for in
    runs of words that begin and end anywhere, over line breaks; each such licence counts as one segment of its row.
    The ``whole`` licence texts (default: ``whole_texts()``) are looked for in runs of words only.  Null, empty and one-word texts match nothing.  Repeated rows and rows
    with equal or null keys are counted together by key; other columns are ignored; an empty table gives no rows.
    The aggregation combines before its shuffle and only documents with a hit reach it.
    """
    known = template_bigrams(templates)
    long = template_bigrams(whole_texts() if whole is None else whole)
    low, high = min(len(b) for _, b in known), max(len(b) for _, b in known)
    few = -(-low * percent // (200 - percent))
    many = high * (200 - percent) // percent
    needed = sorted({g for _, own in known for g in needed_bigrams(own, percent)})
    openers = sorted({g.split()[0] for g in needed})
    split = F.filter(F.split(F.lower("segment"), "[^a-z0-9]+"), lambda w: w != "")
    pairs = F.transform(
        F.arrays_zip(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))).alias("a"),
                     F.slice("words", 2, F.size("words")).alias("b")),
        lambda p: F.concat_ws(" ", p["a"], p["b"]),
    )

    # A whole text can only be in rows that are long enough for it and hold one of its needed bigrams.
    texts = F.array(*(F.struct(F.lit(shared_least(len(own), percent)).alias("shared"), _listed(own).alias("own"),
                               _listed(needed_bigrams(own, percent)).alias("needed")) for _, own in long))
    least = min((shared_least(len(own), percent) for _, own in long), default=None)

    def worded(rows: DataFrame, longer: bool = False) -> DataFrame:
        long_words, long_pairs = F.lit(False), F.lit(False)
        if longer and least is not None:
            long_words = F.size("words") > least
            long_pairs = F.exists(texts, lambda t: (F.size("pairs") >= t["shared"]) & F.arrays_overlap("pairs", t["needed"])
                                  & (F.size(F.array_intersect(t["own"], "pairs")) >= t["shared"]))
        return _once(_once(rows, "words", split).filter(
            (F.size("words") > few) & (F.arrays_overlap("words", _listed(openers)) | long_words)
        ), "pairs", pairs).filter(F.arrays_overlap("pairs", _listed(needed)) | long_pairs)

    # Texts that hold a needed bigram anywhere, stored with their row number; all that follows reads only these.
    held = stage(worded(docs.filter(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("segment"), F.monotonically_increasing_id().alias("row")
    ), True).select("row", "_key", "segment", "pairs"), "licence-texts")
    segments = worded(held.select("row", F.explode(_segments(F.col("segment"))).alias("segment")))
    paired = _once(segments, "bigrams", F.array_distinct("pairs")).filter(F.size("bigrams").between(few, many))
    hits = _once(paired, "best", _best(F.col("bigrams"), known, percent)).filter("best is not null").groupBy(
        "row", F.col("best.name").alias("licence")
    ).agg((-F.min("best.dice")).alias("dice"), F.count(F.lit(1)).alias("n"))
    hits = stage(hits, "licence-lines")
    more = window_hits(held.select("row", "pairs"), known + long, percent).join(hits.select("row", "licence"), ["row", "licence"], "left_anti")
    hits = hits.unionByName(more.withColumn("n", F.lit(1).cast("long")))
    return hits.join(held.select("row", F.col("_key").alias(key)), "row").groupBy(key, "licence").agg(
        F.round(F.max("dice"), 6).alias("dice"), F.sum("n").alias("n_segments")
    )
