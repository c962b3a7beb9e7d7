"""License scans: sparse TF-IDF cosines to templates, then inheritance from directories.

Lines of a file that could be a license header, and whole files that could be license files,
are compared with a small table of templates. The words that a text shares with the templates
and the number of its other words bound its cosines; most texts are out by that, and this
loses nothing. Files without a header of their own take the license of the license file in the
nearest directory above them.

Only DataFrame expressions are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Least cosine of a line (header) and of a whole file (license file).
HEADER, FILE = 0.7, 0.5

# SPDX identifiers and the usual notices for them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                   "this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, "
                     "are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0, dedicated to the public domain."),
)

TERM = r"[a-z0-9]+"


def terms_of(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing A-Z. ``lower`` makes a-z of two more characters
    only, the Kelvin sign and the dotted I, which part words here."""
    for other in ("\u212a", "\u0130"):
        text = F.replace(text, F.lit(other), F.lit(" "))
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def template_terms(templates=TEMPLATES) -> tuple[list[tuple[int, str, str, float]], float]:
    """((template, license, term, share), weight of other terms). Weights are
    1 + ln((1 + templates) / (1 + templates with the term)); a share is a term's part of its
    template's vector of length 1."""
    bags = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    within = Counter(term for bag in bags for term in bag)
    weight = {t: 1.0 + math.log((1 + len(bags)) / (1 + n)) for t, n in within.items()}
    rows = []
    for at, ((name, _), bag) in enumerate(zip(templates, bags)):
        norm = math.sqrt(sum((n * weight[t]) ** 2 for t, n in bag.items()))
        rows += [(at, name, t, weight[t], n * weight[t] / norm) for t, n in sorted(bag.items())]
    return rows, 1.0 + math.log(1 + len(bags))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _squares(terms: Column) -> Column:
    """Sum of the squared counts of the terms: a run in sorted order adds 1, 3, 5, ..."""
    start = F.struct(F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        F.sort_array(terms), start,
        lambda run, term: F.when(
            term == run.term,
            F.struct(run.term.alias("term"), (run.n + 1).alias("n"), (run.total + 2 * run.n + 1).alias("total")),
        ).otherwise(
            F.struct(term.alias("term"), F.lit(1).cast("long").alias("n"), (run.total + 1).alias("total"))
        ),
        lambda run: run.total,
    )


def best_template(terms: Column, least: float, templates=TEMPLATES) -> Column:
    """(less, license) of the best template for an array of terms if its cosine reaches
    ``least``, else null; less is the negative cosine, and of equal ones the first license by
    name counts. The template table is a parameter of a few hundred rows.

    Terms outside the templates are sorted and counted only where the others allow the
    cosine: its norm is no smaller than if every other term occurred once.
    """
    rows, other = template_terms(templates)
    weight = {term: w for _, _, term, w, _ in rows}
    most = {term: max(w * share for _, _, t, w, share in rows if t == term) for term in weight}
    listed = F.map_from_entries(F.array(*[
        F.struct(F.lit(term), F.struct(
            F.lit(weight[term] ** 2).alias("square"), F.lit(most[term]).alias("most")
        )) for term in sorted(weight)
    ]))
    enough = (least - 1e-6) ** 2
    parts = [
        F.struct(F.lit(name).alias("license"), F.array(*[
            F.struct(F.lit(term).alias("term"), F.lit(w * share).alias("part"))
            for at, _, term, w, share in rows if at == template
        ]).alias("parts"))
        for template, (name, _) in enumerate(templates)
    ]

    def known(term: Column) -> Column:
        return term.isin(sorted(weight))

    def counts(shown: Column) -> Column:
        return F.transform(F.array_distinct(shown), lambda term: F.struct(
            term.alias("term"), F.size(F.filter(shown, lambda x: x == term)).alias("n")
        ))

    def sums(found: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("square"), F.lit(0.0).alias("most"))
        return F.aggregate(found, zero, lambda total, x: _with(
            F.element_at(listed, x.term),
            lambda of: F.struct(
                (total.square + x.n * x.n * of.square).alias("square"),
                (total.most + x.n * of.most).alias("most"),
            ),
        ))

    def cosines(found: Column, square: Column) -> Column:
        norm = F.sqrt(square + other * other * _squares(F.filter(terms, lambda t: ~known(t))))
        by_term = F.map_from_entries(found)
        return _with(F.struct(norm.alias("norm"), by_term.alias("n")), lambda of: F.array_min(F.filter(
            F.transform(F.array(*parts), lambda template: F.struct(
                (-F.round(F.aggregate(
                    template.parts, F.lit(0.0),
                    lambda total, x: total + x.part * F.coalesce(F.element_at(of["n"], x.term), F.lit(0)),
                ) / of.norm, 6)).alias("less"),
                template.license.alias("license"),
            )),
            lambda found: found.less <= -least,
        )))

    def scored(shown: Column) -> Column:
        rest = (F.size(terms) - F.size(shown)) * (other * other)
        return F.when(F.size(shown) > 0, _with(counts(shown), lambda found: _with(
            sums(found), lambda total: F.when(
                total.most * total.most >= (total.square + rest) * enough,
                cosines(found, total.square),
            )
        )))

    return _with(F.filter(terms, known), scored)


def scan_licenses(
    files: DataFrame, id_col: Column, path_col: Column, text_col: Column,
    header: float = HEADER, file: float = FILE, templates=TEMPLATES,
) -> DataFrame:
    """(id, path, license, cosine, via, origin), one row per file. Files are scanned row by row,
    without a shuffle; only directories and their license files are joined.

    ``via`` is "header" if a line of the file reaches ``header``, "file" if no line does but
    the whole text reaches ``file``, "directory" if the license comes from the nearest
    directory above that holds a license file (``origin``), and null if there is none. A
    license file is one whose whole text reaches ``file``; of several in a directory the
    highest cosine counts, then the smaller name. Null and empty texts have no license of
    their own but inherit; a null path is in no directory and inherits nothing. Rows that
    share a path are scanned each by itself; an empty table gives no rows.
    """
    lines = files.select(
        id_col.alias("id"), path_col.alias("path"),
        F.transform(F.split(F.coalesce(text_col, F.lit("")), "\n"), terms_of).alias("lines"),
    )
    headers = F.filter(
        F.transform("lines", lambda terms: best_template(terms, header, templates)), F.isnotnull
    )
    own = lines.select("id", "path", F.array_min(headers).alias("header"), F.flatten("lines").alias("terms"))
    rows = stored(own.select(
        "id", "path", "header", best_template(F.col("terms"), file, templates).alias("whole")
    ), "license-own")
    directory = F.regexp_extract("path", "^(.*/)[^/]*$", 1)
    holders = rows.where("whole is not null and path is not null").groupBy(
        directory.alias("directory")
    ).agg(F.min("whole").alias("held"))
    above = _directories(rows.where("path is not null").select(directory.alias("leaf")).distinct())
    nearest = above.join(holders, "directory").groupBy("leaf").agg(
        F.max_by(F.struct("directory", "held"), F.length("directory")).alias("near")
    )
    found = rows.withColumn("leaf", directory).join(nearest, "leaf", "left")
    own_first = F.coalesce("header", "whole", "near.held")
    return found.select(
        "id", "path", own_first["license"].alias("license"), (-own_first["less"]).alias("cosine"),
        F.when(F.col("header").isNotNull(), "header").when(F.col("whole").isNotNull(), "file")
        .when(F.col("near").isNotNull(), "directory").alias("via"),
        F.when(F.col("header").isNull() & F.col("whole").isNull(), F.col("near.directory")).alias("origin"),
    )


def _directories(leaves: DataFrame) -> DataFrame:
    """(leaf, directory): each directory with itself and all above it, the root last."""
    parts = F.split("leaf", "/")
    return leaves.select(
        "leaf",
        F.explode(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)))).alias("n"),
        parts.alias("parts"),
    ).select(
        "leaf",
        F.when(F.col("n") == 1, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice("parts", F.lit(1), F.col("n") - 1), "/"), F.lit("/"))
        ).alias("directory"),
    )
