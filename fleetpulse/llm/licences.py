"""Licence notices: a trained paragraph classifier, confirmed by comparison with templates.

A sparse logistic regression over word one- and two-grams says which licence family a paragraph is
a notice of. It weighs all grams of the templates and the most frequent others; their number is
fixed, as the driver holds some dozens of vectors with a weight for each gram and family. It is trained on the templates, on copies of them with words left out
and with foreign words around them, and on paragraphs of the corpus that resemble no template.
The probability from which a family is believed is calibrated on paragraphs kept out of training;
below it a paragraph is unknown. The likeliest families are compared with their templates, and the
one most of whose template lies in the paragraph is confirmed.

A paragraph is a line, or lines that follow each other without an empty one between: a notice
wrapped over lines is found in windows of whole lines, scored and confirmed in the same way.

Only DataFrame operations and Spark ML: all work is done by the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_key
from fleetpulse.session import write_once

VOCABULARY = 1 << 12  # grams that are weighed; a vector of weights takes 0.4 MB
NEGATIVES = 4000  # paragraphs of the corpus that are trained on, about as many again calibrate
FALSE_RATE = 0.0005  # share of other paragraphs that may reach the calibrated probability
CANDIDATES = 3  # likeliest families that are compared with their templates
CONFIRM = 0.75  # share of a template's words and word pairs that must be in the paragraph
RESEMBLES = 0.5  # paragraphs with so much of a template are no negatives

# Notices by which works state the licence they are under, by family.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU AGPL v3 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the 3-clause BSD License.",
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc0": (
        "Released into the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU LGPL v3 or later.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
FAMILIES = ("unknown", *sorted(TEMPLATES))
COMMON = frozenset("a an and are by can for in is it of or that the this to under with without work you".split())

_WORD = r"[\p{L}\p{N}]"
_INNER = r"[\p{L}\p{N}+-]"
_MARK = r"^\s*(?:rem|REM|dnl)\s"  # comment marks that are words; others are no part of a word


def words(text: Column) -> Column:
    """Lower-case words; signs other than + and - within a word separate."""
    low = F.lower(text)
    # Signs at the edge of a word go in one pass, and only from texts that have any.
    edges = rf"(?<!{_INNER})[-+]+|-+(?!{_INNER})"
    inner = F.when(low.contains("-") | low.contains("+"), F.regexp_replace(low, edges, " ")).otherwise(low)
    return F.filter(F.split(inner, r"[^\p{L}\p{N}+-]+"), lambda w: w != "")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(key, at, text): the lines of each text that have a word character, numbered."""
    lines = docs.select(text_key().alias("key"), F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return lines.where(F.col("text").rlike(_WORD))


def _plain_words(text: str) -> list[str]:
    found = (w.strip("-+") for w in re.split(r"[^a-z0-9+-]+", text.lower()))
    return [w for w in found if w]


def anchors() -> list[str]:
    """Words of the templates of which any text that confirms a template has at least one.

    Of each template so many words, the longest first, that the words and pairs without them are
    a smaller share than ``CONFIRM``.
    """
    chosen: set[str] = set()
    for text in sorted({t for texts in TEMPLATES.values() for t in texts}):
        listed = _plain_words(text)
        grams = {(w,) for w in listed} | set(zip(listed, listed[1:]))
        left, own = grams, set()
        for word in sorted(set(listed), key=lambda w: (w in COMMON, -len(w), w)):
            if len(left) < CONFIRM * len(grams):
                break
            own.add(word)
            left = {g for g in left if word not in g}
        chosen |= own
    return sorted(chosen)


# Words after the first line and before the last line of a window: twice the longest template.
SPAN = 2 * max(len(_plain_words(t)) for texts in TEMPLATES.values() for t in texts)


def windows(docs: DataFrame) -> DataFrame:
    """(key, at, last, text): consecutive lines, two or more, of which a notice may be made up.

    From each line on, the windows reach as long as no line without a word character and no
    ``SPAN`` words lie between. Of the first line the last ``SPAN`` words are read and of the
    others the first, so a notice may begin and end anywhere in a line of any length. Texts and
    windows without any word of ``anchors()`` cannot confirm a template and are left out.
    """
    telling = anchors()
    somewhere = rf"(?<!{_WORD})(?:{'|'.join(re.escape(w) for w in telling)})"
    # Plain searches first: far cheaper than the pattern, which then sees few texts.
    any_of = F.exists(F.array(F.lower("text")), lambda t: reduce(Column.__or__, (t.contains(w) for w in telling)))
    told = docs.where(F.col("text").contains("\n") & any_of & F.lower("text").rlike(somewhere))
    lines = F.transform(F.split("text", "\n"), lambda x: words(F.regexp_replace(x, _MARK, " ")))
    listed = told.select(text_key().alias("key"), lines.alias("lines"))
    # Lines with a telling word, and how far before each a window that reaches it may start.
    some = F.array(*(F.lit(w) for w in telling))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    telling_lines = F.filter(numbers, lambda i: F.arrays_overlap(F.col("lines")[i], some))
    found = listed.select("key", "lines", telling_lines.alias("telling"))

    def walk(done: Column, line: Column) -> Column:
        goes_on = done["open"] & (done["n"] < SPAN) & (F.size(line) > 0)
        return F.struct(
            (done["back"] + goes_on.cast("int")).alias("back"),
            (done["n"] + F.least(F.size(line), F.lit(SPAN))).cast("int").alias("n"),
            goes_on.alias("open"),
        )

    def reached(i: Column) -> Column:
        low = F.greatest(i - SPAN, F.lit(0))
        begin = F.struct(F.lit(0).alias("back"), F.lit(0).alias("n"), F.lit(True).alias("open"))
        before = F.when(i > 0, F.reverse(F.slice("lines", low + 1, i - low))).otherwise(F.slice("lines", 1, 0))
        return F.sequence(i - F.aggregate(before, begin, walk)["back"], i)

    # Each start carries the lines that its windows can reach, never all lines of the text.
    begun = found.select("key", "lines", F.array_distinct(F.flatten(F.transform("telling", reached))).alias("begun"))
    cut = lambda xs: F.transform(xs, lambda x: F.slice(x, 1, SPAN))
    pieces = F.transform(
        "begun",
        lambda i: F.struct(i.alias("at"), F.col("lines")[i].alias("first"), F.slice("lines", i + 2, SPAN).alias("heads")),
    )
    starts = begun.select("key", F.explode(pieces).alias("s")).select(
        "key", "s.at", "s.first", cut(F.col("s.heads")).alias("heads")
    )
    empty = F.array().cast("array<struct<last:int,n:int,words:array<string>>>")
    tail = F.when(F.size("first") > SPAN, F.slice("first", -SPAN, SPAN)).otherwise(F.col("first"))
    following = F.transform(
        "heads", lambda x, i: F.struct((F.col("at") + i + 1).alias("last"), x.alias("head"))
    )

    def extend(made: Column, line: Column) -> Column:
        """One window more, unless the run has ended or the words before are enough."""
        size = F.size(made)
        before = F.when(size > 0, F.element_at(made, -1))
        n = F.coalesce(before["n"], F.lit(0))
        goes_on = (n < SPAN) & (F.size(line["head"]) > 0) & (line["last"] == F.col("at") + size + 1)
        longer = F.struct(
            line["last"].cast("int").alias("last"),
            (n + F.size(line["head"])).cast("int").alias("n"),
            F.concat(F.coalesce(before["words"], tail), line["head"]).alias("words"),
        )
        return F.when(goes_on, F.concat(made, F.array(longer))).otherwise(made)

    made = starts.where(F.size("first") > 0).select(
        "key", "at", F.explode(F.aggregate(following, empty, extend)).alias("made")
    )
    told = made.where(F.arrays_overlap("made.words", some))
    return told.select("key", "at", F.col("made.last").alias("last"), F.array_join("made.words", " ").alias("text"))


def featurize(rows: DataFrame) -> DataFrame:
    """Adds words and grams (distinct words and pairs)."""
    pairs = NGram(n=2, inputCol="words", outputCol="pairs")
    paired = pairs.transform(rows.withColumn("words", words(F.col("text"))))
    return paired.withColumn("grams", F.array_distinct(F.concat("words", "pairs"))).drop("pairs")


def templates(spark: SparkSession) -> DataFrame:
    """(family, text, grams) of all templates: a table whose size the constants fix."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    made = spark.range(1).select(F.explode(F.array(*rows)).alias("row")).select("row.*")
    return featurize(made).select("family", "text", "words", "grams")


def resemblance(grams: Column, template: Column) -> Column:
    """Share of a template's grams found in a paragraph."""
    return F.size(F.array_intersect(grams, template)) / F.greatest(F.size(template), F.lit(1))


@dataclass
class Classifier:
    model: PipelineModel  # from grams to probabilities of the families
    accept: float  # calibrated probability from which a family is believed


def _positives(known: DataFrame, foreign: DataFrame) -> DataFrame:
    """Templates as they are, with a word left out, and with words of the corpus before or after."""
    left_out = known.select(
        "family", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("drop")
    ).select(
        "family",
        F.array_join(F.filter("words", lambda w, i: i != F.col("drop")), " ").alias("text"),
    )
    # A notice without one word may be the notice of another family.
    other = known.select(F.col("family").alias("other"), F.col("grams").alias("template"))
    left_out = (
        featurize(left_out)
        .join(F.broadcast(other), F.col("family") != F.col("other"))
        .groupBy("family", "text")
        .agg(F.max(resemblance(F.col("grams"), F.col("template"))).alias("like"))
        .where(F.col("like") < CONFIRM)
        .select("family", "text")
    )
    plain = known.select("family", "text")
    tails = foreign.select(F.array_join(F.slice(words(F.col("text")), 1, 12), " ").alias("tail"), "part")
    # A fixed number of foreign lines for each template: both sides are bounded by constants.
    around = F.broadcast(known.select("family", "text", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("part")))
    within = tails.where("part < 8").join(around, "part").select(
        "family", F.explode(F.array(F.concat_ws(" ", "text", "tail"), F.concat_ws(" ", "tail", "text"))).alias("text")
    )
    return plain.unionByName(left_out).unionByName(within)


def vocabulary(rows: DataFrame, known: DataFrame, most: int = VOCABULARY) -> list[str]:
    """The grams that are weighed: those of the templates, then those that most rows have."""
    own = known.select(F.explode("grams").alias("gram")).distinct().withColumn("own", F.lit(True))
    counted = rows.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    listed = counted.join(F.broadcast(own), "gram", "full")
    first = listed.orderBy(F.col("own").isNull(), F.desc("n"), "gram").limit(most)
    return [r["gram"] for r in first.select("gram").collect()]


def train(lines: DataFrame, negatives: int = NEGATIVES, false_rate: float = FALSE_RATE) -> Classifier:
    """Train on the templates and on a hash sample of ``lines``: two parts for two purposes.

    About ``negatives`` lines are trained on as unknown and as many calibrate. Lines that resemble a
    template are left out of both. With no lines at all there is nothing to tell notices from, and
    only the template comparison decides.
    """
    spark = lines.sparkSession
    known = templates(spark)
    total = lines.count()
    million = 1_000_000
    share = min(million, -(-2 * negatives * million // max(total, 1)))
    bucket = F.pmod(F.xxhash64("text"), F.lit(million))
    sampled = featurize(lines.where(bucket < share).groupBy("text").agg(F.lit(1).alias("one")))
    every = known.agg(F.collect_list("grams").alias("all"))  # as many rows as templates, in one
    strange = sampled.crossJoin(F.broadcast(every)).withColumn(
        "like", F.aggregate("all", F.lit(0.0), lambda x, t: F.greatest(x, resemblance(F.col("grams"), t)))
    )
    part = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(2 * negatives))
    foreign = write_once(strange.where(F.col("like") < RESEMBLES).select("text", part.alias("part")), "foreign_lines")
    label = F.array_position(F.array(*(F.lit(f) for f in FAMILIES)), F.col("family")) - 1
    positives = featurize(_positives(known, foreign)).select(label.cast("double").alias("label"), "grams")
    others = featurize(foreign.where(F.col("part") % 2 == 0)).select(F.lit(0.0).alias("label"), "grams")
    rows = write_once(positives.unionByName(others), "licence_training")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(counts.values())
    weight = F.coalesce(*(F.when(F.col("label") == k, most / n) for k, n in counts.items()))
    learner = LogisticRegression(
        family="multinomial", maxIter=40, regParam=2e-4, elasticNetParam=0.5, weightCol="weight"
    )
    vectorizer = CountVectorizerModel.from_vocabulary(
        vocabulary(rows, known), inputCol="grams", outputCol="features", binary=True
    )
    model = PipelineModel([vectorizer, learner.fit(vectorizer.transform(rows).withColumn("weight", weight))])
    kept_out = model.transform(featurize(foreign.where(F.col("part") % 2 == 1)))
    best = kept_out.select((1 - vector_to_array("probability")[0]).alias("p"))
    reached = best.agg(F.percentile_approx("p", 1 - false_rate, 100_000)).first()[0]
    return Classifier(model, max(0.5, reached or 0.5))


def _likeliest(probability: Column, most: int = CANDIDATES) -> Column:
    """The families with the highest probabilities, unknown aside, the highest first."""
    names = F.array(*(F.lit(f) for f in FAMILIES[1:]))
    named = F.zip_with(
        F.slice(probability, 2, len(FAMILIES)), names, lambda p, f: F.struct((-p).alias("p"), f.alias("f"))
    )
    return F.transform(F.slice(F.array_sort(named), 1, most), lambda x: x["f"])


def _compared(scored: DataFrame, classifier: Classifier, by: list[str]) -> DataFrame:
    """(by, family, place, like) of the likeliest families of the paragraphs that are believed."""
    probability = vector_to_array("probability")
    believed = (
        scored.select(*by, "grams", probability.alias("probability"))
        .where(1 - F.col("probability")[0] >= classifier.accept)
        .select(*by, "grams", F.posexplode(_likeliest(F.col("probability"))).alias("place", "family"))
    )
    known = templates(scored.sparkSession).groupBy("family").agg(F.collect_list("grams").alias("all"))
    like = F.aggregate("all", F.lit(0.0), lambda x, t: F.greatest(x, resemblance(F.col("grams"), t)))
    return believed.join(F.broadcast(known), "family").select(*by, "family", "place", like.alias("like"))


def _wrapped(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(key, at, last, family, unlike): the window from each line on that has most of a template.

    The comparison goes before the classifier here, as only windows that pass both count.
    """
    made = featurize(windows(docs))
    every = templates(docs.sparkSession).agg(F.collect_list("grams").alias("all"))
    enough = F.exists("all", lambda t: resemblance(F.col("grams"), t) >= CONFIRM)
    near = made.crossJoin(F.broadcast(every)).where(enough).drop("all")
    compared = _compared(classifier.model.transform(near), classifier, ["key", "at", "last"])
    best = F.min(F.struct((-F.col("like")).alias("unlike"), "last", "place", "family")).alias("best")
    found = compared.where(F.col("like") >= CONFIRM).groupBy("key", "at").agg(best)
    return found.select("key", "at", "best.last", "best.family", "best.unlike")


LINE, WINDOW, UNCONFIRMED = 0, 1, 2


def _settled(found: Column) -> Column:
    """(kept, unconfirmed): notices of a text that do not overlap, the surest first.

    Confirmed lines go before windows, and of these the one with most of its template, then the
    shortest. Windows of different families may share the line in which one ends and the next
    begins. An unconfirmed line that lies in a window is part of its notice.
    """
    start = F.struct(
        F.array().cast("array<struct<at:int,last:int,family:string>>").alias("kept"),
        F.lit(0).cast("bigint").alias("unconfirmed"),
    )

    def step(done: Column, x: Column) -> Column:
        meets = F.exists(done["kept"], lambda k: (k["at"] <= x["last"]) & (x["at"] <= k["last"]) & (
            (k["family"] == x["family"]) | ((k["at"] < x["last"]) & (x["at"] < k["last"]))
        ))
        inside = F.exists(done["kept"], lambda k: (k["at"] <= x["at"]) & (x["at"] <= k["last"]))
        own = F.array(F.struct(x["at"].alias("at"), x["last"].alias("last"), x["family"].alias("family")))
        adds = (x["kind"] == LINE) | ((x["kind"] == WINDOW) & ~meets)
        counts = (x["kind"] == UNCONFIRMED) & ~inside
        return F.struct(
            F.when(adds, F.concat(done["kept"], own)).otherwise(done["kept"]).alias("kept"),
            (done["unconfirmed"] + counts.cast("bigint")).alias("unconfirmed"),
        )

    return F.aggregate(F.array_sort(found), start, step)


def scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, n_paragraphs, n_notices, families, unconfirmed.

    ``families`` are the confirmed ones, sorted and joined by commas ("" if none); ``n_paragraphs``
    counts lines; ``n_notices`` counts confirmed lines and confirmed notices wrapped over lines;
    ``unconfirmed`` counts lines that the classifier believes to be a notice, that no template
    confirms and that are no part of a wrapped notice. Null and empty texts have no paragraphs.
    Rows with the same text get the same result; an empty table gives no rows; other columns are
    not read. Whole texts are scanned.
    """
    lines = paragraphs(docs)
    classifier = train(lines)
    scored = classifier.model.transform(featurize(lines))
    # The candidate whose template is most in the paragraph; on a tie the likelier one.
    best = F.min(F.struct((-F.col("like")).alias("unlike"), "place", "family")).alias("best")
    single = _compared(scored, classifier, ["key", "at"]).groupBy("key", "at").agg(best)
    unlike = F.col("best.unlike")
    rows = [
        single.select(
            "key",
            F.struct(
                F.when(unlike <= -CONFIRM, LINE).otherwise(UNCONFIRMED).alias("kind"),
                unlike.alias("unlike"),
                F.lit(0).alias("length"),
                "at",
                F.col("at").alias("last"),
                "best.family",
            ).alias("found"),
        ),
        _wrapped(docs, classifier).select(
            "key",
            F.struct(
                F.lit(WINDOW).alias("kind"), "unlike", (F.col("last") - F.col("at")).alias("length"), "at", "last", "family"
            ).alias("found"),
        ),
    ]
    settled = reduce(DataFrame.unionAll, rows).groupBy("key").agg(F.collect_list("found").alias("found"))
    by_text = settled.select("key", _settled(F.col("found")).alias("settled")).select(
        "key",
        F.size("settled.kept").cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("settled.kept.family")), ",").alias("families"),
        "settled.unconfirmed",
    )
    found = write_once(by_text, "licence_notices")
    n = F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD)))
    rows = docs.select(F.col(id_col), text_key().alias("_key"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("bigint").alias("n_paragraphs"))
    zero = F.lit(0).cast("bigint")
    return rows.join(found.withColumnRenamed("key", "_key"), "_key", "left").select(
        id_col,
        "n_paragraphs",
        F.coalesce("n_notices", zero).alias("n_notices"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("unconfirmed", zero).alias("unconfirmed"),
    )
