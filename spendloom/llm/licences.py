"""Licence scans: a paragraph classifier trained here names the licence family, and a template must confirm it.

Every line is cut at sentence ends, and every stretch of up to ``JOINED`` neighbouring pieces, across lines that may be
wrapped, is a paragraph of its own.  Its features are the word
1- and 2-grams that licence notices use.  A multinomial logistic regression over sparse vectors is trained on the
notices below, whole and with parts missing, and for the class ``unknown`` on plain sentences that use the same words
and on all pieces of the corpus but those that resemble a notice.  Pieces of the same features are one row that weighs
as much as they do; together they weigh at most ``UNKNOWN``, so that a large corpus doesn't outweigh the notices.
The unknown class is calibrated on all these pieces: a family is named only if its probability is above what all but
one in a thousand of them reach.  Then the paragraph must have most words of one of the family's templates, and half of
its own words must be the template's.  Confirmed paragraphs of one family that overlap are one
notice, as certain as the best of them.

Paragraphs that no template can confirm are not scored: of every template so many words are cues, rare ones in the
corpus (``cues``), that a paragraph without any of them has too few of its words.

DataFrame operations and Spark's own feature and regression stages only.  Null and empty texts have no paragraphs.
Rows of one id with different texts are told apart by text; repeated rows get the same families.
"""

from __future__ import annotations

import math
import re
from itertools import groupby

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendloom.llm.common import pick, written

#: Pieces that may make up a paragraph.
JOINED = 4
UNKNOWN = 3000
#: Steps of a probability in which the unknown class is calibrated, and in which probabilities are returned.
STEPS = 10_000
#: Share of a template's words that a paragraph must have, and of the paragraph's words that the template explains.
CONFIRM = 0.7
RESEMBLES = 0.5
WORD = r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]"

#: Usual notices by family (fixed values).
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "See the GNU Lesser General Public License for more details.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Licensed under the BSD 2-Clause License.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "epl": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "public domain": (
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright (c) the authors. All rights reserved.",
        "This document is confidential and proprietary; no part may be reproduced without written permission.",
    ),
}
#: Plain sentences with the same words.
PLAIN = (
    "The driver had no license and the files were not free.",
    "She reserved a table for all of us, with the rights to change it later.",
    "The general public may use this form free of charge on any day.",
    "This work is the version of the project that was released to the public in the source.",
    "Under the terms of the contract you can not modify it without permission.",
    "The software is subject to change and the binary was obtained from a person.",
    "All of the people in this program are permitted to use the library.",
    "He attended MIT and then moved to the Apache reservation.",
    "International attribution of the source code is common and creative.",
)


def pieces(text: Column) -> Column:
    """Lines, cut at sentence ends."""
    return F.filter(F.split(text, r"\n|(?<=[.!?])\s+"), lambda x: F.trim(x) != "")


def cues(common: dict[str, int]) -> list[str]:
    """Words of which every paragraph that a template confirms has at least one.

    Of a template's n words it has ``CONFIRM`` * n or more, so any set larger than the rest meets it.  The words that
    the fewest other paragraphs have are taken (``common`` counts them), long ones first.
    """
    found = set()
    for texts in NOTICES.values():
        for text in texts:
            own = set(re.findall(WORD, text.lower()))
            rest = len(own) - math.ceil(CONFIRM * len(own))
            found |= set(sorted(own, key=lambda w: (common.get(w, 0), -len(w), w))[: rest + 1])
    return sorted(found)


def _told(text: Column, words_: list[str]) -> Column:
    """Whether a text has a cue, or a word that begins with one; words begin after anything but a letter or digit.

    One branch for each first letter: most places of a text are ruled out by one comparison.
    """
    letters = [(first, [re.escape(c[1:]) for c in same]) for first, same in groupby(words_, key=lambda c: c[0])]
    return F.lower(text).rlike("(?:^|[^a-z0-9])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in letters) + ")")


def stretches(rows: DataFrame, words_: list[str]) -> DataFrame:
    """``rows`` (doc_id, digest, pieces): ``doc_id, digest, at, n, paragraph`` of each stretch of ``n`` pieces with a cue."""
    marked = rows.withColumn("cue", F.transform("pieces", lambda x: _told(x, words_)))
    m = F.size("pieces")

    def from_(i: Column) -> Column:
        sizes = F.sequence(F.lit(1), F.least(F.lit(JOINED), m - i))
        with_cue = F.filter(sizes, lambda n: F.array_contains(F.slice("cue", i + 1, n), True))
        return F.transform(
            with_cue, lambda n: F.struct(i.alias("at"), n.alias("n"), F.array_join(F.slice("pieces", i + 1, n), " ").alias("paragraph"))
        )

    made = F.when(m > 0, F.flatten(F.transform(F.sequence(F.lit(0), m - 1), from_)))
    return marked.select("doc_id", "digest", F.explode(made).alias("s")).select("doc_id", "digest", "s.*")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def grams(w: Column) -> Column:
    """The words and the pairs of neighbours."""
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(w, pairs)


def templates(spark: SparkSession) -> DataFrame:
    """``family, notice, template`` (distinct words of the notice)."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, notice string").withColumn("template", F.array_distinct(words(F.col("notice"))))


class Scanner:
    def __init__(self, docs: DataFrame, unknown: int = UNKNOWN):
        spark = docs.sparkSession
        self.templates = templates(spark)
        self.families = ["unknown", *NOTICES]
        # Whole notices, and notices without their first or last words.
        w = words(F.col("notice"))
        parts = [F.slice(w, 1 + cut, F.greatest(F.size(w) - cut, F.lit(1))) for cut in (0, 1, 2)]
        parts += [F.slice(w, 1, F.greatest(F.size(w) - cut, F.lit(1))) for cut in (1, 2)]
        some = F.filter(F.array(*parts), lambda p: F.size(p) >= F.least(F.size(w), F.lit(3)))
        notices = self.templates.select("family", F.explode(some).alias("w")).distinct()
        vocabulary = sorted(
            r["g"] for r in self.templates.select(F.explode(grams(words(F.col("notice")))).alias("g")).distinct().collect()
        )
        self.counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
        self.counter.setBinary(True)
        strange = written(self._pieces(docs), "pieces")
        # A row for each word of the templates at most.
        shared = strange.select(F.explode("w").alias("g"), "n").groupBy("g").agg(F.sum("n").alias("n"))
        self.cues = cues({r["g"]: r["n"] for r in shared.collect()})
        total = strange.agg(F.sum("n")).first()[0] or 1
        weight = F.col("n") * min(1.0, unknown / total)
        plain = spark.createDataFrame([(t,) for t in PLAIN], "t string").select(F.lit("unknown").alias("family"), words(F.col("t")).alias("w"))
        rows = notices.union(plain)
        index = F.lit(0.0)
        for i, family in enumerate(self.families):
            index = F.when(F.col("family") == family, float(i)).otherwise(index)
        known = F.when(F.col("family") == "unknown", 1.0).otherwise(20.0)
        trained = rows.select(grams(F.col("w")).alias("grams"), index.alias("label"), known.alias("weight")).coalesce(1)
        trained = trained.union(strange.select("grams", F.lit(0.0).alias("label"), weight.alias("weight")))
        self.model: LogisticRegressionModel = LogisticRegression(
            family="multinomial", regParam=1e-3, weightCol="weight", maxIter=60
        ).fit(self.counter.transform(trained).select("features", "label", "weight"))
        # What the best family's probability is for paragraphs that have none; a row for each step at most.
        steps = self._scored(strange).groupBy(F.ceil(F.col("probability") * STEPS).alias("step")).agg(F.sum("n").alias("n"))
        below, self.bound = 0, 0.5
        for r in sorted(steps.collect()):
            if below < 0.999 * total:
                self.bound = max(0.5, r["step"] / STEPS)
            below += r["n"]

    def _pieces(self, docs: DataFrame) -> DataFrame:
        """``grams, w, n`` of the pieces that don't resemble a notice: those of the vocabulary that a piece has, its words, how many have these."""
        vocabulary = list(self.counter.vocabulary)
        single = [g for g in vocabulary if " " not in g]
        lines = pick(docs, "text").where(F.col("text").isNotNull()).select(F.explode(pieces(F.col("text"))).alias("p"))
        # Words that no notice has are a bar, neighbouring ones a single bar: equal pieces are counted as texts first.
        barred = F.array_join(F.transform(words(F.col("p")), lambda x: F.when(x.isin(single), x).otherwise("|")), " ")
        texts = lines.select(F.regexp_replace(barred, r"[|](?: [|])+", "|").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
        known = texts.select(F.transform(F.split("t", " "), lambda x: F.when((x != "|") & (x != ""), x)).alias("k"), "n")
        pairs = F.zip_with("k", F.slice("k", 2, F.greatest(F.size("k") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        own = F.array_distinct(F.filter(F.concat("k", pairs), lambda g: g.isin(vocabulary)))
        named = known.select(F.array_sort(own).alias("grams"), "n").groupBy("grams").agg(F.sum("n").alias("n"))
        # Written: the filter, a term for each template, would else be asked of every piece's text, which it then parses anew.
        named = written(named.withColumn("w", F.filter("grams", lambda g: ~F.contains(g, F.lit(" ")))), "named")
        return named.where(~self._resembles(named))

    def _resembles(self, rows: DataFrame) -> Column:
        """Whether a paragraph (its distinct words, or those of the vocabulary) has half of some template's words."""
        out = F.lit(False)
        for texts in NOTICES.values():
            for text in texts:
                template = F.array_distinct(words(F.lit(text)))
                least = RESEMBLES * F.size(template)
                out = out | ((F.size("w") >= least) & (F.size(F.array_intersect("w", template)) >= least))
        return out

    def _scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with words w), the best family and its probability."""
        kept = rows.columns
        if "grams" not in kept:
            rows = rows.withColumn("grams", grams(F.col("w")))
        scored = self.model.transform(self.counter.transform(rows))
        p = vector_to_array("probability")
        best = F.array_max(F.transform(F.slice(p, 2, len(self.families) - 1), lambda x, i: F.struct(x.alias("p"), i.alias("i"))))
        return scored.withColumn("best", best).select(
            *kept,
            F.element_at(F.array(*[F.lit(f) for f in self.families[1:]]), F.col("best.i") + 1).alias("family"),
            F.col("best.p").alias("probability"),
        )

    def confirmed(self, docs: DataFrame) -> DataFrame:
        """``doc_id, digest, at, n, family, probability`` of each paragraph that a template confirms, overlapping ones too."""
        rows = pick(docs, "doc_id", "text").where(_told(F.col("text"), self.cues))
        lines = stretches(rows.select("doc_id", F.xxhash64("text").alias("digest"), pieces(F.col("text")).alias("pieces")), self.cues)
        scored = self._scored(lines.select("doc_id", "digest", "at", "n", words(F.col("paragraph")).alias("w")))
        named = scored.where(F.col("probability") >= self.bound)
        shared = F.size(F.array_intersect("w", "template"))
        # The templates are a few dozen rows.
        return (
            named.join(F.broadcast(self.templates), "family")
            .where((shared >= CONFIRM * F.size("template")) & (shared >= RESEMBLES * F.size(F.array_distinct("w"))))
            .select("doc_id", "digest", "at", "n", "family", "probability")
            .dropDuplicates(["doc_id", "digest", "at", "n"])
        )

    def found(self, docs: DataFrame) -> DataFrame:
        """``doc_id, digest, family, at, n, probability`` of each notice: where it begins, and how many pieces it has.

        A group is one text's notices of one family.
        """
        own = Window.partitionBy("doc_id", "digest", "family").orderBy("at", "n")
        until = F.max(F.col("at") + F.col("n")).over(own.rowsBetween(Window.unboundedPreceding, -1))
        begins = F.when(until.isNull() | (F.col("at") >= until), 1).otherwise(0)
        numbered = self.confirmed(docs).withColumn("_begins", begins).withColumn("_notice", F.sum("_begins").over(own))
        return numbered.groupBy("doc_id", "digest", "family", "_notice").agg(
            F.min("at").alias("at"),
            (F.max(F.col("at") + F.col("n")) - F.min("at")).alias("n"),
            F.max("probability").alias("probability"),
        ).drop("_notice")


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_notices, families`` (sorted, comma-joined) and the least certain notice's probability, of every row."""
    found = Scanner(docs).found(docs)
    told = found.groupBy("doc_id", "digest").agg(
        F.count("*").alias("n_notices"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.min("probability").alias("probability"),
    ).toDF("k", "d", "n_notices", "families", "probability")
    rows = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("digest"))
    joined = rows.join(told, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")), "left")
    return joined.select(
        "doc_id",
        F.coalesce("n_notices", F.lit(0).cast("bigint")).alias("n_notices"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.round("probability", 4).alias("probability"),
    )
