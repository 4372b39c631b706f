"""License scan by diagonal voting.

Templates are names of licenses ("apache license") and notices (their usual paragraphs). Hashes of
all rolling word k-grams of a text, k being SHORT for names and LONG for notices, are joined to the
positions of the same k-grams in the templates. A hit at word p of the text and word t of the
template votes for the diagonal p - t, the place where the template would start. Diagonals of a notice that
are at most MERGE apart are one span, as words put in or left out move the rest by as much. A hit counts only if its words equal
the template's, so hashes decide nothing; a name needs all its words on one diagonal, a notice SHARE
of its words in a span not longer than its words / SHARE.

The words of a text are runs of ASCII letters and digits and of all characters above; A-Z are
lower-cased. The templates are a parameter and small: their k-grams are broadcast after a check of
their size, the texts' k-grams never leave their task unless they hit. A row of the table is known by
a number of its own, so null and repeated ids are rows like others; a null or empty text has no
words. Ties don't arise: spans are sets, texts of labels are sorted. An empty table stays empty.
A very long text is one array of words in its task. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustledger.llm.common import text_of
from gustledger.operators import joins
from gustledger.sources import files

WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
SHORT, LONG = 2, 5
MERGE, SHARE = 8, 0.8
_ROW = -1  # the number of the entry that every row of the table meets once

# The phrases that the scan has at least, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Names of licenses as texts write them, and the labels that they add.
NAMES = {
    "apache license version 2 0": "apache-2.0",
    "gnu general public license": "gnu",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
    "cc by nd 4 0": "cc-by-nd",
    "cc by nc sa 4 0": "cc-by-nc-sa",
    "cc by nc nd 4 0": "cc-by-nc-nd",
    "cc0 1 0": "cc0",
}

# The public notices that authors are asked to put into their files.
NOTICES = {
    "mit-notice": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "bsd-notice": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "isc-notice": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    "apache-notice": """you may not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    "mpl-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense-notice": """This is free and unencumbered software released into the public domain. Anyone is free to
        copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}


def words(text: Column) -> Column:
    """Lower-cased words. Of the characters above ASCII only the Kelvin sign is lower-cased into it, so it becomes another letter."""
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("K"), F.lit("ĸ"))), F.lit(WORD), F.lit(0))


def plain_words(text: str) -> list[str]:
    """The words of a template; ASCII only."""
    if not text.isascii():
        raise ValueError(f"a template must be ASCII: {text[:40]!r}")
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


class Templates:
    """Names and notices with their numbers; ``base`` marks the names whose places are counted."""

    def __init__(self, base: dict[str, str] = BASE, names: dict[str, str] = NAMES, notices: dict[str, str] = NOTICES):
        listed = [(plain_words(t), label, True, True) for t, label in base.items()]
        listed += [(plain_words(t), label, False, True) for t, label in names.items()]
        listed += [(plain_words(t), label, False, False) for label, t in notices.items()]
        if any(len(w) < (SHORT if exact else LONG) for w, _, _, exact in listed):
            raise ValueError(f"a name has {SHORT} words or more, a notice {LONG}")
        self.listed = listed

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, label, base, exact, len(w)) for i, (w, label, base, exact) in enumerate(self.listed)]
        return files.constants(spark, rows, "template int, label string, base boolean, exact boolean, length int")

    def grams(self, spark: SparkSession) -> DataFrame:
        """(hash, template, at, gram): every k-gram's places in the templates, and the entry that each row meets."""
        rows = [(_ROW, 0, [""])]
        for i, (w, _, _, exact) in enumerate(self.listed):
            k = SHORT if exact else LONG
            rows += [(i, t, w[t : t + k]) for t in range(len(w) - k + 1)]
        frame = files.constants(spark, rows, "template int, at int, gram array<string>")
        by_size = F.when(F.size("gram") == 1, _hash([F.lit("")])).when(
            F.size("gram") == SHORT, _hash([F.get("gram", F.lit(i)) for i in range(SHORT)])
        ).otherwise(_hash([F.get("gram", F.lit(i)) for i in range(LONG)]))
        return frame.select(by_size.alias("hash"), "template", "at", "gram")


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(parts)), *parts)


def hits(docs: DataFrame, templates: Templates, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, template, at, word): equal k-grams of texts and templates, and one entry of template -1 for each row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words(text_of(text)).alias("words"))
    # Two numbers for every word, one for each k, and -1. The outer form keeps Spark from adding a filter that splits all texts once more.
    turns = F.sequence(F.lit(-1), 2 * F.size("words") - 1)
    turned = rows.select("*", F.explode_outer(turns).alias("turn"))
    word, long = F.shiftright("turn", 1), F.col("turn") % 2 == 1

    def gram(k: int) -> Column:
        parts = [F.get("words", word + i) for i in range(k)]
        return F.when(word + k <= F.size("words"), _hash(parts))

    key = F.when(F.col("turn") < 0, _hash([F.lit("")])).when(long, gram(LONG)).otherwise(gram(SHORT))
    found = joins.lookup_join(turned.select("*", key.alias("hash")), templates.grams(docs.sparkSession), ["hash"])
    row = F.col("template") == _ROW
    own = F.col("turn") < 0
    equal = F.when(row | own, row & own).otherwise(F.slice("words", word + 1, F.size("gram")) == F.col("gram"))
    return found.filter(equal).select(
        "row", "doc_id", F.size("words").cast("bigint").alias("n_words"), "template", "at", F.when(~row, word).alias("word")
    )


def spans(docs: DataFrame, templates: Templates | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Candidate spans: row, doc_id, n_words, label, base, first, last, share, found; rows without any have one of null label.

    ``share`` is the part of the template's words that verified k-grams cover, ``found`` says whether it is enough.
    """
    templates = templates or Templates()
    # A text's hits lie in one task from here on: there are at most a few for each of its words.
    votes = hits(docs, templates, doc_id, text).withColumn("diagonal", F.col("word") - F.col("at")).repartition("row")
    votes = votes.groupBy("row", "doc_id", "n_words", "template", "diagonal").agg(
        F.min("word").alias("low"), F.max("word").alias("high"), F.collect_set("at").alias("ats")
    )
    known = F.broadcast(templates.table(docs.sparkSession))  # a row for each template
    votes = votes.join(known, "template", "left")
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(in_order)
    new = F.coalesce((step > F.when(F.col("exact"), 0).otherwise(MERGE)).cast("int"), F.lit(0))
    runs = votes.withColumn("new", new).withColumn("span", F.sum("new").over(in_order))
    merged = runs.groupBy("row", "doc_id", "n_words", "template", "label", "base", "exact", "length", "span").agg(
        F.min("low").alias("first"), F.max("high").alias("high"), F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats")
    )
    k = F.when(F.col("exact"), SHORT).otherwise(LONG)
    covered = F.array_distinct(F.flatten(F.transform("ats", lambda t: F.sequence(t, t + k - 1))))
    last = F.col("high") + k - 1
    share = F.size(covered) / F.col("length")
    enough = F.when(F.col("exact"), share == 1.0).otherwise((share >= SHARE) & (last - F.col("first") + 1 <= F.col("length") / SHARE))
    return merged.select(
        "row", "doc_id", "n_words", "label", "base", F.col("first").cast("bigint").alias("first"), last.cast("bigint").alias("last"),
        F.when(F.col("label").isNotNull(), share).alias("share"), F.coalesce(enough, F.lit(False)).alias("found"),
    )


def scan(docs: DataFrame, templates: Templates | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of base names, first_word and last_word are the smallest and largest of
    them; score is the largest share of a notice or name found in one span, 0 without any.
    """
    place = F.col("found") & F.col("base")
    joined = lambda of: F.array_join(F.sort_array(F.collect_set(F.when(of, F.col("label")))), ",")
    found = spans(docs, templates, doc_id, text)
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(place).alias("n_base"), F.min(F.when(place, F.col("first"))).alias("first_word"), F.max(F.when(place, F.col("first"))).alias("last_word"),
        joined(place).alias("base_labels"), joined(F.col("found")).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    ).drop("row")
