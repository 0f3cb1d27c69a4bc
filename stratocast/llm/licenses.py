"""Licence scans: normalised text against templates by Dice coefficient over word bigrams, in DataFrame functions alone.

A text is its sequence of words, across line breaks and comment marks, so that a header wrapped over many lines is found within longer text. Passages that may be a template are the windows of as many
words as it has (or up to the end of the text) that begin with one of its bigrams. A window whose distinct bigrams number n can only reach a Dice coefficient of t with
a template of m if t/(2-t) * m <= n <= (2-t)/t * m, and only if it shares t/(2-t) * m bigrams or more. So of any words that more than the rest of a template's bigrams contain, a match
has one: a few such words per template tell at once, by plain substring search, which documents can have a match, and the others' bigrams are never formed. Bigrams of
the rest meet those of the templates by an equi-join with a table whose size the templates fix, which is broadcast after its rows are counted. Windows are frames over the
bigrams that were met; only windows with enough of these are looked at in full. No text is shuffled but those.

Defined cases: null and empty texts have no licence; a text of one word has no bigram; of a template's windows in a document the best counts, the first of
equally good ones; equal coefficients go to the template that comes first by name; rows with the same doc_id are one document, each text for itself; other columns are not carried.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.llm._common import LOWER, UPPER

THRESHOLD = 0.8

#: Notices and texts by which licences are granted.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0 header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd-3-clause conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("cc-by-4.0 notice", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0 notice", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0 long notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0 header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "isc permission",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mit notice", "Released under the MIT License."),
    (
        "mit permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "mit text",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "bsd disclaimer",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "mpl-2.0 header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)


def bigrams(text: Column) -> Column:
    """Pairs of neighbouring words of the normalised text, in order (ASCII letters folded; digits kept; all else parts words)."""
    folded = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))
    words = F.split(folded, " ")
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def template_table(spark: SparkSession, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(gram, template, long, m, low, high): each bigram of each template, with the template's bigrams in all, those that differ, and the sizes of windows that can reach the threshold."""
    table = spark.createDataFrame(list(templates), "template string, body string").select("template", bigrams(F.col("body")).alias("all"))
    table = table.withColumn("long", F.size("all")).withColumn("grams", F.array_distinct("all")).withColumn("m", F.size("grams"))
    bound = F.col("m") * threshold / (2 - threshold)
    table = table.withColumn("low", F.ceil(bound - 1e-9)).withColumn("high", F.floor(F.col("m") * (2 - threshold) / threshold + 1e-9))
    return table.select("template", "long", "m", "low", "high", F.explode("grams").alias("gram"))


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Whether a text can have a passage that reaches the threshold with a template, by plain searches for words.

    Such a passage lacks few of the template's bigrams, so it has one of the longest words, of which as many are asked for as more bigrams contain; and, since every bigram has two ends, so many different
    words that their bigrams add up to twice those that it must share. The second is asked of short templates, whose words are common.
    """
    # The text is folded once: what a lambda gets is a value, while a column would be folded for every word.
    return F.exists(F.array(F.lower("text")), lambda folded: _signs(folded, templates, threshold))


def _signs(folded: Column, templates, threshold: float) -> Column:
    has = lambda w: F.contains(folded, F.lit(w))
    chosen: set[str] = set()
    each: list[Column] = []
    for _, body in templates:
        words = re.sub("[^a-z0-9]+", " ", body.lower()).split()
        pairs = set(zip(words[:-1], words[1:], strict=True))
        least = math.ceil(threshold / (2 - threshold) * len(pairs) - 1e-9)
        own: list[str] = []
        for word in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(1 for p in pairs if set(own) & set(p)) > len(pairs) - least:
                break
            own.append(word)
        chosen |= set(own)
        sign = reduce(lambda a, b: a | b, [has(w) for w in own])
        if len(words) <= 16:
            degrees = sorted((sum((p[0] == w) + (p[1] == w) for p in pairs) for w in set(words)), reverse=True)
            k = next(i for i in range(len(degrees) + 1) if sum(degrees[:i]) >= 2 * least)
            sign = sign & (reduce(lambda a, b: a + b, [has(w).cast("int") for w in sorted(set(words))]) >= k)
        each.append(sign)
    return reduce(lambda a, b: a | b, [has(w) for w in sorted(chosen)]) & reduce(lambda a, b: a | b, each)


def match_licenses(docs: DataFrame, templates: DataFrame, signs: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, template, dice, start) of every document and template with a window at or above the threshold: the best one's coefficient, and its first word; ``signs`` is what ``anchors`` gives of the same templates."""
    rows = docs.where("text IS NOT NULL").where(F.lit(True) if signs is None else signs).select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    # Texts are dealt once, by row; all that follows of a text stays where it is. Rows that repeat are one.
    some = rows.repartition("row").dropDuplicates(["row"])
    few = templates.count() <= 100_000
    each = some.select("doc_id", "row", F.posexplode(bigrams(F.col("text"))).alias("i", "gram"))
    hits = each.join(F.broadcast(templates) if few else templates, "gram")
    # How many bigrams of the template a window has, of those that differ. Windows begin where one of these lies: a place adds to all windows from the last place of the same bigram on that reach it.
    place = ["row", "doc_id", "template"]
    same = F.lag("i").over(W.partitionBy(*place, "gram").orderBy("i"))
    facts = ["long", "m", "low", "high"]
    hits = hits.withColumn("after", F.greatest(F.coalesce(same, F.lit(-1)), F.col("i") - F.col("long")))
    events = F.array(F.struct((F.col("after") + 1).alias("at"), F.lit(1).alias("step"), F.lit(None).cast("int").alias("i")), F.struct((F.col("i") + 1).alias("at"), F.lit(-1).alias("step"), F.lit(None).cast("int").alias("i")), F.struct(F.col("i").alias("at"), F.lit(0).alias("step"), F.col("i").alias("i")))
    steps = hits.select(*place, *facts, F.explode(events).alias("e")).select(*place, *facts, "e.*")
    common = F.sum("step").over(W.partitionBy(*place).orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow))
    found = steps.withColumn("common", common).where("i IS NOT NULL AND common >= low")
    # The same columns as above, so that the texts aren't dealt again.
    met = found.drop("doc_id").join(some.select("row", "doc_id", "text"), "row").withColumn("grams", bigrams(F.col("text")))
    n = F.size(F.array_distinct(F.slice("grams", F.col("i") + 1, F.col("long"))))
    sized = met.withColumn("n", n).where(F.col("n").between(F.col("low"), F.col("high"))).withColumn("dice", 2.0 * F.col("common") / (F.col("n") + F.col("m")))
    best = sized.where(F.col("dice") >= threshold - 1e-12).groupBy("doc_id", "template").agg(F.min(F.struct((-F.col("dice")).alias("worst"), "i")).alias("b"))
    return best.select("doc_id", "template", (-F.col("b.worst")).alias("dice"), F.col("b.i").alias("start"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = match_licenses(docs, template_table(spark), anchors())
    best = F.min(F.struct((-F.col("dice")).alias("worst"), "template")).alias("best")
    by_doc = found.groupBy("doc_id").agg(best, F.count("*").alias("n_matches"), F.array_join(F.array_sort(F.collect_list("template")), ",").alias("licenses"))
    ids = docs.select("doc_id").distinct()
    out = ids.join(by_doc.withColumnRenamed("doc_id", "__doc"), ids["doc_id"].eqNullSafe(F.col("__doc")), "left")
    return out.select("doc_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.col("best.template").alias("best_template"), F.round(-F.col("best.worst"), 6).alias("best_dice"))


_VALUES = ", ".join("('{}', '{}')".format(*[x.replace("'", "''") for x in t]) for t in TEMPLATES)
_GRAMS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
_WORDS = "string_split(trim(regexp_replace(translate({}, '" + UPPER + "', '" + LOWER + "'), '[^a-z0-9]+', ' ', 'g')), ' ')"

ORACLE_SQL = f"""
WITH t AS (SELECT template, {_GRAMS} AS tg FROM (SELECT template, {_WORDS.format('body')} AS w FROM (VALUES {_VALUES}) v(template, body))),
d AS (SELECT row_number() OVER () AS r, doc_id, {_GRAMS} AS g FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL)),
h AS (SELECT r, template, len(tg) AS long, x.i AS i, x.gram AS gram FROM (SELECT r, unnest(list_zip(range(1, len(g) + 1), g)) AS p, struct_pack(i := p[1], gram := p[2]) AS x FROM d) e, t WHERE list_contains(tg, x.gram)),
c AS (SELECT a.r, a.template, a.i, count(DISTINCT b.gram) AS common FROM h a JOIN h b ON a.r = b.r AND a.template = b.template AND b.i BETWEEN a.i AND a.i + a.long - 1 GROUP BY ALL),
m AS (SELECT doc_id, template, 2.0 * common / (len(list_distinct(g[i:i + len(tg) - 1])) + len(list_distinct(tg))) AS dice FROM c JOIN d USING (r) JOIN t USING (template) WHERE 2.0 * common / (common + len(list_distinct(tg))) >= {THRESHOLD} - 1e-12),
f AS (SELECT doc_id, template, max(dice) AS dice FROM m WHERE dice >= {THRESHOLD} - 1e-12 GROUP BY ALL),
b AS (SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(template)), ',') AS l, min(struct_pack(a := -dice, b := template)) AS best FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(l, '') AS licenses, best.b AS best_template, round(-best.a, 6)::DOUBLE AS best_dice
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN b ON d.doc_id IS NOT DISTINCT FROM b.doc_id
"""
