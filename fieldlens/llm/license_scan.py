"""License scan by diagonal voting, in DataFrame functions only.

All rolling ``K``-word grams of every document are joined to the gram positions
of the templates (a fixed small table, of any length).  A hit votes for the
diagonal (document position - template position); the votes of a diagonal are
bit masks of the template's positions, one for every ``BITS`` of them, so
repeated rows and both sides of a shuffle combine freely.  Diagonals at most
``SLACK`` apart merge (a word more or less shifts the rest of a passage).  The
merged span is then verified: its hits are read in document order and count
only while they move on in the template too, so pieces out of order or read
twice add nothing.  A template is found where this chain covers enough of it.
The join compares the gram's text as well as its hash, so every voted position
is verified, and full masks are the whole phrase word for word.

Scale: texts never shuffle.  Grams meet a broadcast table of a fixed size, only
hits and one marker row a document leave the scan, and they are combined before
the exchange.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import named, table

K = 3
SLACK = 2
COVER = 0.6
BITS = 62

# Base phrases (they count only word for word) and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Whole licence texts and notices, as published.
MIT_TEXT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
BSD_TEXT = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.
"""
GPL_NOTICE = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
"""
# Longer templates, found also with small changes.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved", "all-rights-reserved"),
    (MIT_TEXT, "mit"),
    (BSD_TEXT, "bsd"),
    (APACHE_NOTICE, "apache-2"),
    (GPL_NOTICE, "gpl-3"),
)
WORD_END = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def gram_positions(base=BASE, templates=TEMPLATES, k: int = K) -> list[dict]:
    """One entry per template position: template number, label, position,
    gram, and the number of grams.  A template holds at least ``k`` words."""
    out = []
    for t, (phrase, label) in enumerate((*base, *templates)):
        w = [x for x in re.split(WORD_END, phrase.lower()) if x]
        n = len(w) - k + 1
        if n < 1:
            raise ValueError(f"template must have at least {k} words: {phrase!r}")
        out += [{"t": t, "label": label, "base": t < len(base), "tpos": i, "grams": n, "gram": " ".join(w[i:i + k])}
                for i in range(n)]
    return out


def words(text: Column) -> Column:
    """Lower-cased words; null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UP, _LOW)
    return F.array_remove(F.split(low, WORD_END), "")


def chained(near: Column) -> Column:
    """Length of the chain of hits of neighbouring diagonals, an array of
    struct(at, seg, mask): in document order, a hit counts if it lies behind
    the last counted one in the document and in the template."""
    hits = F.array_sort(F.flatten(F.transform(near, lambda d: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.call_function("getbit", d["mask"], b) == 1),
        lambda b: F.struct((d["at"] + d["seg"] * BITS + b).alias("p"), (d["seg"] * BITS + b).alias("t"))))))
    start = F.struct(F.lit(-1).alias("p"), F.lit(-1).alias("t"), F.lit(0).alias("n"))
    return F.aggregate(hits, start, lambda a, x: F.when(
        (x["p"] > a["p"]) & (x["t"] > a["t"]),
        F.struct(x["p"].alias("p"), x["t"].alias("t"), (a["n"] + 1).alias("n"))).otherwise(a))["n"]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base=BASE, templates=TEMPLATES, cover: float = COVER, slack: int = SLACK) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans.

    ``n_base`` counts the places of base phrases, ``first_word``/``last_word``
    are their smallest and largest start (null without one).  ``spans`` lists
    what was found as struct(label, first_word, coverage), with coverage at
    least ``cover`` (base phrases: 1); ``score`` is the best coverage of any
    template, 0 without a hit.  Null and empty texts have no words and no hit.
    Repeated rows give one row each with equal values, null ids group by their
    text, an empty table gives no row.  Texts are read whole, whatever their
    length; other columns, of any name, play no part.
    """
    spark = docs.sparkSession
    grams = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(gram_positions(base, templates))),
        "array<struct<t:int,label:string,base:boolean,tpos:int,grams:int,gram:string>>"))) \
        .withColumn("h", F.xxhash64("gram"))
    w = docs.select(named(id_col).alias("id"), F.xxhash64(named(text_col)).alias("tx"), words(named(text_col)).alias("w"))
    rolled = w.select("id", "tx", F.size("w").alias("n"), F.when(F.size("w") >= K, F.transform(
        F.sequence(F.lit(0), F.size("w") - K),
        lambda i: F.concat_ws(" ", *(F.col("w")[i + j] for j in range(K))))).alias("g"))
    # place 0 marks the document itself, grams follow from place 1
    marker = F.array(F.lit(""))
    each = rolled.select("id", "tx", "n", F.posexplode(F.concat(marker, F.coalesce("g", F.array().cast("array<string>"))))
                         .alias("pos", "gram")).withColumn("h", F.xxhash64("gram"))
    hit = each.join(F.broadcast(grams), ["h", "gram"], "left").filter("pos = 0 OR t IS NOT NULL")
    votes = hit.groupBy("id", "tx", "t", "label", "base", "grams", (F.col("pos") - 1 - F.col("tpos")).alias("at"),
                        F.expr(f"tpos div {BITS}").cast("int").alias("seg")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, tpos % {BITS})")).alias("mask"), F.count("*").alias("rows"), F.max("n").alias("n"))
    near = Window.partitionBy("id", "tx", "t").orderBy("at").rangeBetween(-slack, slack)
    bits = lambda d: F.aggregate(d, F.lit(0), lambda n, x: n + F.bit_count(x["mask"]))
    merged = (
        votes.withColumn("near", F.collect_list(F.struct("at", "seg", "mask")).over(near))
        .withColumn("own", F.filter("near", lambda x: x["at"] == F.col("at")))
        # one row a diagonal, that of its first segment; the marker has none
        .filter("t IS NULL OR seg = array_min(own.seg)")
        .withColumn("voted", bits(F.col("own")))
        .withColumn("whole", F.col("voted") == F.col("grams"))
        .withColumn("cover", F.when(F.size("near") == F.size("own"), F.col("voted")).otherwise(
            chained(F.col("near"))) / F.col("grams"))
    )
    is_base = F.col("base") & F.col("whole")
    found = is_base | (~F.col("base") & (F.col("cover") >= cover))
    per_doc = merged.groupBy("id", "tx").agg(
        F.max("n").cast("bigint").alias("n_words"),
        F.max(F.when(F.col("t").isNull(), F.col("rows"))).alias("copies"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("at"))).cast("bigint").alias("first_word"),
        F.max(F.when(is_base, F.col("at"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_set(F.when(found, F.struct("label", F.col("at").alias("first_word"),
                                                          F.col("cover").alias("coverage"))))).alias("spans"))
    return per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score", "spans")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases of all documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")
