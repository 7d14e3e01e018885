"""Licence scans: TF-IDF cosine to templates, and licences of the nearest directory. DataFrame operations only."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyjoin.llm.common import Stage

#: Licence texts, and the notices that longer licences ask for, by SPDX identifier. Fixed values.
TEMPLATES = [
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0, a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", "Released under the MIT License"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
]
#: Words too common to tell licences apart. Fixed values.
COMMON = "a an and any are as at be by either except for from in is it may not of on or or that the this to under use with without you".split()
FILE_NAMES = ("LICENSE", "LICENCE", "COPYING", "NOTICE")
TERM = "[a-z0-9]+"
#: What lies between paragraphs.
PARAGRAPH = r"\n[ \t\r]*\n"
LEAST_COSINE, LEAST_TERMS = 0.6, 2


def terms(text: Column) -> Column:
    """Terms of a text, in order."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda t: ~t.isin(COMMON))


def weights_of(frequency: DataFrame, total: int, templates: list[tuple[str, str]]) -> tuple[Column, list[str]]:
    """Per term of the templates its idf and its share of each template's vector, as a constant map; and the templates' names.

    frequency has a row (term, df) for each term of the templates at most: a bounded table, like the map.
    """
    df = {r["term"]: r["df"] for r in frequency.collect()}
    counts = [Counter(t for t in re.findall(TERM, text.lower()) if t not in COMMON) for _, text in templates]
    idf = {t: math.log((1 + total) / (1 + df.get(t, 0))) + 1 for c in counts for t in c}
    norms = [math.sqrt(sum((n * idf[t]) ** 2 for t, n in sorted(c.items()))) or 1.0 for c in counts]
    table = {t: {"idf": x, "w": [c[t] * x / norm for c, norm in zip(counts, norms)]} for t, x in sorted(idf.items())}
    return F.from_json(F.lit(json.dumps(table)), "map<string,struct<idf:double,w:array<double>>>"), [i for i, _ in templates]


def best_of(unit: Column, words: Column, table: Column, names: list[str], unseen: float, least_cosine: float, least_terms: int) -> Column:
    """(minus the cosine, identifier) of the best template of a unit's terms; NULL if none is good enough.

    Squares of the counts of all terms come from runs in the sorted terms, so a unit of any length is one pass after a
    sort; terms that no template has weigh the same, so only their squares are needed.
    """
    run = F.aggregate(
        F.array_sort(unit), F.struct(F.lit("").alias("term"), F.lit(0).cast("double").alias("n"), F.lit(0).cast("double").alias("squares")),
        lambda acc, t: F.when(acc["term"] == t, F.struct(t.alias("term"), (acc["n"] + 1).alias("n"), (acc["squares"] + 2 * acc["n"] + 1).alias("squares"))).otherwise(
            F.struct(t.alias("term"), F.lit(1.0).alias("n"), (acc["squares"] + 1).alias("squares"))),
        lambda acc: acc["squares"])
    known = F.transform(F.array_intersect(unit, words), lambda k: F.struct(F.size(F.filter(unit, lambda t: t == k)).cast("double").alias("n"), F.element_at(table, k).alias("e")))
    known = F.transform(known, lambda k: F.struct(k["n"].alias("n"), (k["n"] * k["e"]["idf"]).alias("v"), k["e"]["w"].alias("w")))

    def total(of, value):
        return F.aggregate(of, F.lit(0.0), lambda acc, x: acc + value(x))

    def scored(pair):
        k, squares = pair["known"], pair["squares"]
        norm = F.sqrt((squares - total(k, lambda x: x["n"] * x["n"])) * unseen**2 + total(k, lambda x: x["v"] * x["v"]))
            # the cosine with each template, and how many of its terms the unit has
        each = F.transform(F.array(*[F.struct(F.lit(n).alias("id"), F.lit(i).alias("i")) for i, n in enumerate(names)]), lambda m: F.struct(
            (-F.round(total(k, lambda x: x["v"] * F.get(x["w"], m["i"])) / norm, 9)).alias("minus"), m["id"].alias("id"),
            F.size(F.filter(k, lambda x: F.get(x["w"], m["i"]) > 0)).alias("shared")))
        return F.array_min(F.filter(each, lambda m: (m["minus"] <= -least_cosine) & (m["shared"] >= least_terms)))

    return F.get(F.transform(F.array(F.struct(known.alias("known"), run.alias("squares"))), scored), 0)


def scan(files: DataFrame, stage: Stage, *, templates: list[tuple[str, str]] = TEMPLATES, least_cosine: float = LEAST_COSINE, least_terms: int = LEAST_TERMS) -> DataFrame:
    """doc_id, path, own_licence, score, licence, licence_path for each row of files (doc_id, path, text).

    Files are compared line by line, and by paragraphs of several lines, such as headers; one named in FILE_NAMES as
    a whole too. Vectors hold term count times
    ln((1 + files) / (1 + files with the term)) + 1; terms that no template has count as terms of no file.
    own_licence is the template of the highest cosine, if that is least_cosine or more and both share at
    least_terms distinct terms; ties go to the first identifier. Without one, licence comes from the nearest
    directory, upwards from the file's own, that holds a licence file with a licence (of several, the first path).

    Texts are read once. Of each file the terms of those lines and paragraphs stay that share least_terms terms with the templates,
    and the file's distinct terms among the templates'; both are stored. They are then scored where they are: nothing but
    the files with each template term, a few counts, is shuffled for that. Rows alike each get their row.

    Null or empty text: no licence of its own. Null path: inherits nothing. Null doc_id stays null. Other
    columns are ignored; an empty table gives none.
    """
    vocabulary = sorted({t for _, text in templates for t in re.findall(TERM, text.lower()) if t not in COMMON})
    words = F.array(*[F.lit(t) for t in vocabulary])
    path, text = F.col("path").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), text.alias("text"))
    whole = F.coalesce(F.upper(name).isin(*FILE_NAMES), F.lit(False))
    blocks = F.filter(F.split("text", PARAGRAPH), lambda block: F.contains(block, F.lit("\n")))
    rows = rows.select("doc_id", "path", F.transform(F.split("text", "\n"), terms).alias("lines"),
                       F.transform(F.concat(blocks, F.when(whole, F.array("text")).otherwise(F.array())), terms).alias("longer"))
    near = F.filter(F.concat("lines", "longer"), lambda t: F.size(F.array_intersect(t, words)) >= least_terms)
    rows = stage.write(rows.select("doc_id", "path", F.array_intersect(F.flatten("lines"), words).alias("known"), near.alias("units")), "files")

    total = rows.count()
    frequency = rows.select(F.explode("known").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    table, names = weights_of(frequency, total, templates)
    best = F.array_min(F.transform("units", lambda u: best_of(u, words, table, names, math.log(1 + total) + 1, least_cosine, least_terms)))
    scored = rows.select("doc_id", "path", best.alias("best"))

    folder = F.when(F.col("path").isNotNull(), F.regexp_replace("path", "/?[^/]*$", ""))
    named = scored.select("doc_id", "path", folder.alias("folder"), F.col("best.id").alias("own_licence"), (-F.col("best.minus")).alias("score"))
    named = stage.write(named, "named")
    holders = named.where(F.upper(name).isin(*FILE_NAMES) & F.col("own_licence").isNotNull()).groupBy("folder").agg(F.min(F.struct("path", "own_licence")).alias("held"))
    depth = F.size(F.split("folder", "/"))
    above = named.where("folder IS NOT NULL").select("folder").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), depth)))
    above = above.withColumn("above", F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("substring_index(folder, '/', depth)")))
    near = above.join(holders.select(F.col("folder").alias("above"), "held"), "above").groupBy("folder").agg(F.max_by("held", "depth").alias("held"))
    out = named.join(near, "folder", "left")
    own = F.col("own_licence").isNotNull()
    return out.select("doc_id", "path", "own_licence", "score", F.coalesce("own_licence", "held.own_licence").alias("licence"),
                      F.when(own, F.col("path")).otherwise(F.col("held.path")).alias("licence_path"))


def document_files(documents: DataFrame, shelf: int = 500, short: int = 250) -> DataFrame:
    """Documents as files: source/lang/shelf/doc_id.txt, shelf for shelf numbers each. Texts of at most short
    characters stand for licence files, of the shelf or, with even doc_id, of the language."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    own = F.concat_ws("/", top, F.floor(F.col("doc_id") / shelf).cast("string"))
    brief = F.length(F.coalesce("text", F.lit(""))) <= short
    path = F.when(brief & (F.col("doc_id") % 2 == 0), F.concat_ws("/", top, F.lit("LICENSE"))).when(brief, F.concat_ws("/", own, F.lit("LICENSE"))).otherwise(
        F.concat_ws("/", own, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    return documents.select("doc_id", path.alias("path"), "text")
