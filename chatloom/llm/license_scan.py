"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle
containment verifies them.

Texts are lower-cased word sequences; a shingle is five words. A window's bands are its smallest
shingle hashes. Of a template, the windows at every offset are sketched; of a text, overlapping
windows of the same sizes:
  * A template of fewer than LONG shingles takes windows of min(4, its shingles), in a text at every
    place, with one band. A changed word costs up to five shingles, so a copy that keeps 0.8 of so
    few has lost words at its ends only and holds a whole window of the template: equal windows have
    equal MinHashes, so it is retrieved with certainty.
  * A longer one takes windows of WINDOW shingles, in a text at every half window, with BANDS bands.
    An edit inside costs at least four shingles, so a copy that keeps 0.8 of n keeps a run of eight
    or more (n = 20 with one edit is the worst). Some window of the text covers six of the eight: a
    Jaccard similarity of at least 6/10, and a retrieval with probability 1 - 0.4^BANDS = 0.974 or
    more for each such run; there are two in the worst case (0.9993), and runs of eleven are certain.

A band is the hash of one of its window's shingles, so texts without any shingle of any template
are passed over before their windows are sketched. A retrieved template counts if at least `share`
of its distinct shingles occur, word for word, anywhere in the text. Only band hashes and template
shingles that occur are shuffled, never texts. The hashes of the templates are looked up in a bitmap
of at most 4 MB in the plan, and what it lets through is joined with their table by broadcast;
templates of more than LITERALS words together are taken in several passes of at most that.

Defined cases: a null text, or one of fewer than five words, holds no license, and a template of
fewer than five words is never found; several licenses of one text are all reported; rows that
repeat id and text each get the same row; a null doc_id is a row like any other; a very long text is
read whole, and gives at most one row a band and one a place where a template's shingle stands;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table

SHINGLE = 5
WINDOW = 8
BANDS = 4
#: Templates of fewer shingles take short windows.
LONG = 16
SHORT_WINDOWS = (1, 2, 3, 4)
SHARE = 0.8
#: Words of templates that one pass takes.
LITERALS = 1_000_000
#: The bitmap of the templates' hashes: powers of two.
LEAST_BITS, MOST_BITS = 22, 25

#: Short notices and the characteristic passages of common public licenses.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense-grant": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "bsd-binary-clause": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."
    ),
    # Whole texts of the short licenses.
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
        "an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    # Passages short enough that another version or family of the same header misses more than a fifth of them.
    "gpl-2.0-header": "terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    "lgpl-3.0-header": "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License",
    "agpl-3.0-header": "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    "cc0-1.0-dedication": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

#: The usual names of each family of validate.LICENSES, of at least SHINGLE words or made so by a verb before.
_NAMES = {
    "apache-2.0": ("Apache License Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "mit": ("MIT License", "terms of the MIT License"),
    "bsd-3-clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "bsd-2-clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "gpl-3.0": ("GNU General Public License version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU GPL v3"),
    "gpl-2.0": ("GNU General Public License version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU GPL v2"),
    "lgpl-3.0": ("GNU Lesser General Public License version 3", "GNU Lesser General Public License v3.0", "GNU Lesser General Public License v3", "GNU LGPL v3"),
    "agpl-3.0": ("GNU Affero General Public License version 3", "GNU Affero General Public License v3.0", "GNU Affero General Public License v3", "GNU AGPL v3"),
    "mpl-2.0": ("Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0"),
    "cc-by-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc-4.0": ("released under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "unlicense": ("the terms of the Unlicense",),
    "openrail": ("CreativeML Open RAIL-M License", "BigScience OpenRAIL-M License"),
    "odc-by": ("ODC-BY 1.0", "Open Data Commons Attribution License"),
}
#: SPDX identifiers; one of a single word leaves a line of four words, too short for a shingle.
_SPDX = (
    "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "ODC-By-1.0",
)
_VERBS = ("licensed", "released")


def _notices() -> dict[str, str]:
    """The notices a name is found by: the name where it is a shingle itself, else each verb with it."""
    n_words = lambda t: len("".join(c if c.isalnum() else " " for c in t).split())
    out = {}
    for family, names in _NAMES.items():
        for i, name in enumerate(names):
            if n_words(name) >= SHINGLE:
                out[f"{family}-name-{i}"] = name
                continue
            for verb in _VERBS:
                article = "" if family.startswith(("cc", "odc")) else "the "
                out[f"{family}-name-{i}-{verb}"] = f"{verb} under {article}{name}"
    return out | {f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in _SPDX}


_known = {" ".join("".join(c.lower() if c.isalnum() else " " for c in t).split()) for t in TEMPLATES.values()}
TEMPLATES |= {k: t for k, t in _notices().items() if " ".join("".join(c.lower() if c.isalnum() else " " for c in t).split()) not in _known}

#: Words are runs of anything but ASCII signs and white space. No lambda is needed to drop empty
#: strings: leading and trailing separators are trimmed first.
_SEPARATOR_CHARS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SEPARATOR_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SEPARATORS))


def with_hashes(rows: DataFrame) -> DataFrame:
    """Adds `h`, the hash of each shingle of `tokens`. Each word is hashed once and a shingle from its words' hashes.
    The generators keep whatever filters come from computing them again."""
    each = F.expr("transform(tokens, t -> xxhash64(t))")
    joined = ", ".join(f"v[i + {k}]" for k in range(SHINGLE))
    runs = F.expr(f"transform(if(size(v) < {SHINGLE}, array(), sequence(0, size(v) - {SHINGLE})), i -> xxhash64({joined}))")
    return rows.select("*", F.explode_outer(F.array(each)).alias("v")).select("*", F.explode_outer(F.array(runs)).alias("h")).drop("v")


def _bands(size: int, step: int, among: str = "") -> str:
    """SQL: the bands of all windows of so many hashes in `h`, one window at least, at every `step` and
    at the end; only those x for which `among` holds, if it is given."""
    last = f"greatest(size(h) - {size - 1}, 1)"
    if size < WINDOW:
        found = f"transform(sequence(1, {last}, {step}), i -> array_min(slice(h, i, {size})))"
    else:
        starts = f"array_union(sequence(1, {last}, {step}), array({last}))"
        found = f"flatten(transform({starts}, i -> slice(array_sort(slice(h, i, {size})), 1, {BANDS})))"
    kept = f"filter({found}, x -> {among})" if among else found
    return f"transform(array_distinct({kept}), x -> named_struct('size', {size}, 'band', x))"


def _passes(templates: dict[str, str]) -> Iterator[dict[str, str]]:
    """The templates in parts of at most LITERALS words, or of one template."""
    part, n = {}, 0
    for name, text in templates.items():
        here = len(text.split())
        if part and n + here > LITERALS:
            yield part
            part, n = {}, 0
        part[name] = text
        n += here
    if part:
        yield part


def _sketched(spark: SparkSession, templates: dict[str, str]) -> tuple[list, list]:
    """Rows (size, band, license) and (hash, shingle, license, n_shingles): at most a few a word of the templates."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string").withColumn("tokens", words(F.col("text")))
    cut = with_hashes(rows)
    texts = F.expr(f"transform(h, (x, i) -> named_struct('hash', x, 'shingle', array_join(slice(tokens, i + 1, {SHINGLE}), ' ')))")
    kinds = [f"WHEN size(h) >= {LONG} THEN {_bands(WINDOW, 1)}"] + [f"WHEN size(h) {'=' if w < max(SHORT_WINDOWS) else '>='} {w} THEN {_bands(w, 1)}" for w in SHORT_WINDOWS]
    got = cut.select("license", F.expr(f"CASE {' '.join(kinds)} END").alias("bands"), texts.alias("shingles")).collect()
    own = {r["license"]: {x["shingle"]: x["hash"] for x in r["shingles"]} for r in got}
    return [(b["size"], b["band"], r["license"]) for r in got for b in r["bands"] or ()], [(h, x, name, len(found)) for name, found in own.items() for x, h in found.items()]


def _known(hashes: Iterable[int], of: str) -> str:
    """SQL: whether the hash `of` may be among these, by a bitmap in one literal; a join decides later."""
    seen = sorted(set(hashes))
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (4096 * len(seen)).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[np.array(seen, np.int64) % size] = 1
    longs = ",".join(map(str, np.packbits(bits, bitorder="little").view("<i8").tolist()))
    return f"getbit(get(cast(split('{longs}', ',') AS array<bigint>), cast(pmod({of}, {size}) div 64 AS int)), cast(pmod({of}, 64) AS int)) = 1"


def _scan(base: DataFrame, templates: dict[str, str]) -> DataFrame:
    """doc_id, text_hash, license, n_found, n_shingles, start of every retrieved template."""
    spark = base.sparkSession
    bands, shingles = _sketched(spark, templates)
    if not shingles:
        return base.select("doc_id", "text_hash", F.lit("").alias("license"), F.lit(0).alias("n_found"), F.lit(0).alias("n_shingles"), F.lit(0).alias("start")).limit(0)
    known = _known((x[0] for x in shingles), "x")
    keys = [_bands(w, 1 if w < WINDOW else w // 2, known) for w in sorted({b[0] for b in bands})]
    places = f"transform(filter(transform(h, (x, i) -> if({known}, i, -1)), i -> i >= 0), i -> named_struct('at', i, 'shingle', array_join(slice(tokens, i + 1, {SHINGLE}), ' ')))"
    touched = with_hashes(base).where(F.expr(f"exists(h, x -> {known})"))
    found = checkpointed(touched.select("doc_id", "text_hash", F.expr(f"concat({', '.join(keys)})").alias("bands"), F.expr(places).alias("places")))

    of_band = F.broadcast(spark.createDataFrame(bands, "size int, band long, license string"))  # bounded by LITERALS
    of_shingle = F.broadcast(spark.createDataFrame([x[1:] for x in shingles], "shingle string, license string, n_shingles int"))  # likewise
    names = ["doc_id", "text_hash", "license"]
    none = lambda kind: F.lit(None).cast(kind)
    retrieved = found.select("doc_id", "text_hash", F.inline("bands")).join(of_band, ["size", "band"]).select(*names, none("string").alias("shingle"), none("int").alias("n_shingles"), none("int").alias("at"))
    occurs = found.select("doc_id", "text_hash", F.inline("places")).join(of_shingle, "shingle").select(*names, "shingle", "n_shingles", "at")
    each = retrieved.union(occurs).groupBy(*names, "shingle").agg(F.max("n_shingles").alias("n_shingles"), F.min("at").alias("at"))
    return each.groupBy(*names).agg(
        F.count("shingle").cast("int").alias("n_found"), F.max("n_shingles").alias("n_shingles"), F.min("at").alias("start"), F.count_if(F.col("shingle").isNull()).alias("_retrieved")
    ).where("_retrieved > 0").drop("_retrieved")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per found license: doc_id, text_hash, license, n_found, n_shingles, start (word of its first shingle)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), words(F.col(text_col)).alias("tokens"))
    out = None
    for part in _passes(TEMPLATES if templates is None else templates):
        one = _scan(base, part)
        out = one if out is None else out.union(one)
    return out.where(F.col("n_found") >= F.col("n_shingles") * share)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("license", "n_found", "n_shingles"))).alias("found"))
    listed = F.array_join(F.transform("found", lambda x: F.concat(x["license"], F.lit(":"), x["n_found"], F.lit("/"), x["n_shingles"])), ",")
    hits = found.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.size("found").cast("long").alias("n_licenses"), listed.alias("licenses"))
    slim = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    out = slim.join(hits, slim.doc_id.eqNullSafe(hits._d) & (slim.text_hash == hits._t), "left")
    return out.select("doc_id", F.coalesce("n_licenses", F.lit(0).cast("long")).alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses"))


def _oracle() -> str:
    pattern = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    return f"""
WITH t AS (SELECT license, regexp_extract_all(lower(text), {pattern}) AS w FROM (VALUES {values}) v(license, text)),
ts AS (SELECT DISTINCT license, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
d AS (SELECT doc_id, regexp_extract_all(lower(text), {pattern}) AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
m AS (SELECT doc_id, license, count(*) AS k FROM ds JOIN ts USING (g) GROUP BY ALL),
f AS (SELECT doc_id, count(*) AS n_licenses, string_agg(license || ':' || k || '/' || n, ',' ORDER BY license) AS licenses
  FROM m JOIN tn USING (license) WHERE k >= n * 0.8 GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN f ON documents.doc_id = f.doc_id
"""


ORACLE_SQL = _oracle()
