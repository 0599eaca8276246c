"""Licence scans by sentence rules.

Comment marks are stripped, the text is cut into sentences, each is normalised and looked up among known licence sentences, and the
sequence of the identifiers found is matched against rules in order: a rule that finds its sentences side by side claims them, and later
rules see the rest. Lines are read in two ways, as wrapped only where a line goes on in lower case, and as wrapped throughout a paragraph;
the reading with more known sentences counts, the first one of equal ones. An SPDX tag names its licence itself, whatever expression
it holds. DataFrame functions only, within the row.

Cases: a null or empty text has no sentences and no licence; a sentence with a licence word that is not known is counted as unknown;
repeated rows get a row each; the other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words without which no known sentence can be, known sentences after normalisation, and rules in order.
LICENCE_WORDS = ["licen", "copyright", "permission", "warrant", "redistribut", "spdx", "public domain", "merchantab", "liable"]

SENTENCES = {
    "released under the mit license": "mit_ref",
    "licensed under the mit license": "mit_ref",
    "this software is released under the mit license": "mit_ref",
    "the mit license": "mit_title",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
    "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software":
        "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement": "as_is",
    "licensed under the apache license version 2.0": "apache2_ref",
    "licensed under the apache license version 2.0 the license": "apache2_ref",
    "released under the apache license version 2.0": "apache2_ref",
    "you may not use this file except in compliance with the license": "apache2_comply",
    "you may obtain a copy of the license at": "apache2_copy",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "licensed under the gnu general public license version 3": "gpl3_ref",
    "released under the gnu general public license version 3": "gpl3_ref",
    "this work is licensed under the gnu general public license version 2": "gpl2_ref",
    "licensed under the gnu general public license version 2": "gpl2_ref",
    "either version 3 of the license or at your option any later version": "or_later",
    "licensed under the gnu lesser general public license version 3": "lgpl3_ref",
    "licensed under the mozilla public license version 2.0": "mpl2_ref",
    "licensed under cc by nc 4.0": "cc_by_nc_4",
    "licensed under cc by nc sa 4.0": "cc_by_nc_sa_4",
    "licensed under cc by 4.0": "cc_by_4",
    "licensed under cc by sa 4.0": "cc_by_sa_4",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc_by_4",
    "this work is dedicated to the public domain": "public_domain",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
    "are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer":
        "bsd_source",
    "all rights reserved": "reserved",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied": "apache2_as_is",
    "see the license for the specific language governing permissions and limitations under the license": "apache2_see",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
    "foundation": "gpl_terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software "
    "foundation": "lgpl_terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software "
    "foundation": "agpl_terms",
    "either version 2 of the license or at your option any later version": "or_later_2",
    "either version 2.1 of the license or at your option any later version": "or_later_2_1",
    "version 2 of the license": "only_2",
    "version 2.1 of the license": "only_2_1",
    "version 3 of the license": "only_3",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2_terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "mpl2_copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "mpl2_copy",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission": "bsd_names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd_as_is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
    "above copyright notice and this permission notice appear in all copies": "isc_grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties "
    "of merchantability and fitness": "isc_as_is",
}

RULES = [
    ("MIT", ["mit_title", "mit_grant", "mit_notice", "as_is"]),
    ("MIT", ["mit_grant", "mit_notice", "as_is"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply", "apache2_copy", "apache2_as_is", "apache2_see"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply", "apache2_copy"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply"]),
    ("GPL-3.0-or-later", ["gpl3_ref", "or_later"]),
    ("GPL-3.0-or-later", ["gpl_terms", "or_later"]),
    ("GPL-2.0-or-later", ["gpl_terms", "or_later_2"]),
    ("GPL-3.0-only", ["gpl_terms", "only_3"]),
    ("GPL-2.0-only", ["gpl_terms", "only_2"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "or_later"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "or_later_2_1"]),
    ("LGPL-3.0-only", ["lgpl_terms", "only_3"]),
    ("LGPL-2.1-only", ["lgpl_terms", "only_2_1"]),
    ("AGPL-3.0-or-later", ["agpl_terms", "or_later"]),
    ("AGPL-3.0-only", ["agpl_terms", "only_3"]),
    ("MPL-2.0", ["mpl2_terms", "mpl2_copy"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("BSD", ["bsd_grant", "bsd_source"]),
    ("ISC", ["isc_grant", "isc_as_is"]),
    ("ISC", ["isc_grant"]),
    ("Apache-2.0", ["apache2_ref"]),
    ("MIT", ["mit_ref"]),
    ("MIT", ["mit_title"]),
    ("GPL-3.0-only", ["gpl3_ref"]),
    ("GPL-2.0-only", ["gpl2_ref"]),
    ("LGPL-3.0-only", ["lgpl3_ref"]),
    ("MPL-2.0", ["mpl2_ref"]),
    ("CC-BY-NC-SA-4.0", ["cc_by_nc_sa_4"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_4"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_4"]),
    ("CC-BY-4.0", ["cc_by_4"]),
    ("public-domain", ["public_domain"]),
    ("proprietary", ["reserved"]),
]

SENTENCE_END = r"[.!?;:][ \t\r\n]+|[\r\n]+"
#: What stands before the lines of a comment, and behind it.
COMMENT = r"(^|\n)[ \t]*(?://+|#+|/?\*+|--+|%+|;+)[ \t]*"
COMMENT_END = r"[ \t]*\*+/"
#: A line that goes on in lower case belongs to the sentence before it; in the other reading every line of a paragraph does.
WRAPPED = r"[ \t]*\r?\n[ \t]*([a-z(])"
JOINED = r"[ \t]*\r?\n[ \t]*([^ \t\r\n])"
#: The version of a licence is a sentence of its own, behind a semicolon or a comma.
VERSION = r",[ \t]+(either version|version [0-9.]+ of the License)"
#: A tag with its expression.
TAG = r"SPDX-License-Identifier:[ \t]*((?:[A-Za-z0-9.+()-]+[ \t]+(?:AND|OR|WITH)[ \t]+)*[A-Za-z0-9.+()-]*[A-Za-z0-9+)])"
#: A known sentence must have a licence word, unless it only counts beside others.
ANY_WORD = "(?i)" + "|".join([*LICENCE_WORDS, r"all\W+rights\W+reserved", r"at\W+your\W+option", r"copy\W+of\W+the\W+mpl"])


def normalised(sentence: Column) -> Column:
    """Lower case, everything but letters, digits and inner dots as single blanks."""
    plain = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"\.+( |$)", " "), " +", " "))


def licence_sentences(text: Column, lines: str = WRAPPED) -> Column:
    """The normalised sentences of a text that have a licence word; tags are left out. NULL if the text has none."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, TAG, "\n"), COMMENT, "$1"), COMMENT_END, "")
    whole = F.regexp_replace(F.regexp_replace(plain, lines, " $1"), VERSION, "; $1")
    cut = F.filter(F.split(whole, SENTENCE_END), lambda s: s.rlike(ANY_WORD))
    return F.when(text.rlike(ANY_WORD), F.transform(cut, normalised))


def tags(text: Column) -> Column:
    """The expressions of a text's SPDX tags."""
    return F.when(F.contains(text, F.lit("SPDX-License-Identifier:")), F.regexp_extract_all(text, F.lit(TAG), 1))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, sentence_ids (known sentences in order), licences (in the order of the rules, then those of tags, each once), n_unknown
    (sentences with a licence word that are not known). Lists are comma-joined."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in RULES])
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).alias("id"), tags(whole).alias("tags"),
                       F.array(licence_sentences(whole), licence_sentences(whole, JOINED)).alias("ways"))
    found = F.transform("ways", lambda w: F.struct(F.filter(F.transform(w, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull()).alias("ids"),
                                                   F.size(w).alias("n")))
    rows = rows.select("id", "tags", found.alias("ways"))
    better = F.coalesce(F.size(F.col("ways")[1]["ids"]) > F.size(F.col("ways")[0]["ids"]), F.lit(False))
    rows = rows.select("id", "tags", F.when(better, F.col("ways")[1]).otherwise(F.col("ways")[0]).alias("way")).select("id", "tags", "way.ids", "way.n")
    start = F.struct(F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">")).alias("rest"), F.array().cast("array<string>").alias("found"))
    claimed = F.aggregate(rules, start, lambda a, r: F.when(F.contains(a["rest"], r["ids"]), F.struct(
        F.replace(a["rest"], r["ids"], F.lit("|")).alias("rest"), F.array_append(a["found"], r["name"]).alias("found"))).otherwise(a))["found"]
    none = F.array().cast("array<string>")
    named = F.concat(F.when(F.size("ids") > 0, claimed).otherwise(none), F.coalesce("tags", none))
    return rows.select(F.col("id").alias(doc_id), F.coalesce(F.array_join("ids", ","), F.lit("")).alias("sentence_ids"),
                       F.array_join(F.array_distinct(named), ",").alias("licences"),
                       F.coalesce(F.col("n") - F.size("ids"), F.lit(0)).cast("long").alias("n_unknown"))


def oracle_sql(table: str = "documents") -> str:
    """The same in SQL: the rules as one step after the other."""
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def replaced(inside: str, pattern: str, new: str) -> str:
        return f"regexp_replace({inside}, '{pattern}', {new}, 'g')"

    def reading(lines: str) -> str:
        plain = replaced(replaced(replaced("coalesce(text, '')", TAG, "chr(10)"), COMMENT, "'\\1'"), COMMENT_END, "''")
        whole = replaced(replaced(plain, lines, "' \\1'"), VERSION, "'; \\1'")
        return (f"list_transform(list_filter(regexp_split_to_array({whole}, '{SENTENCE_END}'), lambda s: regexp_matches(s, '{ANY_WORD}')), "
                f"lambda s: {normal})")

    known = "MAP {" + ", ".join(f"{text(k)}: {text(v)}" for k, v in SENTENCES.items()) + "}"
    plain = "regexp_replace(lower(s), '[^a-z0-9.]+', ' ', 'g')"
    normal = f"trim(regexp_replace(regexp_replace({plain}, '\\.+( |$)', ' ', 'g'), ' +', ' ', 'g'))"
    steps, last = [], "r0"
    for i, (name, ids) in enumerate(RULES, 1):
        side = text("".join(f"<{x}>" for x in ids))
        steps.append(f"r{i} AS (SELECT doc_id, sentence_ids, n_unknown, tags, replace(rest, {side}, '|') AS rest, CASE WHEN contains(rest, {side}) "
                     f"AND NOT list_contains(found, {text(name)}) THEN list_append(found, {text(name)}) ELSE found END AS found FROM {last})")
        last = f"r{i}"
    ids = f"lambda w: list_filter(list_transform(w, lambda s: {known}[s]), lambda x: x IS NOT NULL)"
    return f"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{TAG}', 1) AS tags, [{reading(WRAPPED)}, {reading(JOINED)}] AS ways FROM {table}),
ways AS (SELECT doc_id, tags, ways, list_transform(ways, {ids}) AS found FROM cut),
known AS (
  SELECT doc_id, tags, CASE WHEN len(found[2]) > len(found[1]) THEN found[2] ELSE found[1] END AS ids,
         CASE WHEN len(found[2]) > len(found[1]) THEN len(ways[2]) ELSE len(ways[1]) END AS n FROM ways),
r0 AS (
  SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, CAST(n - len(ids) AS BIGINT) AS n_unknown,
         '<' || coalesce(array_to_string(ids, '><'), '') || '>' AS rest, tags, CAST([] AS VARCHAR[]) AS found FROM known),
{", ".join(steps)}
SELECT doc_id, sentence_ids, coalesce(array_to_string(list_concat(found, list_filter(tags, lambda t, i: NOT list_contains(found, t) AND NOT
  list_contains(tags[1:i - 1], t))), ','), '') AS licences, n_unknown FROM {last}"""
