"""Licences named or granted in texts, by sentence rules; DataFrame functions only, no shuffle.

A text is cut into sentences, each is brought to a plain form (lower case, single spaces, no marks),
and plain sentences are mapped to the identifiers of licence sentences that they contain. Clauses of a
sentence count singly, and two neighbours together for what neither has alone. The sequence
of identifiers of a text is then matched against ordered rules, other identifiers in between allowed: longer, more telling
sequences first, and what a rule has used is not open to the rules after it.
"""

from pyspark.sql import functions as F

# A word of every sentence pattern, so a text or sentence without any has no identifier;
# where sentences end (line ends are \n by then) and clauses end (a semicolon, the point in "v. 2.0");
# sentence identifiers with a pattern of the plain form; licences with their identifiers in order. SPDX identifiers are read with their marks instead.
WORDS = r"(?i)licen[cs]|copyright|redistribut|permission|warrant|public|spdx|cc|version|rights|free|commons|endorse|software|gnu"
SENTENCE_ENDS = r"(?!(?<=[^A-Za-z0-9][Vv])\.[ \x09-\x0D]+[0-9])[.!?;]*[.!?][.!?;]*[ \x09-\x0D]+|\x0A[ \x09]*\x0A+"
CLAUSE_ENDS = r";+[ \x09-\x0D]+|(?<=[^A-Za-z0-9][Vv])\.[ \x09-\x0D]+(?=[0-9])"
SENTENCES = (
    ("spdx-mit", r"spdx license identifier mit( |$)"),
    ("spdx-apache-2", r"spdx license identifier apache 2 0( |$)"),
    ("spdx-gpl-2", r"spdx license identifier gpl 2 0( only)?( |$)"),
    ("spdx-gpl-3", r"spdx license identifier gpl 3 0( only)?( |$)"),
    ("spdx-bsd-3", r"spdx license identifier bsd 3 clause( |$)"),
    ("spdx-mpl-2", r"spdx license identifier mpl 2 0( |$)"),
    ("apache-2-grant", r"licensed under the apache license version 2 0"),
    ("apache-2-use", r"you may not use this file except in compliance with the license"),
    ("apache-2-copy", r"you may obtain a copy of the license at"),
    ("apache-2-as-is", r"distributed under the license is distributed on an as is basis"),
    ("apache-2-limits", r"see the license for the specific language governing permissions"),
    ("mit-named", r"(released|licensed|distributed|available) under (the terms of )?the mit licen[cs]e"),
    ("mit-title", r"the mit licen[cs]e mit( |$)"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit-as-is", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable"),
    ("gpl-free", r"this program is free software"),
    ("gpl-2-grant", r"gnu general public license( as published by the free software foundation( either)?)? (version 2|v2)( |$)"),
    ("gpl-3-grant", r"gnu general public license( as published by the free software foundation( either)?)? (version 3|v3)( |$)"),
    ("gpl-2-named", r"gnu gpl (version 2|v2)( |$)"),
    ("gpl-3-named", r"gnu gpl (version 3|v3)( |$)"),
    ("lgpl-21-grant", r"gnu (lesser|library) general public license( as published by the free software foundation( either)?)? version 2 1"),
    ("lgpl-3-grant", r"gnu lesser general public license( as published by the free software foundation( either)?)? version 3"),
    ("agpl-3-grant", r"gnu affero general public license( as published by the free software foundation( either)?)? version 3"),
    ("gpl-later", r"(at your option any later version|or at your option any later version|or any later version)"),
    ("gpl-no-warranty", r"without any warranty without even the implied warranty"),
    ("gpl-copy", r"you should have received a copy of the gnu( lesser| affero)? general public license"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-as-is", r"this software is provided by the copyright holders and contributors as is"),
    ("bsd-named", r"(released|licensed|distributed) under the (new |simplified |modified )?bsd licen[cs]e"),
    ("mpl-2-grant", r"subject to the terms of the mozilla public license v(ersion)? ?2 0"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("unlicense-grant", r"this is free and unencumbered software released into the public domain"),
    ("cc0-grant", r"(cc0|dedicated (this work )?to the public domain)"),
    ("cc-by-sa-3", r"(cc by sa|creative commons attribution sharealike) 3 0"),
    ("cc-by-3", r"(cc by|creative commons attribution) 3 0"),
    ("cc-by-nc-4", r"(cc by nc|creative commons attribution noncommercial) 4 0"),
    ("cc-by-sa-4", r"(cc by sa|creative commons attribution sharealike) 4 0"),
    ("cc-by-4", r"(cc by|creative commons attribution) 4 0"),
    ("all-rights", r"all rights reserved"),
)
RULES = (
    ("Apache-2.0", ("apache-2-grant", "apache-2-use", "apache-2-copy", "apache-2-as-is", "apache-2-limits")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-grant", "gpl-later")),
    ("GPL-3.0-or-later", ("gpl-3-grant", "gpl-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-grant", "gpl-later")),
    ("GPL-2.0-or-later", ("gpl-2-grant", "gpl-later")),
    ("LGPL-3.0-or-later", ("lgpl-3-grant", "gpl-later")),
    ("LGPL-2.1-or-later", ("lgpl-21-grant", "gpl-later")),
    ("AGPL-3.0-or-later", ("agpl-3-grant", "gpl-later")),
    ("Apache-2.0", ("apache-2-grant",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-title",)),
    ("GPL-3.0-only", ("gpl-3-grant",)),
    ("GPL-3.0-only", ("gpl-3-named",)),
    ("GPL-2.0-only", ("gpl-2-named",)),
    ("GPL-2.0-only", ("gpl-2-grant",)),
    ("LGPL-3.0-only", ("lgpl-3-grant",)),
    ("LGPL-2.1-only", ("lgpl-21-grant",)),
    ("AGPL-3.0-only", ("agpl-3-grant",)),
    ("MPL-2.0", ("mpl-2-grant",)),
    ("ISC", ("isc-grant",)),
    ("BSD", ("bsd-named",)),
    ("Unlicense", ("unlicense-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-3.0", ("cc-by-sa-3",)),
    ("CC-BY-3.0", ("cc-by-3",)),
    ("CC0-1.0", ("cc0-grant",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache-2",)),
    ("GPL-2.0-only", ("spdx-gpl-2",)),
    ("GPL-3.0-only", ("spdx-gpl-3",)),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("MPL-2.0", ("spdx-mpl-2",)),
)
SPDX = {
    "spdx-mit": "mit", "spdx-apache-2": "apache 2 0", "spdx-gpl-2": "gpl 2 0( only)?", "spdx-gpl-3": "gpl 3 0( only)?", "spdx-bsd-3": "bsd 3 clause", "spdx-mpl-2": "mpl 2 0",
    "spdx-gpl-2-later": r"gpl 2 0( or later|\+)", "spdx-gpl-3-later": r"gpl 3 0( or later|\+)",
    "spdx-bsd-2": "bsd 2 clause", "spdx-epl-2": "epl 2 0", "spdx-isc": "isc", "spdx-lgpl-21": "lgpl 2 1( only)?", "spdx-lgpl-21-later": r"lgpl 2 1( or later|\+)",
    "spdx-lgpl-3": "lgpl 3 0( only)?", "spdx-lgpl-3-later": r"lgpl 3 0( or later|\+)", "spdx-agpl-3": "agpl 3 0( only)?", "spdx-agpl-3-later": r"agpl 3 0( or later|\+)",
    "spdx-unlicense": "unlicense", "spdx-cc0": "cc0 1 0", "spdx-cc-by-4": "cc by 4 0", "spdx-cc-by-sa-4": "cc by sa 4 0",
}
SPDX_RULES = (
    ("GPL-2.0-or-later", ("spdx-gpl-2-later",)), ("GPL-3.0-or-later", ("spdx-gpl-3-later",)), ("BSD-2-Clause", ("spdx-bsd-2",)), ("EPL-2.0", ("spdx-epl-2",)),
    ("ISC", ("spdx-isc",)), ("LGPL-2.1-only", ("spdx-lgpl-21",)), ("LGPL-2.1-or-later", ("spdx-lgpl-21-later",)), ("LGPL-3.0-only", ("spdx-lgpl-3",)),
    ("LGPL-3.0-or-later", ("spdx-lgpl-3-later",)), ("AGPL-3.0-only", ("spdx-agpl-3",)), ("AGPL-3.0-or-later", ("spdx-agpl-3-later",)),
    ("Unlicense", ("spdx-unlicense",)), ("CC0-1.0", ("spdx-cc0",)), ("CC-BY-4.0", ("spdx-cc-by-4",)), ("CC-BY-SA-4.0", ("spdx-cc-by-sa-4",)),
)
# Fixed value: what may stand between the words of an SPDX tag and one of its identifiers, the others of the expression
SPDX_OTHERS = r"(?:[a-z0-9.+-]+[ )]+(?:or|and|with)[ (]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sequence(ids):
    return "".join(f"<{i}>" for i in ids)


def _spdx_start(name):
    return "spdx license identifier ".replace(" ", "[^a-z0-9]+") + SPDX_OTHERS + name.replace(" ", "[^a-z0-9]+")


def _spdx(name):
    """Pattern of an SPDX expression with this identifier and no longer one: MIT is not in MIT-0, nor GPL-2.0 in GPL-2.0+."""
    return _spdx_start(name) + r"(?![a-z0-9+]|[-.][a-z0-9])"


def _rule(ids):
    """Pattern of a rule: its identifiers in order, others in between allowed but not what a rule before has used; and what stays of it."""
    gap = "((?:<[^>]*>)*?)"
    return gap.join(f"<{i}>" for i in ids), range(1, len(ids))


def identifiers(text):
    """The identifiers of a text in order, as a string of <id>."""
    low = F.translate(F.regexp_replace(text, r"\r\n?", "\n"), UPPER, LOWER)
    plain = lambda s: F.btrim(F.regexp_replace(s, "[^a-z0-9]+", " "))
    sentences = F.filter(F.split(low, SENTENCE_ENDS), lambda s: F.rlike(s, F.lit(WORDS)))
    clauses = F.transform(sentences, lambda s: F.transform(F.split(s, CLAUSE_ENDS), lambda c: F.struct(c.alias("marked"), plain(c).alias("plain"))))
    # each clause with the next one of its sentence, null after the last
    each = F.flatten(F.transform(clauses, lambda s: F.transform(s, lambda c, k: F.struct(c["marked"].alias("marked"), c["plain"].alias("plain"), F.get(s, k + 1)["plain"].alias("next")))))
    each = F.transform(each, lambda c: F.struct(c["marked"].alias("marked"), c["plain"].alias("plain"), c["next"].alias("next"), F.concat(c["plain"], F.lit(" "), c["next"]).alias("both")))

    def has(c, i, pattern):
        if i in SPDX:
            return F.rlike(c["marked"], F.lit(_spdx(SPDX[i])))
        # null where no clause follows, which is no hit
        return F.rlike(c["plain"], F.lit(pattern)) | (F.rlike(c["both"], F.lit(pattern)) & ~F.rlike(c["next"], F.lit(pattern)))

    patterns = [*SENTENCES, *((i, None) for i in SPDX if i not in dict(SENTENCES))]
    known = lambda c: F.concat(*[F.when(has(c, i, p), f"<{i}>").otherwise("") for i, p in patterns])
    return F.when(F.rlike(text, F.lit(WORDS)), F.array_join(F.transform(each, known), "")).otherwise("")


def scan(docs):
    """doc_id, sentence_ids, licences (comma-joined, in the order of the rules), n_licences and unmatched per row of ``docs``.

    The identifiers of a rule have to come in its order; others may stand between them and stay open to the rules after it.
    A rule that matches several times is counted each time in n_licences and named once per rule; unmatched
    has the identifiers that no rule used. Null and empty texts have none of all that. Every row
    stands for itself, repeated ones alike and null doc_id as any; an empty table gives no rows; other
    columns are not read.
    """
    out = docs.select("doc_id", identifiers(F.coalesce(docs["text"], F.lit(""))).alias("sentence_ids"))
    left, found, count = F.col("sentence_ids"), [], F.lit(0)
    steps = {}
    for k, (licence, ids) in enumerate(RULES + SPDX_RULES):
        # one column per rule, so that no expression is repeated in the next
        steps[k] = (licence, len(_sequence(ids)) - 1)
        pattern, gaps = _rule(ids)
        out = out.withColumn(f"r{k}", F.regexp_replace(left, F.lit(pattern), F.lit("|" + "".join(f"${g}" for g in gaps))))
        times = (F.length(left) - F.length(f"r{k}")) / (len(_sequence(ids)) - 1)
        found.append(F.when(times > 0, licence))
        count = count + times.cast("long")
        left = F.col(f"r{k}")
    names = F.array_join(F.array_distinct(F.array(*found)), ",")
    return out.select("doc_id", "sentence_ids", names.alias("licences"), count.cast("long").alias("n_licences"), F.replace(left, F.lit("|"), F.lit("")).alias("unmatched"))


def oracle(table="documents"):
    """The same in DuckDB SQL, whose patterns have no lookaround: the point of "v. 2" is marked before texts are cut."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    ends = "[.!?;]*[.!?][.!?;]*[ \\x09-\\x0D]+|\\x0A[ \\x09]*\\x0A+"
    tag_end = "($|[^a-z0-9+.-]|[-.]($|[^a-z0-9]))"
    hits = []
    for i, p in (*SENTENCES, *((i, None) for i in SPDX if i not in dict(SENTENCES))):
        if i in SPDX:
            tag = _spdx_start(SPDX[i]) + tag_end
            hit = f"regexp_matches(c.marked, {quoted(tag)})"
        else:
            hit = f"regexp_matches(c.plain, {quoted(p)}) OR coalesce(regexp_matches(c.plain || ' ' || c.next, {quoted(p)}) AND NOT regexp_matches(c.next, {quoted(p)}), false)"
        hits.append(f"CASE WHEN {hit} THEN '<{i}>' ELSE '' END")
    steps = [
        f"low AS (SELECT doc_id, row_number() OVER () AS k, translate(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '{UPPER}', '{LOWER}') AS t FROM {table})",
        "marks AS (SELECT doc_id, k, regexp_replace(t, '([^a-z0-9]v)\\.([ \\x09-\\x0D]+[0-9])', '\\1' || chr(57344) || '\\2', 'g') AS t FROM low)",
        f"sentences AS (SELECT k, unnest(list_filter(string_split_regex(t, {quoted(ends)}), lambda s: regexp_matches(s, {quoted(WORDS)}))) AS s, generate_subscripts(list_filter(string_split_regex(t, {quoted(ends)}), lambda s: regexp_matches(s, {quoted(WORDS)})), 1) AS place FROM marks)",
        "cut AS (SELECT k, place, string_split_regex(s, ';+[ \\x09-\\x0D]+|' || chr(57344) || '[ \\x09-\\x0D]+') AS marked FROM sentences)",
        "plain AS (SELECT k, place, marked, list_transform(marked, lambda c: trim(regexp_replace(c, '[^a-z0-9]+', ' ', 'g'))) AS plain FROM cut)",
        "clauses AS (SELECT k, place, unnest(marked) AS marked, unnest(plain) AS plain, unnest(list_append(plain[2:], NULL)) AS next, generate_subscripts(marked, 1) AS nth FROM plain)",
        f"known AS (SELECT k, string_agg({' || '.join(hits)}, '' ORDER BY place, nth) AS ids FROM clauses c GROUP BY k)",
        "s0 AS (SELECT doc_id, coalesce(ids, '') AS sentence_ids, coalesce(ids, '') AS rest, [] :: VARCHAR[] AS names, 0 :: BIGINT AS n FROM low LEFT JOIN known USING (k))",
    ]
    rules = RULES + SPDX_RULES
    for k, (licence, seq) in enumerate(rules):
        pattern, gaps = _rule(seq)
        used = f"regexp_replace(rest, '{pattern}', '|{''.join(f'{chr(92)}{g}' for g in gaps)}', 'g')"
        times = f"(length(rest) - length({used})) // {len(_sequence(seq)) - 1}"
        steps.append(f"s{k + 1} AS (SELECT doc_id, sentence_ids, {used} AS rest, CASE WHEN {times} > 0 AND NOT list_contains(names, '{licence}') THEN list_append(names, '{licence}') ELSE names END AS names, n + {times} AS n FROM s{k})")
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, sentence_ids, array_to_string(names, ',') AS licences, n AS n_licences, replace(rest, '|', '') AS unmatched FROM s{len(rules)}"
