"""License scans with ordered signature rules: DataFrame functions only, each text in its own row from start to end."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import table

# What a separator of words is, and the base phrases with their labels.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z became a-z
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Names of licenses: label, the word that a text must hold, the name as a pattern over words, versions.
NAMES = (
    ("gpl", "gnu", "gnu (?:general public license|gpl)", ("1", "2", "3")),
    ("gpl", "gpl", "gpl", ("1", "2", "3")),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public license", ("2", "2 1", "3")),
    ("lgpl", "lgpl", "lgpl", ("2", "2 1", "3")),
    ("agpl", "affero", "(?:gnu )?affero general public license", ("1", "3")),
    ("agpl", "agpl", "agpl", ("1", "3")),
    ("gfdl", "gnu", "gnu free documentation license", ("1 1", "1 2", "1 3")),
    ("apache", "apache", "apache (?:software )?licen[sc]e", ("1 0", "1 1", "2 0", "2")),
    ("mit", "mit", "mit licen[sc]e", ()),
    ("mit", "expat", "expat licen[sc]e", ()),
    ("x11", "x11", "x11 licen[sc]e", ()),
    ("bsd", "bsd", "(?:(?:new|revised|simplified|modified) )?bsd(?: [234] clause)? licen[sc]e", ()),
    ("bsd-2-clause", "bsd", "bsd 2 clause", ()),
    ("bsd-3-clause", "bsd", "bsd 3 clause", ()),
    ("isc", "isc", "isc licen[sc]e", ()),
    ("mpl", "mozilla", "mozilla public licen[sc]e", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public licen[sc]e", ("1 0", "2 0")),
    ("eupl", "european", "european union public licen[sc]e", ("1 1", "1 2")),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")),
    ("cddl", "distribution", "common development and distribution licen[sc]e", ("1 0", "1 1")),
    ("cpl", "common", "common public licen[sc]e", ("1 0",)),
    ("zlib", "zlib", "zlib licen[sc]e", ()),
    ("libpng", "libpng", "libpng licen[sc]e", ("2",)),
    ("boost", "boost", "boost software licen[sc]e", ("1 0",)),
    ("artistic", "artistic", "(?:perl )?artistic licen[sc]e", ("1 0", "2 0")),
    ("unlicense", "unlicense", "(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("1", "2")),
    ("ofl", "font", "sil open font licen[sc]e", ("1 0", "1 1")),
    ("odbl", "database", "open database licen[sc]e", ("1 0",)),
    ("osl", "open", "open software licen[sc]e", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic", "academic free licen[sc]e", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("ecl", "educational", "educational community licen[sc]e", ("1 0", "2 0")),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e", ()),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", ()),
    ("python", "python", "python(?: software foundation)? licen[sc]e", ("2",)),
    ("postgresql", "postgresql", "postgresql licen[sc]e", ()),
    ("openssl", "openssl", "openssl licen[sc]e", ()),
    ("php", "php", "php licen[sc]e", ("3 0", "3 01")),
    ("ruby", "ruby", "ruby licen[sc]e", ()),
    ("vim", "vim", "vim licen[sc]e", ()),
    ("w3c", "w3c", "w3c (?:software )?licen[sc]e", ()),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", ()),
    ("cecill", "cecill", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("sleepycat", "sleepycat", "sleepycat licen[sc]e", ()),
    ("cc-by", "cc", "cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc", "cc by sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc", "cc by nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc", "cc by nc", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc", "cc by nc sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc", "cc by nc nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", "cc0", ("1 0",)),
    ("cc-by", "creative", "creative commons attribution", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial", ("2 0", "2 5", "3 0", "4 0")),
    ("cc0", "creative", "creative commons zero", ("1 0",)),
    ("public-domain", "domain", "(?:in|into|to) the public domain", ()),
    ("proprietary", "reserved", "all rights reserved", ()),
    ("proprietary", "proprietary", "proprietary and confidential", ()),
)
# Ways of naming a license: what surrounds the name, and the rule's rank. A higher rank hides what it contains.
NOTICES = (
    ("{}", 2),
    ("(?:released|licensed|distributed|published|available|covered|provided) (?:by|under) (?:the )?(?:terms of (?:the )?)?{}", 4),
    ("subject to (?:the )?(?:terms of )?(?:the )?{}", 4),
    ("spdx license identifier {}(?: only| or later)?", 5),
)
VERSIONED = (("{} (?:version |v )?{}", 3), ("{} v{}", 3))
RANKS = 6
# Sentences of license bodies and headers, which tell a license without its name: label, the word that a text must hold,
# the words. A header names what applies (rank 5); a sentence of the body is nearly as good (rank 4).
BODY, HEADER = 4, 5
SIGNATURES = (
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software", BODY),
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", BODY),
    ("x11", "advertising", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", BODY),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", BODY),
    ("isc", "hereby", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", BODY),
    ("hpnd", "hereby", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", BODY),
    ("postgresql", "hereby", "for any purpose without fee and without a written agreement is hereby granted", BODY),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice", BODY),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice", BODY),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission", BODY),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following (?:acknowledgement|acknowledgment)", BODY),
    ("openssl", "openssl", "this product includes software developed by the openssl project", BODY),
    ("php", "php", "this product includes php software freely available from", BODY),
    ("apache-1.1", "apache", "this product includes software developed by the apache software foundation", BODY),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", HEADER),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license", BODY),
    ("apache-2.0", "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", BODY),
    ("apache-2.0", "basis", "distributed on an as is basis without warranties or conditions of any kind either express or implied", BODY),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", HEADER),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license", HEADER),
    ("gpl", "freedom", "the licenses for most software are designed to take away your freedom to share and change it", BODY),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works", BODY),
    ("gpl-2", "gnu", "gnu general public license as published by the free software foundation version 2", HEADER),
    ("gpl-2-or-later", "later", "either version 2 of the license or (?:at your option )?any later version", HEADER),
    ("gpl-3-or-later", "later", "either version 3 of the license or (?:at your option )?any later version", HEADER),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", HEADER),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license", HEADER),
    ("lgpl-2.1-or-later", "later", "either version 2 1 of the license or (?:at your option )?any later version", HEADER),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license", HEADER),
    ("agpl", "remotely", "all users interacting with it remotely through a computer network", BODY),
    ("gfdl", "invariant", "with no invariant sections no front cover texts and no back cover texts", HEADER),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1", HEADER),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", HEADER),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license", HEADER),
    ("epl", "recipient", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement", BODY),
    ("cddl", "distribution", "the contents of this file are subject to the terms of the common development and distribution license", HEADER),
    ("eupl", "european", "this european union public licence the eupl applies to the work", HEADER),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", BODY),
    ("zlib", "altered", "altered source versions must be plainly marked as such", BODY),
    ("boost-1.0", "boost", "distributed under the boost software license version 1 0", HEADER),
    ("boost-1.0", "accompanying", "obtaining a copy of the software and accompanying documentation covered by this license", BODY),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", BODY),
    ("wtfpl", "fuck", "you just do what the fuck you want to", BODY),
    ("json", "evil", "the software shall be used for good not evil", BODY),
    ("python", "psf", "psf hereby grants licensee a nonexclusive royalty free world wide license", BODY),
    ("ncsa", "illinois", "neither the names of the university of illinois nor the names of its contributors", BODY),
    ("artistic", "artistic", "you may distribute this under the terms of either the gnu general public license or the artistic license", HEADER),
    ("artistic", "package", "the intent of this document is to state the conditions under which a package may be copied", BODY),
    ("ofl", "reserved", "no modified version of the font software may use the reserved font name", BODY),
    ("ofl", "font", "the font software may be sold as part of a larger software package", BODY),
    ("cc-by", "creative", "this work is licensed under (?:a|the) creative commons attribution", HEADER),
    ("cc-by", "remix", "to share copy distribute and transmit the work to remix to adapt the work", BODY),
    ("cc-by", "credit", "you must give appropriate credit provide a link to the license and indicate if changes were made", BODY),
    ("cc-by-sa", "remix", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original", BODY),
    ("cc-by-nd", "remix", "if you remix transform or build upon the material you may not distribute the modified material", BODY),
    ("cc-by-nc", "commercial", "you may not use the material for commercial purposes", BODY),
    ("cc0", "dedicated", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", BODY),
    ("cc0", "waives", "overtly fully permanently irrevocably and unconditionally waives abandons and surrenders", BODY),
    ("ms-pl", "patent", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software", BODY),
    ("cecill", "cecill", "this software is governed by the cecill license under french law", HEADER),
    ("proprietary", "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited", HEADER),
)


@dataclass(frozen=True)
class Rule:
    keyword: str
    pattern: str
    rank: int
    label: str
    base: bool = False


def spaced(pattern: str) -> str:
    """Two blanks between words, as in the normalised text, so that every word has blanks of its own around it. An
    optional blank may be missing."""
    return pattern.replace(" ?", "\x00").replace(" ", "  ").replace("\x00", "(?:  )?")


def signature_rules() -> list[Rule]:
    """The base phrases first, with rank 1; every name in every notice and version; the sentences of bodies and headers."""
    rules = [Rule(phrase.split()[0], spaced(phrase), 1, label, True) for phrase, label in BASE]
    for label, keyword, name, versions in NAMES:
        rules += [Rule(keyword, spaced(notice.replace("{}", name)), rank, label) for notice, rank in NOTICES]
        for version in versions:
            own = f"{label}-{version.replace(' ', '.')}"
            rules += [Rule(keyword, spaced(v.replace("{}", name, 1).replace("{}", version)), r, own) for v, r in VERSIONED]
    rules += [Rule(keyword, spaced(words), rank, label) for label, keyword, words, rank in SIGNATURES]
    return rules


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rules_literal(rules: list[Rule]) -> str:
    """The rules as a SQL array, one entry for each keyword with all its rules."""
    by_keyword: dict[str, list[str]] = {}
    for r in rules:
        by_keyword.setdefault(r.keyword, []).append(
            f"named_struct('rx', {_literal(f' ({r.pattern}) ')}, 'rank', {r.rank}, 'label', {_literal(r.label)}, "
            f"'base', {str(r.base).lower()})"
        )
    parts = [f"named_struct('k', {_literal(f' {k} ')}, 'rules', array({', '.join(v)}))" for k, v in by_keyword.items()]
    return f"array({', '.join(parts)})"


def gate_words(rules: list[Rule]) -> list[str]:
    """Words of which a text needs one: `license` or `licence` for rules that always hold one of them as a whole word,
    else the keyword. (A keyword like `mit` alone is an everyday word elsewhere.)"""
    gates: set[str] = set()
    for r in rules:
        always = r.pattern
        while (outside := re.sub(r"\(\?:[^()]*\)\??", "", always)) != always:  # what stands in no group
            always = outside
        whole = {"license", "licence", "licen[sc]e"} & set(always.split())
        gates |= {"license", "licence"} if whole else {r.keyword}
    return sorted(gates)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, detections) of every row; a detection has start, end (words, the end is not part of it), rank,
    label, base, and kept: false where a rule of a higher rank covers it.

    A text is brought to lower case (A-Z only) and to words. Rules whose keyword it holds mark their matches in it; the
    marked words give the places, however many. One sweep over the places in the order of their starts then drops
    those that a higher rank contains. Everything happens inside the row: no shuffle, no join, no Python.

    Null and empty texts have no words and no detections; ties in start and end go to the higher rank, equal ranks do not
    hide each other; repeated rows and null ids are kept; an empty table gives no rows; other columns are not read."""
    rules = rules or signature_rules()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    source = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    words = source.select("doc_id", F.split(F.translate("text", upper, lower), SEPARATOR).alias("w"))
    gates = F.array(*[F.lit(k) for k in gate_words(rules)])
    outer = "int(w[0] = '') + int(size(w) > 1 and w[size(w) - 1] = '')"  # nothing stands before or behind a separator
    rows = words.select(
        "doc_id",
        F.expr(f"cast(size(w) - ({outer}) as long)").alias("n_words"),
        F.when(
            F.arrays_overlap("w", gates), F.concat(F.lit(" "), F.trim(F.array_join("w", "  ")), F.lit(" "))
        ).alias("n"),
    )
    places = f"""
        flatten(transform(flatten(transform(filter({rules_literal(rules)}, g -> contains(n, g.k)), g -> g.rules)), r ->
            transform(array(split(trim(regexp_replace(n, r.rx, ' \\u0001$1\\u0002 ')), '  ')), w ->
                zip_with(
                    filter(transform(w, (x, i) -> if(startswith(x, '\\u0001'), i, null)), i -> i is not null),
                    filter(transform(w, (x, i) -> if(endswith(x, '\\u0002'), i + 1, null)), i -> i is not null),
                    (s, e) -> named_struct('start', s, 'rank', -r.rank, 'end', e, 'label', r.label, 'base', r.base)
                ))[0]))"""
    found = rows.withColumn("places", F.when(F.col("n").isNotNull(), F.array_sort(F.expr(places)))).drop("n")
    swept = f"""
        aggregate(places,
            named_struct('reach', array_repeat(0, {RANKS}), 'kept', cast(array() as array<boolean>)),
            (a, p) -> named_struct(
                'reach', transform(a.reach, (x, i) -> if(i = -p.rank, greatest(x, p.end), x)),
                'kept', array_append(a.kept, not exists(slice(a.reach, 2 - p.rank, {RANKS}), x -> x >= p.end))
            )).kept"""
    detections = """
        zip_with(places, swept, (p, k) -> named_struct('start', p.start, 'end', p.end, 'rank', -p.rank, 'label', p.label,
            'base', p.base, 'kept', k))"""
    found = found.withColumn("swept", F.expr(swept))
    return found.select("doc_id", "n_words", F.coalesce(F.expr(detections), F.expr("filter(array(named_struct('start', 0, 'end', 0, 'rank', 0, 'label', '', 'base', false, 'kept', false)), x -> false)")).alias("detections"))


def license_summary(scanned: DataFrame) -> DataFrame:
    """Counts, places and labels of the detections of each row."""
    base = "filter(detections, d -> d.base)"
    joined = "array_join(array_sort(array_distinct(transform({}, d -> d.label))), ',')"
    return scanned.selectExpr(
        "doc_id",
        "n_words",
        f"cast(size({base}) as long) as n_base",
        f"cast(array_min(transform({base}, d -> d.start)) as long) as first_word",
        f"cast(array_max(transform({base}, d -> d.start)) as long) as last_word",
        f"{joined.format(base)} as base_labels",
        f"{joined.format('filter(detections, d -> d.base or d.kept)')} as labels",
        f"coalesce(array_max(transform(filter(detections, d -> d.kept), d -> d.rank)), 0) / {RANKS - 1}D as score",
    )


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_summary(scan_licenses(table(spark, folder, "documents")))


def op9_sql() -> str:
    """The same in DuckDB: places as rows, hidden ones by a join."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(
        f"({quote(f' {r.keyword} ')}, {quote(f' ({r.pattern}) ')}, {r.rank}, {quote(r.label)}, {str(r.base).lower()})"
        for r in signature_rules()
    )
    return rf"""
with rules(k, rx, rule_rank, label, base) as (values {values}),
texts as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
plain as (select rid, doc_id, len(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')) as n_words,
  ' ' || trim(regexp_replace(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATOR}', '  ', 'g'), ' ') || ' ' as n
  from texts),
marked as (select rid, rule_rank, label, base,
  string_split(trim(regexp_replace(n, rx, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g'), ' '), '  ') as w
  from plain join rules on contains(n, k)),
words as (select rid, rule_rank, label, base, unnest(w) as x, unnest(range(len(w))) as i from marked),
starts as (select rid, rule_rank, label, base, i, row_number() over (partition by rid, rule_rank, label, base order by i) as q from words where starts_with(x, chr(1))),
ends as (select rid, rule_rank, label, base, i, row_number() over (partition by rid, rule_rank, label, base order by i) as q from words where ends_with(x, chr(2))),
places as (select s.rid, s.rule_rank, s.label, s.base, s.i as s, e.i + 1 as e from starts s join ends e using (rid, rule_rank, label, base, q)),
judged as (select p.*, exists (select 1 from places h where h.rid = p.rid and h.rule_rank > p.rule_rank and h.s <= p.s and h.e >= p.e) as hidden from places p),
sums as (select rid, count(*) filter (base) as n_base, min(s) filter (base) as first_word, max(s) filter (base) as last_word,
  string_agg(distinct label, ',' order by label) filter (base) as base_labels,
  string_agg(distinct label, ',' order by label) filter (base or not hidden) as labels,
  max(rule_rank) filter (not hidden) as best from judged group by rid)
select doc_id, n_words::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(best, 0) / {RANKS - 1}.0::double as score
from plain left join sums using (rid)"""
