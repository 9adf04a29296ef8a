"""License scans by ordered signature rules, in SQL functions only.

A text is reduced to its lower-case words. Its rule keywords decide which of some hundred regexes are
tried at all. Detections are intervals of words; one that lies within another of a better priority, or of the same and longer,
goes, and what only overlaps stays. All of that happens within a document's row, and only the labels of what is left come out.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import documents, let

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Of rules; 1 is the best.
PRIORITIES = 4
RULE = "array<struct<rule:int,priority:int,label:string,regex:string,weight:double>>"

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label, words that gate its names, names, versions (as they read once punctuation is gone).
FAMILIES = [
    ("gpl", ["gpl", "gnu"], ["gnu general public license", "gnu gpl", "gpl"], ["1", "2", "3", "1 0", "2 0", "3 0"]),
    ("lgpl", ["lgpl", "lesser", "library"], ["gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"], ["2", "2 1", "3", "2 0", "3 0"]),
    ("agpl", ["agpl", "affero"], ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl"], ["1", "3", "1 0", "3 0"]),
    ("gfdl", ["gfdl", "gnu"], ["gnu free documentation license", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache"], ["apache software license", "apache license", "apache licence", "apache"], ["1 0", "1 1", "2 0", "2"]),
    ("mit", ["mit", "expat"], ["mit license", "mit licence", "expat license"], []),
    ("bsd", ["bsd"], ["bsd license", "bsd licence", "bsd"], ["0 clause", "2 clause", "3 clause", "4 clause"]),
    ("mpl", ["mozilla", "mpl"], ["mozilla public license", "mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", ["eclipse", "epl"], ["eclipse public license", "epl"], ["1 0", "2 0"]),
    ("cddl", ["cddl"], ["common development and distribution license", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["cpl"], ["common public license", "cpl"], ["1 0"]),
    ("eupl", ["eupl"], ["european union public licence", "european union public license", "eupl"], ["1 0", "1 1", "1 2"]),
    ("artistic", ["artistic"], ["artistic license", "perl artistic license"], ["1 0", "2 0"]),
    ("boost", ["boost"], ["boost software license"], ["1 0"]),
    ("isc", ["isc"], ["isc license", "isc licence"], []),
    ("zlib", ["zlib"], ["zlib license", "zlib libpng license"], []),
    ("unlicense", ["unlicense"], ["unlicense"], []),
    ("wtfpl", ["wtfpl"], ["do what the fuck you want to public license", "wtfpl"], ["1", "2"]),
    ("python", ["psf"], ["python software foundation license", "psf license"], ["2", "2 0"]),
    ("ofl", ["ofl", "sil"], ["sil open font license", "ofl"], ["1 0", "1 1"]),
    ("afl", ["afl"], ["academic free license", "afl"], ["2 1", "3 0"]),
    ("osl", ["osl"], ["open software license", "osl"], ["1 0", "2 0", "2 1", "3 0"]),
    ("ms-pl", ["microsoft"], ["microsoft public license"], []),
    ("ms-rl", ["microsoft"], ["microsoft reciprocal license"], []),
    ("ncsa", ["ncsa"], ["university of illinois ncsa open source license", "ncsa license"], []),
    ("postgresql", ["postgresql"], ["postgresql license"], []),
    ("openssl", ["openssl"], ["openssl license"], []),
    ("odbl", ["odbl"], ["open database license", "odbl"], ["1 0"]),
    ("upl", ["upl"], ["universal permissive license", "upl"], ["1 0"]),
    ("blueoak", ["oak"], ["blue oak model license"], ["1 0 0"]),
    ("vim", ["vim"], ["vim license"], []),
    ("cc0", ["cc0", "creative"], ["creative commons zero", "cc0"], ["1 0"]),
    *((f"cc-{kind.replace(' ', '-')}", ["cc", "creative"], [f"cc {kind}", f"creative commons {name}"], ["1 0", "2 0", "2 5", "3 0", "4 0"])
      for kind, name in [("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?derivatives"), ("by nc", "attribution non ?commercial"),
                         ("by nc sa", "attribution non ?commercial share ?alike"), ("by nc nd", "attribution non ?commercial no ?derivatives")]),
]
_GRANT = r"(?:licen[sc]ed|released|distributed|available|provided|published|redistribute it) under (?:the )?(?:terms of (?:the )?)?"


_LATER = "(?: or (?:any )?later(?: version)?)?"

#: Short names that are written in one word with their version (GPLv2, LGPL3).
_JOINED = {"gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl", "cpl", "eupl", "ofl", "afl", "osl", "odbl", "upl", "wtfpl", "apache"}
#: label, name: too common a word alone, a license after a grant.
_GRANTED = [("mit", "mit"), ("mit", "expat"), ("isc", "isc"), ("zlib", "zlib")]
#: label, name: SPDX identifiers that are no name above; with a version if the family has any.
_IDS = [("boost", "bsl"), ("python", "psf"), ("artistic", "artistic"), ("blueoak", "blueoak"), ("ms-pl", "ms pl"), ("ms-rl", "ms rl")]
_SPDX = "spdx license identifier "
_SPDX_TAG = "(?i)spdx-license-identifier:"

_FSF = "redistribute it and or modify it under the terms of (?:version {v} of )?the gnu {kind}public license as published by the free software foundation"
#: label, keyword, regex of license bodies and headers.
BODIES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("boost", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("isc", "hereby", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms(?: with or without modification)?"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0", "waived", "to the extent possible under law (?:[^ ]+ ){1,20}waived all copyright and related or neighbou?ring rights"),
    *((f"{label}-{v.replace(' ', '.')}", "gnu", _FSF.format(v=v, kind=kind) + f" either version {v} of the license(?: or at your option any later version)?")
      for label, kind, versions in [("gpl", "general ", ["1", "2", "3"]), ("lgpl", "(?:lesser|library) general ", ["2", "2 1", "3"]), ("agpl", "affero general ", ["1", "3"])] for v in versions),
]
#: label, keyword, regex of notices as people write them.
NOTICES = [
    ("mit", "warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to"),
    ("mit", "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "disclaims", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2-clause", "freebsd", "the views and conclusions contained in the software and documentation are those of the authors .{0,80}freebsd project"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "perpetual", "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", "designated", "this license the lesser general public license applies to some specially designated software"),
    ("agpl-3", "affero", "the gnu affero general public license is a free copyleft license for software"),
    ("gfdl", "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("epl-2.0", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license v ?2 0"),
    ("epl-1.0", "eclipse", "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v ?1 0"),
    ("cddl", "development", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("boost-1.0", "boost", "distributed under the boost software license version 1 0"),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", "anyone", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("cc0", "dedicated", "(?:has|have) dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license version 1 1"),
    ("artistic-2.0", "artistic", "under the terms of the artistic license version 2 0"),
    ("python", "psf", "psf is making python available to licensee on an as is basis"),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php", "php", "this product includes php software freely available from"),
    ("postgresql", "agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("cc-by", "adapt", "you are free to share copy and redistribute .{0,60}adapt remix transform"),
    ("public-domain", "domain", "(?:placed|released) (?:in|into) the public domain"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited"),
]
#: label, keyword, regex of addresses of license texts, as they read once punctuation is gone.
ADDRESSES = [
    ("apache-2.0", "apache", "apache org licenses license 2 0"), ("mpl-2.0", "mozilla", "mozilla org (?:en us )?mpl 2 0"), ("mpl-1.1", "mozilla", "mozilla org mpl mpl 1 1"),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0"), ("gpl-2", "gnu", "gnu org licenses (?:old licenses )?gpl 2 0"), ("gpl", "gnu", "gnu org (?:licenses|copyleft) gpl"),
    ("lgpl-3", "gnu", "gnu org licenses lgpl 3 0"), ("lgpl-2.1", "gnu", "gnu org licenses (?:old licenses )?lgpl 2 1"), ("lgpl", "gnu", "gnu org (?:licenses|copyleft) (?:lgpl|lesser)"),
    ("agpl-3", "gnu", "gnu org licenses agpl(?: 3 0)?"), ("gfdl", "gnu", "gnu org (?:licenses|copyleft) fdl(?: 1 [1-3])?"),
    ("mit", "opensource", "opensource org licen[sc]es? mit(?: license)?"), ("isc", "opensource", "opensource org licen[sc]es? isc(?: license)?"),
    ("bsd-2-clause", "opensource", "opensource org licen[sc]es? bsd 2 clause"), ("bsd-3-clause", "opensource", "opensource org licen[sc]es? bsd 3 clause"), ("bsd", "opensource", "opensource org licen[sc]es? bsd license"),
    ("apache-2.0", "opensource", "opensource org licen[sc]es? apache 2 0"), ("zlib", "opensource", "opensource org licen[sc]es? zlib"), ("artistic-2.0", "opensource", "opensource org licen[sc]es? artistic 2 0"),
    ("boost-1.0", "boost", "boost org license 1 0"), ("unlicense", "unlicense", "unlicense org"), ("wtfpl", "wtfpl", "wtfpl net"), ("epl-1.0", "eclipse", "eclipse org legal epl v10"), ("epl-2.0", "eclipse", "eclipse org legal epl 2 0"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"),
    *((f"cc-{kind.replace(' ', '-')}-{v.replace(' ', '.')}", "creativecommons", f"creativecommons org licenses {kind} {v}")
      for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd") for v in ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("ofl", "sil", "scripts sil org ofl"), ("upl", "oracle", "oss oracle com licenses upl"), ("odbl", "opendatacommons", "opendatacommons org licenses odbl"),
]


def _keyword(name: str, keywords: list[str]) -> str:
    """A word that stands in every text with ``name``: one of ``keywords``, or else its word for license."""
    parts = name.split(" ")
    return next((k for k in keywords if k in parts), None) or next(p for p in parts if p in ("license", "licence"))


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keyword, regex, weight): a grant with a version or an SPDX tag, a name with a
    version or a body, a grant, a name. A name of up to four letters alone is no license, as it has
    other meanings, but beside the word license it is."""
    out = []

    def versioned(full: str, keyword: str, name: str, tail: str) -> None:
        out.extend([(1, full, keyword, f"{_GRANT}{name}{tail}", 1.0), (2, full, keyword, f"{name}{tail}", 0.9)])

    for label, keywords, names, versions in FAMILIES:
        ids = [name for other, name in _IDS if other == label]
        full = {v: f"{label}-{v.replace(' clause', '-clause').replace(' ', '.')}" for v in versions}
        for name in names:
            gate, last = _keyword(name, keywords), name.split(" ")[-1]
            for version in versions:
                versioned(full[version], gate, name, f" (?:license )?(?:version |v ?)?{version}{_LATER}" if label != "bsd" else f" {version}")
                if last in _JOINED:
                    major = version.split(" ")[0]
                    end = f"{major}(?: 0)?" if version == f"{major} 0" and major not in versions else version
                    for v in ["v", ""][: 1 if label == "apache" else 2]:
                        versioned(full[version], f"{last}{v}{major}", name, f"{v}{end}{_LATER}")
            out.append((3, label, gate, f"{_GRANT}{name}", 0.8))
            if len(name) > 4:
                out.append((4, label, gate, name, 0.6))
            else:
                out.extend((4, label, gate, regex, 0.6) for regex in (f"{name} licen[sc]ed?", f"licen[sc]e {name}"))
        for name in ids:
            for version in versions:
                versioned(full[version], name.split(" ")[0], name, f" {version}")
            if not versions:
                out.extend([(3, label, "ms", f"{_GRANT}{name}", 0.8), (4, label, "ms", name, 0.6)])
        for name in [*ids, label.replace("-", " ")]:
            for version in [*versions, ""]:
                regex, own = f"{name} {version}{_LATER}" if version else name, full.get(version, label)
                out.append((1, own, "spdx", f"{_SPDX}{regex}", 1.0))
    out += [(1, "bsd-0-clause", "spdx", f"{_SPDX}0bsd", 1.0), (2, "bsd-0-clause", "0bsd", "0bsd", 0.9)]
    out += [(3, label, name, f"{_GRANT}{name}", 0.8) for label, name in _GRANTED]
    out += [(1, label, keyword, regex, 1.0) for label, keyword, regex in ADDRESSES]
    return out + [(2, label, keyword, regex, 0.9) for label, keyword, regex in [*BODIES, *NOTICES]]


def _base_places(w: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        same = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(w, i + k) == part, F.lit(False))
        return same

    return F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, " ", ""))


def detections(joined: Column, keywords: Column) -> Column:
    """array of (start, end, priority, rule, label, weight), in the order of the text: the detections of the
    rules that the keywords open; start and end in words. ``joined`` are the words with a space around each."""
    by_keyword: dict[str, list] = {}
    for i, (priority, label, keyword, regex, weight) in enumerate(rules()):
        by_keyword.setdefault(keyword, []).append({"rule": i, "priority": priority, "label": label, "regex": regex, "weight": weight})
    # A constant, which Spark folds to one literal.
    table = F.from_json(F.lit(json.dumps(by_keyword)), f"map<string,{RULE}>")
    tried = F.flatten(F.transform(keywords, lambda k: F.coalesce(F.try_element_at(table, k), F.array().cast(RULE))))
    hit = F.filter(tried, lambda r: F.rlike(joined, F.concat(F.lit(" "), r["regex"], F.lit(" "))))

    def places(r: Column) -> Column:
        """Words before each match, by the pieces between matches, and the matches' own."""
        pattern = F.concat(F.lit("(?<= )"), r["regex"], F.lit("(?= )"))
        found = F.zip_with(F.split(joined, pattern, -1), F.regexp_extract_all(joined, pattern, F.lit(0)), lambda piece, value: F.struct(_spaces(piece).alias("gap"), _spaces(value).alias("own"), value.isNotNull().alias("there")))
        start = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("out"), F.lit(0).alias("at"))

        def step(a: Column, x: Column) -> Column:
            first = a["at"] + x["gap"] - 1
            return F.when(x["there"], F.struct(F.concat(a["out"], F.array(F.struct(first.alias("start"), (first + x["own"] + 1).alias("end")))).alias("out"), (a["at"] + x["gap"] + x["own"]).alias("at"))).otherwise(a)

        return F.transform(F.aggregate(found, start, step, lambda a: a["out"]), lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label"), r["weight"].alias("weight")))

    return F.array_sort(F.flatten(F.transform(hit, places)))


def resolved(found: Column) -> Column:
    """Detections without those that lie within a better one: of a better priority, else longer, else of an earlier rule. What only overlaps stays.

    Taken by start, and the longer first, a detection lies within one before it if that one ends no earlier. One of the
    same or a better priority is then better, so one number a priority tells: the furthest end so far.
    """
    kind = "array<struct<start:int,end:int,priority:int,rule:int,label:string,weight:double>>"
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["priority"].alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"), d["weight"].alias("weight"))))
    start = F.struct(F.array().cast(kind).alias("kept"), F.array_repeat(F.lit(-1), PRIORITIES).alias("ends"))

    def step(a: Column, x: Column) -> Column:
        end = -x["back"]
        free = F.get(a["ends"], x["priority"] - 1) < end
        kept = F.struct(x["start"].alias("start"), end.alias("end"), x["priority"].alias("priority"), x["rule"].alias("rule"), x["label"].alias("label"), x["weight"].alias("weight"))
        ends = F.transform(a["ends"], lambda e, i: F.when(i >= x["priority"] - 1, F.greatest(e, end)).otherwise(e))
        return F.when(free, F.struct(F.concat(a["kept"], F.array(kept)).alias("kept"), ends.alias("ends"))).otherwise(a)

    return F.aggregate(order, start, step, lambda a: a["kept"])


def _further_identifiers(text: Column) -> Column:
    """The identifiers behind the first of each SPDX expression, as words behind a tag of their own. An expression goes on in its line as long as every
    second token is an operator."""
    def ids(piece: Column) -> Column:
        tokens = F.filter(F.split(F.substring_index(piece, "\n", 1), r"[\x20\t\r()]+"), lambda t: t != "")

        def told(t: Column) -> Column:
            ends = F.filter(F.transform(t, lambda x, i: F.when((i % 2 == 1) & ~F.lower(x).isin("or", "and", "with"), i)), lambda i: i.isNotNull())
            return F.filter(F.slice(t, 1, F.coalesce(F.array_min(ends), F.size(t))), lambda x, i: (i % 2 == 0) & (i > 0))

        return let(tokens, told)

    words = lambda i: F.trim(F.regexp_replace(F.translate(i, UPPER, LOWER), SEPARATOR, " "))
    pieces = F.split(text, _SPDX_TAG)
    found = F.flatten(F.transform(F.slice(pieces, 2, F.size(pieces)), ids))
    return F.when(F.rlike(text, F.lit(_SPDX_TAG)), F.array_join(F.transform(found, lambda i: F.concat(F.lit(_SPDX), words(i), F.lit(" "))), "")).otherwise(F.lit(""))


def scanned(docs: DataFrame) -> DataFrame:
    """Words, base places, labels and score of each document.

    A null text is empty: no words, no labels, score 0. Repeated rows are scanned each; an empty
    table gives an empty result; further columns are ignored.
    """
    words = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), SEPARATOR), "")
    known = F.array(*[F.lit(k) for k in sorted({r[2] for r in rules()} | {phrase.split(" ")[0] for phrase in BASE})])

    further = _further_identifiers(F.coalesce(F.col("text"), F.lit("")))

    def read(w: Column) -> Column:
        def told(found: Column) -> Column:
            base = F.when(F.size(found) > 0, F.array(*[_base_places(w, p) for p in BASE])).otherwise(F.array(*[F.array().cast("array<int>")] * len(BASE)))
            # Behind the text's own words, so they meet none of its detections.
            own = F.when(F.size(found) > 0, resolved(detections(F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "), further), found)))
            return F.struct(F.size(w).cast("long").alias("n_words"), base.alias("base"), own.alias("own"))

        return let(F.array_intersect(w, known), told)

    lowered = F.split(F.translate(F.array_join(words, " "), UPPER, LOWER), " ")
    rows = docs.select("doc_id", let(F.array_remove(lowered, ""), read).alias("r")).select("doc_id", "r.n_words", "r.base", F.coalesce("r.own", F.array()).alias("own"))
    labels = F.filter(F.array(*[F.when(F.size(F.get("base", i)) > 0, F.lit(label)) for i, label in enumerate(BASE.values())]), lambda x: x.isNotNull())
    rows = rows.withColumns({"places": F.flatten("base"), "base_found": F.array_sort(labels)})
    weight = F.greatest(F.coalesce(F.array_max(F.transform("own", lambda d: d["weight"])), F.lit(0.0)), F.when(F.size("places") > 0, F.lit(0.6)).otherwise(F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_found", F.transform("own", lambda d: d["label"]))), ",").alias("labels"),
        weight.alias("score"), F.size("own").cast("long").alias("n_detections"),
    )


def op6_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(documents(spark, sf_dir))


QUERIES = {"op6_signature_rules": op6_signature_rules}
ORACLES: dict[str, str] = {}
