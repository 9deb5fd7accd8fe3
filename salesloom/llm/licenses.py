"""Licence scans (operator 9): ordered signature rules, in DataFrame functions only.

A text becomes its words (ASCII letters lowered, runs of letters, digits and characters beyond ASCII), joined by one space.
Rules are regular expressions over that form; each has a label, a priority (its place in the order) and a keyword
that every match holds. The prefilter lets a rule look at a document only if the keyword is one of its words: the few
keywords a document holds are joined with the rule table, so most documents meet no expression at all.
All matches of a rule become intervals of words. An interval that lies inside one of a rule of the same or a better tier
is suppressed: a full notice beats the bare name inside it, a named version beats the family. Containment needs only
running maxima over the intervals in order, so no document's intervals are compared pairwise.

Rules are written by hand as families with their versions and spellings; the table grows from them to some hundreds.

Base places (fixed phrases) are counted beside the rules and never suppressed.

Defined cases: a null or empty text has no words and no place; equal intervals go to the better priority; repeated rows
(id and text equal) get equal results; extra columns are ignored; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, whole

# Phrases and labels of the base places.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# A version of n parts as words: "4.0" is "4 0". Tiers: 0 notices, 1 names with a version, 2 names, 3 hints.
_LICENCE = "licen[cs]e"
_UNDER = rf"(?:licen[cs]ed|released|distributed|available|published|provided|made available) under (?:the )?(?:terms of )?(?:the )?"


# SPDX identifiers whose short form is no licence name by itself, with their versions.
SPDX_IDENTIFIERS = (
    ("mit", ()), ("isc", ()), ("zlib", ()), ("x11", ()), ("ncsa", ()), ("openssl", ()), ("ms-pl", ()), ("ms-rl", ()),
    ("apache", ("1.0", "1.1", "2.0")), ("bsl", ("1.0",)), ("afl", ("1.1", "1.2", "2.0", "2.1", "3.0")), ("artistic", ("1.0", "2.0")),
    ("osl", ("1.0", "2.0", "2.1", "3.0")), ("psf", ("2.0",)), ("php", ("3.0", "3.01")), ("ofl", ("1.0", "1.1")), ("busl", ("1.1",)),
    ("elastic", ("2.0",)), ("sspl", ("1.0",)), ("gfdl", ("1.1", "1.2", "1.3")),
)


def _family_rules() -> list[tuple[int, str, str, str]]:
    rules: list[tuple[int, str, str, str]] = []

    def named(label: str, keyword: str, name: str, versions: tuple[str, ...] = (), unversioned: str | None = None) -> None:
        """A name with each version and without one, plain and inside a notice."""
        for version in versions:
            words = version.replace(".", " ")
            number = rf"(?:,? ?(?:version|v) ?|v)?{words}"
            full = f"{label}-{version}"
            rules.append((0, full, keyword, rf"{_UNDER}{name} (?:only )?{number}(?: or (?:any )?later)?"))
            rules.append((1, full, keyword, rf"{name} {number}(?: or (?:any )?later)?"))
        plain = unversioned or label
        rules.append((0, plain, keyword, rf"{_UNDER}{name}"))
        rules.append((2, plain, keyword, name))

    # Copyleft families.
    named("gpl", "general", rf"(?:gnu )?general public {_LICENCE}", ("1.0", "2.0", "3.0", "1", "2", "3"))
    named("gpl", "gpl", r"(?:gnu )?gpl", ("1.0", "2.0", "3.0", "2", "3"))
    named("lgpl", "lesser", rf"(?:gnu )?lesser general public {_LICENCE}", ("2.1", "3.0", "3"))
    named("lgpl", "library", rf"(?:gnu )?library general public {_LICENCE}", ("2.0", "2"))
    named("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2.1", "3.0", "2", "3"))
    named("agpl", "affero", rf"(?:gnu )?affero general public {_LICENCE}", ("1.0", "3.0", "3"))
    named("agpl", "agpl", r"(?:gnu )?agpl", ("1.0", "3.0", "3"))
    named("gfdl", "documentation", rf"(?:gnu )?free documentation {_LICENCE}", ("1.1", "1.2", "1.3"))
    named("mpl", "mozilla", rf"mozilla public {_LICENCE}", ("1.0", "1.1", "2.0"))
    named("mpl", "mpl", r"mpl", ("1.0", "1.1", "2.0"))
    named("epl", "eclipse", rf"eclipse public {_LICENCE}", ("1.0", "2.0"))
    named("epl", "epl", r"epl", ("1.0", "2.0"))
    named("eupl", "european", rf"european union public {_LICENCE}", ("1.0", "1.1", "1.2"))
    named("eupl", "eupl", r"eupl", ("1.0", "1.1", "1.2"))
    named("cddl", "common", rf"common development and distribution {_LICENCE}", ("1.0", "1.1"))
    named("cddl", "cddl", r"cddl", ("1.0", "1.1"))
    named("cpl", "common", rf"common public {_LICENCE}", ("1.0",))
    named("osl", "open", rf"open software {_LICENCE}", ("1.0", "2.0", "2.1", "3.0"))
    named("sspl", "side", rf"server side public {_LICENCE}", ("1", "1.0"))
    named("cecill", "cecill", r"cecill", ("1.0", "1.1", "2.0", "2.1"))
    # Permissive families.
    named("apache", "apache", rf"apache (?:software )?{_LICENCE}", ("1.0", "1.1", "2.0", "2"))
    named("mit", "mit", rf"(?:mit|expat) {_LICENCE}")
    named("mit", "expat", rf"expat {_LICENCE}")
    named("x11", "x11", rf"x11 {_LICENCE}")
    named("isc", "isc", rf"isc {_LICENCE}")
    named("zlib", "zlib", rf"zlib (?:libpng )?{_LICENCE}")
    named("bsl", "boost", rf"boost software {_LICENCE}", ("1.0",))
    named("afl", "academic", rf"academic free {_LICENCE}", ("1.1", "1.2", "2.0", "2.1", "3.0"))
    named("artistic", "artistic", rf"artistic {_LICENCE}", ("1.0", "2.0"))
    named("psf", "python", rf"python software foundation {_LICENCE}", ("2", "2.0"))
    named("php", "php", rf"php {_LICENCE}", ("3.0", "3.01"))
    named("ofl", "font", rf"(?:sil )?open font {_LICENCE}", ("1.0", "1.1"))
    named("unlicense", "unlicense", r"(?:the )?unlicense")
    named("wtfpl", "wtfpl", r"wtfpl", ("1.0", "2.0", "2"))
    named("ms-pl", "microsoft", rf"microsoft public {_LICENCE}")
    named("ms-rl", "microsoft", rf"microsoft reciprocal {_LICENCE}")
    named("busl", "business", rf"business source {_LICENCE}", ("1.0", "1.1"))
    named("elastic", "elastic", rf"elastic {_LICENCE}", ("2.0", "2"))
    named("unicode", "unicode", rf"unicode {_LICENCE}")
    named("openssl", "openssl", rf"openssl {_LICENCE}")
    named("ncsa", "illinois", rf"(?:university of )?illinois (?:ncsa )?open source {_LICENCE}")
    for clauses, spoken in (("0", "zero"), ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four")):
        named(f"bsd-{clauses}-clause", "bsd", rf"(?:bsd (?:{clauses}|{spoken}) clause|(?:{clauses}|{spoken}) clause bsd)(?: {_LICENCE})?")
    for spoken, label in (("simplified", "bsd-2-clause"), ("new", "bsd-3-clause"), ("modified", "bsd-3-clause"), ("original", "bsd-4-clause")):
        named(label, "bsd", rf"{spoken} bsd {_LICENCE}")
    named("bsd", "bsd", rf"bsd(?: style)? {_LICENCE}")
    # Creative Commons: every combination of terms, by letters and by words.
    spoken = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    for terms in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        letters, words = terms.replace("-", " "), " ".join(spoken[t] for t in terms.split("-"))
        versions = ("1.0", "2.0", "2.5", "3.0", "4.0")
        named(f"cc-{terms}", "cc", rf"cc {letters}", versions)
        named(f"cc-{terms}", "creative", rf"creative commons {words}", versions)
    named("cc0", "cc0", r"cc0", ("1.0",))
    named("cc0", "cc", r"cc 0", ("1.0",))
    named("cc0", "creative", r"creative commons zero", ("1.0",))
    named("odbl", "odbl", r"odbl", ("1.0",))
    named("odbl", "database", rf"open database {_LICENCE}", ("1.0",))
    # Identifiers behind the SPDX mark, and those that `or` or `and` joins to one; the mark is the keyword, so few texts meet them.
    for family, versions in SPDX_IDENTIFIERS:
        for label in [f"{family}-{version}" for version in versions] or [family]:
            words = label.replace("-", " ").replace(".", " ")
            rules.append((0, label, "spdx", rf"spdx licen[cs]e identifier {words}(?: only| or later)?"))
            rules.append((1, label, "spdx", rf"(?:or|and) {words}(?: only| or later)?"))
    # The version makes a licence of the bare name, unless a third number follows: that is a release of the server.
    rules.append((2, "apache-2.0", "apache", r"apache (?:version |v ?)?2 0(?! [0-9])"))
    # Sentences of the notices themselves.
    rules += [
        (0, "mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
        (0, "isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
        (0, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
        (0, "apache", "compliance", r"you may not use this file except in compliance with the licen[cs]e"),
        (0, "gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
        (0, "lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
        (0, "mpl", "subject", r"this source code form is subject to the terms of the mozilla public licen[cs]e"),
        (0, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
        (0, "zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
        (0, "wtfpl", "fuck", r"do what the fuck you want to public licen[cs]e"),
        # A hint only: as a name it would suppress the names of the identifiers inside it.
        (3, "spdx", "spdx", r"spdx licen[cs]e identifier(?: [a-z0-9]+){1,4}"),
        (1, "public-domain", "domain", r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain"),
        (2, "public-domain", "domain", r"public domain"),
        (1, "reserved", "reserved", r"all rights (?:are )?reserved"),
        (2, "reserved", "reserved", r"(?:some|no) rights reserved"),
        (2, "proprietary", "proprietary", r"proprietary (?:and )?(?:confidential|licen[cs]e|software|information)"),
        (2, "proprietary", "confidential", r"confidential and proprietary"),
        (2, "no-commercial", "commercial", r"(?:not for|no|non) commercial (?:use|purposes?|redistribution)"),
        (2, "evaluation", "evaluation", r"for evaluation purposes only"),
        (2, "copyright", "copyright", r"copyright(?: c)?(?: [12][0-9]{3})+"),
        (3, "copyright", "copyright", r"copyright(?: c)?"),
        (3, "warranty", "warranty", r"without warranty of any kind"),
        (3, "warranty", "warranties", r"without warranties or conditions of any kind"),
        (3, "permission", "permission", r"(?:used|reprinted|reproduced) (?:with|by) (?:kind )?permission"),
        (3, "unknown-licence", "license", rf"{_UNDER}(?:an? )?(?:[a-z0-9]+ ){{0,4}}license"),
        (3, "unknown-licence", "licence", rf"{_UNDER}(?:an? )?(?:[a-z0-9]+ ){{0,4}}licence"),
        (3, "terms", "terms", r"(?:subject to|see) the terms of (?:use|service|the licen[cs]e)"),
        (3, "trademark", "trademarks", r"(?:registered )?trademarks of"),
    ]
    return rules


# How sure a label of each tier is.
CONFIDENCE = (1.0, 0.9, 0.7, 0.4)


def rule_table(spark: SparkSession) -> DataFrame:
    """priority, tier, label, keyword, pattern: some hundreds of rows, by construction."""
    rows = [(k, tier, label, keyword, pattern) for k, (tier, label, keyword, pattern) in enumerate(_family_rules())]
    return spark.createDataFrame(rows, "priority int, tier int, label string, keyword string, pattern string").coalesce(1)


def keywords() -> list[str]:
    return sorted({keyword for _, _, keyword, _ in _family_rules()})


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _phrase(phrase: str) -> str:
    return f"(?<= ){phrase}(?= )"


def _words_in(text: Column) -> Column:
    """Spaces of a text: the number of the word that starts behind it, counted from 0, where the text starts with a space."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "))) - 1


def base_places(joined: Column) -> dict[str, Column]:
    """Count, first and last word, and labels of the fixed phrases in a text of words with a space on both sides."""
    counts = [F.regexp_count(joined, F.lit(_phrase(phrase))) for phrase, _ in BASE_PHRASES]
    firsts, lasts, names = [], [], []
    for (phrase, label), _ in zip(BASE_PHRASES, counts):
        spaced = F.lit(f" {phrase} ")
        there = F.contains(joined, spaced)
        before = F.substring_index(joined, f" {phrase} ", 1)
        behind = F.substring_index(joined, f" {phrase} ", -1)
        size = phrase.count(" ") + 1
        firsts.append(F.when(there, _words_in(F.concat(before, F.lit(" ")))))
        # Words up to the last place: all words without those behind it and its own.
        lasts.append(F.when(there, _words_in(joined) - (_words_in(behind) + 1) - size))
        names.append(F.when(there, F.lit(label)))
    none = F.lit(None).cast("int")
    return {
        "n_base": sum(counts[1:], counts[0]).cast("long"),
        "first_word": F.least(*firsts, none).cast("long"),
        "last_word": F.greatest(*lasts, none).cast("long"),
        "base": F.array_sort(F.array_compact(F.array(*names))),
    }


def prepared_texts(documents: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), words and joined for each document."""
    rows = documents.select("doc_id", words_of(whole()).alias("words"), F.xxhash64(whole()).alias("key"))
    return rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))


def detections(texts: DataFrame) -> DataFrame:
    """Every match of every rule whose keyword the document holds, as words start to end (exclusive)."""
    spark = texts.sparkSession
    rules = F.broadcast(rule_table(spark))
    held = F.array_intersect("words", F.array(*(F.lit(k) for k in keywords())))
    gated = texts.select("doc_id", "key", "joined", held.alias("held")).filter(F.size("held") > 0)
    gated = gated.dropDuplicates(["doc_id", "key"])
    met = gated.select("doc_id", "key", "joined", F.explode("held").alias("keyword")).join(rules, "keyword")
    spaced = F.concat(F.lit("(?<= )(?:"), F.col("pattern"), F.lit(")(?= )"))
    met = met.withColumn("spaced", spaced).filter(F.expr("regexp_like(joined, spaced)"))
    parts = met.select(
        "doc_id", "key", "priority", "tier", "label",
        F.expr("split(joined, spaced)").alias("between"),
        F.expr("regexp_extract_all(joined, spaced, 0)").alias("found"),
    )
    pieces = parts.select("*", F.posexplode("found").alias("k", "match")).select(
        "doc_id", "key", "priority", "tier", "label", "k",
        # Spaces before the match count words before it.
        (F.length(F.element_at("between", F.col("k") + 1)) - F.length(F.replace(F.element_at("between", F.col("k") + 1), F.lit(" ")))).alias("gap"),
        (F.length("match") - F.length(F.replace("match", F.lit(" ")))).alias("inner"),
    )
    so_far = Window.partitionBy("doc_id", "key", "priority").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.col("inner")).over(so_far) - F.col("inner") - 1
    return pieces.select("doc_id", "key", "priority", "tier", "label", start.alias("start"), (start + F.col("inner") + 1).alias("end"))


def resolved(found: DataFrame) -> DataFrame:
    """Matches that no interval of a better or equal tier contains; of equal intervals the best priority stays."""
    document = ["doc_id", "key"]
    best = found.groupBy(*document, "start", "end").agg(F.min(F.struct("tier", "priority", "label")).alias("rule"))
    spans = best.select(*document, "start", "end", "rule.*")
    before = Window.partitionBy(*document).orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("tier") <= t, F.col("end"))).over(before) for t in range(len(CONFIDENCE))]
    contained = F.coalesce(F.element_at(F.array(*reach), F.col("tier") + 1) >= F.col("end"), F.lit(False))
    return spans.withColumn("contained", contained).filter(~F.col("contained")).drop("contained")


def scanned(documents: DataFrame) -> DataFrame:
    """One row per document: words, base places, the labels of all detections that stay, and the highest confidence."""
    texts = prepared_texts(documents)
    kept = resolved(detections(texts)).groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("rule_labels"),
        F.max(F.element_at(F.array(*(F.lit(c) for c in CONFIDENCE)), F.col("tier") + 1)).alias("confidence"),
        F.count("*").alias("n_detections"),
    ).withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    base = base_places(F.col("joined"))
    rows = texts.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *(c.alias(n) for n, c in base.items()))
    joined = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("rule_labels", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base", labels.alias("labels"),
        F.coalesce("n_detections", F.lit(0)).alias("n_detections"),
        F.greatest(F.coalesce("confidence", F.lit(0.0)), F.when(F.size("base") > 0, 0.9).otherwise(0.0)).alias("confidence"),
    )
