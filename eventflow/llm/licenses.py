"""License scan: exact set-similarity join of text blocks with license templates.

DataFrame functions only. A block is the text between blank lines or between
a full stop, exclamation mark, question mark or semicolon and the white space
behind it. Comment signs that begin a line are dropped first, and a single line
break is white space, so that a wrapped or commented notice is one block. The
templates are a table; a template's text is cut into blocks by the same rule
(those of fewer than LEAST_WORDS distinct words count only if the template has
no other), so whole licences can be given. A text's block meets a template
block if it holds at least ``threshold`` of its distinct words (containment).

The join: template words are ordered by the number of documents of the whole
corpus that hold them, rarest first. A template block needs ``o =
ceil(threshold * size)`` shared words, so a block that meets it shares one of
its first ``size - o + 1`` words (prefix filter: the only words that the
corpus is joined on; a text without any is not cut into blocks at all), has at least ``o`` words (length filter), and the shared
prefix words with what stands behind the last of them can still reach ``o``
(positional filter). Candidates are verified exactly. Nothing of the templates
is a literal of the plan, and neither side is broadcast by hint; the prefix
words, a tenth of the templates' words, are one array (a scalar subquery).

Base phrases are found at every place where their words stand consecutively.
A null text counts as empty (no words, null places, empty labels, score 0).
Results depend on the text alone, so found labels are joined back by the
text's digest: repeated rows give repeated results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm.common import col, only, staged, texts

# fixed values: base phrases and labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: license notices
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
THRESHOLD = 0.9

LEAST_WORDS = 5

#: what separates words, upper case included
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: comment signs at the beginning of a line, and what separates blocks once they are gone
COMMENT = r"\n[\x09\x20]*[#*/;%-]+"
BLOCK = r"[.!?;][\x09-\x0D\x20]+|\n(?:[\x09\x0B-\x0D\x20]*\n)+"


def template_words(notice: str) -> list[str]:
    return sorted(set(re.split(GAP, notice.lower())) - {""})


def _words(text: Column) -> Column:
    """Words with an empty string before or behind them where a gap begins or ends the text."""
    return F.split(text, GAP, -1)


def _count(parts: Column) -> Column:
    n = F.size(parts)
    return (n - (F.element_at(parts, 1) == "").cast("int")
            - ((n > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def _digest(text: Column) -> Column:
    return F.md5(text)


def block_words(text: Column) -> Column:
    """The distinct words of each block of a text."""
    plain = F.regexp_replace(text, COMMENT, "\n")
    return F.transform(F.split(plain, BLOCK, -1), lambda b: F.array_distinct(F.filter(_words(F.lower(b)), lambda w: w != "")))


def template_table(spark: SparkSession, templates) -> DataFrame:
    """(label, notice) from a list of pairs or a frame of two columns."""
    if isinstance(templates, DataFrame):
        return templates.toDF("label", "notice")
    return spark.createDataFrame([(label, notice) for label, notice in templates], "label string, notice string")


def template_blocks(templates: DataFrame, threshold: float) -> DataFrame:
    """(unit, label, words, size, needed): the templates' blocks, staged. Equal blocks of a label are one."""
    own = templates.where("label IS NOT NULL AND notice IS NOT NULL").select("label", block_words(F.col("notice")).alias("blocks"))
    large = F.filter("blocks", lambda w: F.size(w) >= LEAST_WORDS)
    filled = F.filter("blocks", lambda w: F.size(w) > 0)
    rows = own.select("label", F.explode(F.when(F.size(large) > 0, large).otherwise(filled)).alias("words")).select("label", F.array_sort("words").alias("words")).distinct()
    size = F.size("words")
    return staged(rows.select(F.xxhash64("label", "words").alias("unit"), "label", "words", size.alias("size"),
                              F.ceil(F.round(size * F.lit(threshold), 9)).cast("int").alias("needed")), "license-templates")


def prefix_index(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(token, unit, i, size, needed): the first words of each template block in the order of the corpus's document counts, staged."""
    vocabulary = units.select(F.explode("words").alias("w")).distinct()
    seen = docs.select(F.explode(F.array_distinct(_words(F.lower("text")))).alias("token"))
    counts = seen.join(vocabulary, seen["token"] == vocabulary["w"]).groupBy("w").agg(F.count("*").alias("n"))
    of = units.select("unit", "size", "needed", F.explode("words").alias("token"))
    ranked = (of.join(counts, of["token"] == counts["w"], "left").groupBy("unit", "size", "needed")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("ranked")))
    first = F.slice("ranked", F.lit(1), F.col("size") - F.col("needed") + 1)
    return staged(ranked.select("unit", "size", "needed", F.posexplode(first).alias("i", "r")).select("r.token", "unit", "i", "size", "needed"), "license-index")


def matching_blocks(df: DataFrame, text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(text_digest, block, label, containment): every block of every text that meets a template block (``block`` is its number).

    Equal texts share a digest and give the same rows once.
    """
    df = only(df, [text_col])
    docs = df.select(F.coalesce(col(df, text_col).cast("string"), F.lit("")).alias("text"))
    units = template_blocks(template_table(df.sparkSession, templates), threshold)
    index = prefix_index(docs, units)
    # a text without any prefix word has no candidate; only the others are cut into blocks
    prefix = index.agg(F.collect_set("token")).scalar()
    hopeful = docs.where(F.arrays_overlap(_words(F.lower("text")), prefix))
    blocks = hopeful.select(_digest(F.col("text")).alias("text_digest"), F.posexplode(block_words(F.col("text"))).alias("block", "words"))
    probes = blocks.select("text_digest", "block", "words", F.explode("words").alias("word"))
    hits = probes.join(index, probes["word"] == index["token"]).where(F.size("words") >= F.col("needed"))
    pairs = (hits.groupBy("text_digest", "block", "unit", "size", "needed")
             .agg(F.collect_set("i").alias("at"), F.first("words").alias("words")))
    # besides the shared prefix words only the needed - 1 words behind the prefix can be shared
    reach = F.size("at") + F.least(F.col("needed") - 1, F.size("words") - F.size("at"))
    pairs = pairs.where(reach >= F.col("needed"))
    own = units.select(F.col("unit").alias("of"), "label", F.col("words").alias("own"))
    met = pairs.join(own, pairs["unit"] == own["of"])
    return (met.withColumn("containment", F.size(F.array_intersect("words", "own")) / F.col("size"))
            .where(F.col("containment") >= threshold - 1e-9).select("text_digest", "block", "label", "containment"))


def _phrase_places(words: list[str]) -> Column:
    """Starts of a phrase in ``_words``; only rows marked ``_has`` are looked at."""
    last = F.size("_words") - len(words)

    def here(i):
        ok = F.get("_words", i) == words[0]
        for k in range(1, len(words)):
            ok = ok & (F.get("_words", i + k) == words[k])
        return ok

    return (F.when(F.col("_has") & (last >= 0), F.filter(F.sequence(F.lit(0), last), here))
            .otherwise(F.array().cast("array<int>")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, carry, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    src = texts(df, id_col, text_col, carry)
    text = col(src, text_col)
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    phrase = f"(?:^|{gap})(?:" + "|".join(f"{gap}+".join(p.split()) for p in BASE) + f")(?:{gap}|$)"
    rare = F.lit(False)
    for p in BASE:  # a cheap look first
        hit = F.lit(True)
        for w in p.split():
            hit = hit & F.col("_lower").contains(w)
        rare = rare | hit
    marked = src.withColumn("_lower", F.lower(text)).withColumn("_has", rare & F.col("_lower").rlike(phrase))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    all_words = F.filter(_words(F.translate(text, upper, upper.lower())), lambda w: w != "")
    marked = marked.withColumn("_words", F.when(F.col("_has"), all_words)).withColumn("_parts", _words(text))
    places = {p: _phrase_places(p.split()) for p in BASE}
    kept = [col(src, id_col), *[col(src, c) for c in carry or []]]
    marked = marked.select(*kept, _digest(text).alias("_digest"), _count(F.col("_parts")).alias("n_words"),
                           *[e.alias(f"_at_{k}") for k, e in enumerate(places.values())])
    every = F.concat(*[F.col(f"_at_{k}") for k in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.size(f"_at_{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]))
    found = (matching_blocks(df, text_col, templates, threshold).groupBy("text_digest")
             .agg(F.collect_set("label").alias("_own"), F.max("containment").alias("_best")))
    joined = marked.join(found, marked["_digest"] == found["text_digest"], "left")
    own = F.coalesce("_own", F.array().cast("array<string>"))
    return joined.select(
        *[col(joined, c) for c in [id_col, *(carry or [])]], "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def oracle_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same by brute force, every block against every template block, for DuckDB."""
    gap, lower = GAP, "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({quote(label)}, {quote(notice)})" for label, notice in templates)
    cut = lambda t: f"regexp_split_to_array(regexp_replace({t}, '{COMMENT}', chr(10), 'g'), '{BLOCK}')"
    split = lambda b: f"list_distinct(list_filter(regexp_split_to_array(lower({b}), '{gap}'), lambda x: x <> ''))"
    places = " UNION ALL ".join(
        f"SELECT rid, '{label}' AS label, unnest(list_filter(range(0, len(w) - {len(p.split()) - 1}), lambda i: "
        + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split())) + f")) AS place FROM d WHERE len(w) >= {len(p.split())}"
        for p, label in BASE.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array({lower}, '{gap}'), lambda x: x <> '') AS w FROM documents),
v(label, notice) AS (VALUES {values}),
tb AS (SELECT label, notice, {split("block")} AS words FROM (SELECT label, notice, unnest({cut("notice")}) AS block FROM v)),
t AS (SELECT label, words FROM (SELECT *, max(len(words)) OVER (PARTITION BY label, notice) AS most FROM tb)
      WHERE len(words) >= CASE WHEN most >= {LEAST_WORDS} THEN {LEAST_WORDS} ELSE 1 END),
b AS (SELECT rid, {split("block")} AS bw FROM (SELECT rid, unnest({cut("t")}) AS block FROM d)),
m AS (SELECT rid, label, len(list_intersect(words, bw)) / len(words) AS c FROM b, t
      WHERE len(list_intersect(words, bw)) / len(words) >= {threshold - 1e-9}),
p AS ({places}),
pa AS (SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
              string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY rid),
la AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
       (SELECT rid, label FROM p UNION SELECT rid, label FROM m) GROUP BY rid),
ma AS (SELECT rid, max(c) AS best FROM m GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN pa USING (rid) LEFT JOIN la USING (rid) LEFT JOIN ma USING (rid)"""
