"""License scans by diagonal voting. DataFrame functions only.

Every rolling k-gram of a document's words is joined, by hash, to the places where license
templates have it. A match of document place d and template place t votes for the diagonal
d - t: a copy of the template puts its votes on one diagonal, a copy with words put in or
left out on neighbouring ones. Neighbouring diagonals are merged into a span.

A span is verified by aligning its words with the template's: the edits between them, with
words outside of matching grams taken for other words, must be few. Short templates are names
of a license and need every word in a row, so that a word which names another family between
them is no match. A long notice needs the name that it gives in one piece. Where spans of
several families overlap, the best aligned one has the place, and a span counts if it has at
least half of its places.

Templates are notices and, of whole licenses, overlapping passages that are each verified on
their own, so that any part of a license is seen.
"""

from __future__ import annotations

import pkgutil
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import ascii_lower, whole

GRAM = 3
# Diagonals this far apart still belong to one copy of a long template.
MERGE = 3
# Templates with fewer words must stand as they are.
SHORT = 16
# Least share of a long template's words that is left after all edits.
MIN_COVER = 0.7
# Stands for a word that no match covers. Words of a template have the characters behind it.
OTHER, FIRST_CODE = "!", 34
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# License notices and opening passages, by label.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 "
        "international license",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ),
)
# Notices of further families, by label, and the names that families go by.
NOTICES = (
    (
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu affero general public license as published by the free software foundation",
    ),
    ("agpl", "gnu affero general public license"),
    ("apache", "the apache license"),
    ("gpl", "gnu general public license"),
    ("isc", "the isc license"),
    (
        "epl",
        "this program and the accompanying materials are made available under the terms of the "
        "eclipse public license",
    ),
    ("epl", "eclipse public license"),
    ("lgpl", "gnu lesser general public license"),
    ("lgpl", "gnu library general public license"),
    ("mit", "the mit license"),
    ("mpl", "mozilla public license"),
)
# Names of the Creative Commons licenses; a label is ``cc-`` and the code.
CC_NAMES = {"by": "attribution", "nc": "noncommercial", "nd": "noderivatives", "sa": "sharealike"}
CC_CODES = ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa")
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# What a long notice must have in one piece.
NAMED = {
    "agpl": "gnu affero general public license",
    "epl": "eclipse public license",
    "gpl": "gnu general public license",
}
# Words of a passage of a license, and from one passage to the next.
PASSAGE, STRIDE = 40, 20
# Base phrases, by label.
PHRASES = (
    ("apache", ("apache", "license")),
    ("gpl", ("general", "public", "license")),
    ("mit", ("mit", "license")),
)

HASH = "_text_hash"
GRAM_ROW = "template int, template_place int, short boolean, gram string"
TEMPLATE_ROW = (
    "template int, label string, coded string, least double, named_from int, named_grams int"
)


def words_of(text: Column) -> Column:
    """Runs of digits, letters (A-Z in lower case) and characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(whole(text)), BETWEEN_WORDS), "")


def _gram_at(words: Column, place: Column, size: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, place + step) for step in range(size)])


def _places(words: Column, beyond: int) -> Column:
    """0 to the last place where a run of ``beyond + 1`` words can start."""
    last = F.size(words) - 1 - beyond
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
        F.array().cast("array<int>")
    )


def _shared(words: list[str], known: set, size: int = GRAM) -> float:
    """Share of the words that lie in known k-grams."""
    inside = set()
    for place in range(len(words) - size + 1):
        if tuple(words[place : place + size]) in known:
            inside.update(range(place, place + size))
    return len(inside) / len(words)


@cache
def passages() -> tuple[tuple[str, str], ...]:
    """Overlapping passages of whole licenses, by label.

    What a family shares with one before it in the file counts for that one alone.
    """
    data = pkgutil.get_data(__package__, "license_texts.txt").decode("utf-8")
    out, known = [], {}
    for text in data.split("# ")[1:]:
        label, _, body = text.partition("\n")
        words = body.split()
        last = max(0, len(words) - PASSAGE)
        others = set().union(*(grams for name, grams in known.items() if name != label))
        for start in (*range(0, last, STRIDE), last):
            passage = words[start : start + PASSAGE]
            if _shared(passage, others) < MIN_COVER:
                out.append((label, " ".join(passage)))
        grams = zip(*(words[step:] for step in range(GRAM)))
        known.setdefault(label, set()).update(grams)
    return tuple(dict.fromkeys(out))


def creative_commons() -> tuple[tuple[str, str], ...]:
    """Codes and names of the licenses with their versions: a version ends a name."""
    out = []
    for code in CC_CODES:
        label = "cc-" + code.replace(" ", "-")
        name = " ".join(CC_NAMES[part] for part in code.split())
        for version in CC_VERSIONS:
            out.append((label, f"cc {code} {version}"))
            out.append((label, f"creative commons {name} {version}"))
    return tuple(out)


@cache
def all_templates() -> tuple[tuple[str, str], ...]:
    return tuple(dict.fromkeys((*TEMPLATES, *NOTICES, *creative_commons(), *passages())))


def coded(words: list[str]) -> str:
    """A character for each different word, so that alignment is one of characters."""
    codes = {word: chr(FIRST_CODE + at) for at, word in enumerate(dict.fromkeys(words))}
    return "".join(codes[word] for word in words)


def template_rules(templates, size: int = GRAM) -> list[tuple]:
    """``number, label, coded words, least cover, first gram and grams of a needed name``."""
    out = []
    for number, (label, text) in enumerate(templates):
        words, name = text.split(), NAMED.get(label, "").split()
        short = len(words) < SHORT
        places = [at for at in range(len(words)) if name and words[at : at + len(name)] == name]
        needed = (places[0], len(name) - size + 1) if places and not short else (0, 0)
        out.append((number, label, coded(words), 1.0 if short else MIN_COVER, *needed))
    return out


def template_grams(spark: SparkSession, templates=TEMPLATES, size: int = GRAM) -> DataFrame:
    """A row for every k-gram of every template; as many as the templates have words."""
    rows = []
    for number, (_, text) in enumerate(templates):
        words = text.split()
        for place in range(len(words) - size + 1):
            gram = " ".join(words[place : place + size])
            rows.append((number, place, len(words) < SHORT, gram))
    return spark.createDataFrame(rows, GRAM_ROW).withColumn("gram_hash", F.xxhash64("gram"))


def _worded(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.xxhash64("text").alias(HASH), words_of(F.col("text")).alias("words")
    )


def _candidates(docs: DataFrame, templates, size: int) -> DataFrame:
    """Spans of merged diagonals: ``doc_id, _text_hash, template``, their ends and matches.

    The template side is a fixed list and is broadcast; documents do not move before the
    votes are counted.
    """
    grams = F.transform(
        _places(F.col("words"), size - 1), lambda place: _gram_at(F.col("words"), place, size)
    )
    rolled = _worded(docs).select("doc_id", HASH, F.posexplode(grams).alias("place", "doc_gram"))
    known = F.broadcast(template_grams(docs.sparkSession, templates, size))
    same = (F.xxhash64("doc_gram") == known["gram_hash"]) & (F.col("doc_gram") == known["gram"])
    matches = rolled.join(known, same)
    copy = ["doc_id", HASH, "template"]
    votes = matches.groupBy(
        *copy, "short", (F.col("place") - F.col("template_place")).alias("diagonal")
    ).agg(F.collect_set("template_place").alias("places"))
    along = Window.partitionBy(*copy).orderBy("diagonal")
    apart = F.when(F.col("short"), 0).otherwise(MERGE)
    far = F.col("diagonal") - F.lag("diagonal").over(along) > apart
    merged = votes.withColumn("far", far.cast("int")).withColumn(
        "copy", F.coalesce(F.sum("far").over(along), F.lit(0))
    )
    return merged.groupBy(*copy, "copy").agg(
        F.collect_list(F.struct("diagonal", "places")).alias("lines"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("places") + size).alias("end_word"),
    )


def _aligned(found: DataFrame, templates, size: int) -> DataFrame:
    """Candidates whose words agree with the template's, with ``label`` and ``cover``."""
    rules = found.sparkSession.createDataFrame(template_rules(templates, size), TEMPLATE_ROW)

    def codes_of(line: Column) -> Column:
        one = lambda place, step: F.struct(
            (line["diagonal"] + place + step).alias("word"),
            F.substr(F.col("coded"), place + step + 1, F.lit(1)).alias("code"),
        )
        return F.flatten(
            F.transform(line["places"], lambda place: F.array(*[one(place, F.lit(step)) for step in range(size)]))
        )

    codes = F.map_from_entries(F.array_distinct(F.flatten(F.transform("lines", codes_of))))
    shown = F.transform(
        F.sequence(F.col("first_word"), F.col("end_word") - 1),
        lambda word: F.coalesce(F.element_at(F.col("codes"), word), F.lit(OTHER)),
    )
    edits = F.levenshtein(F.array_join("shown", ""), F.col("coded"))
    name = F.when(
        F.col("named_grams") > 0,
        F.sequence(F.col("named_from"), F.col("named_from") + F.col("named_grams") - 1),
    ).otherwise(F.array().cast("array<int>"))
    named = F.exists("lines", lambda line: F.size(F.array_except(name, line["places"])) == 0)
    return (
        found.join(F.broadcast(rules), "template")
        .withColumn("codes", codes)
        .withColumn("shown", shown)
        .withColumn("cover", 1 - edits / F.length("coded"))
        .where((F.col("cover") >= F.col("least")) & named)
        .select("doc_id", HASH, "label", "template", "first_word", "end_word", "cover")
    )


def spans(docs: DataFrame, templates=TEMPLATES, size: int = GRAM) -> DataFrame:
    """Verified spans: ``doc_id, _text_hash, label, template, first_word, end_word, cover``.

    Word places count from 0, ``end_word`` is the place after the span, ``cover`` is the share
    of the template's words that is left after all edits. A place that spans of several labels
    have goes to the best aligned of them, to all of these if they are equal, and a span stays
    if it has at least half of its places.
    """
    aligned = _aligned(_candidates(docs, templates, size), templates, size)
    span = ["doc_id", HASH, "label", "template", "first_word", "end_word", "cover"]
    placed = aligned.select(
        *span, F.explode(F.sequence(F.col("first_word"), F.col("end_word") - 1)).alias("word")
    )
    best = F.max("cover").over(Window.partitionBy("doc_id", HASH, "word"))
    won = placed.withColumn("won", (F.col("cover") == best).cast("int"))
    judged = won.groupBy(*span).agg(F.sum("won").alias("won"))
    return judged.where(2 * F.col("won") >= F.col("end_word") - F.col("first_word")).drop("won")


def _base(rows: DataFrame) -> DataFrame:
    """Places of the base phrases. Only texts with the word all phrases end in are searched."""
    words = F.col("words")

    def found(phrase: tuple[str, ...]) -> Column:
        def here(place: Column) -> Column:
            tests = [F.get(words, place + at) == F.lit(word) for at, word in enumerate(phrase)]
            both = tests[0]
            for test in tests[1:]:
                both = both & test
            return both

        return F.filter(_places(words, len(phrase) - 1), here)

    nowhere = F.array().cast("array<int>")
    at = {
        f"_{label}": F.when(F.array_contains(words, "license"), found(phrase)).otherwise(nowhere)
        for label, phrase in PHRASES
    }
    labels = F.array(*[F.when(F.size(f"_{label}") > 0, F.lit(label)) for label, _ in PHRASES])
    every = F.concat(*[F.col(name) for name in at])
    return (
        rows.select("doc_id", HASH, F.size(words).cast("long").alias("n_words"), words)
        .withColumns(at)
        .select(
            "doc_id",
            HASH,
            "n_words",
            F.size(every).cast("long").alias("n_base"),
            F.array_min(every).cast("long").alias("first_word"),
            F.array_max(every).cast("long").alias("last_word"),
            F.array_compact(labels).alias("base"),
        )
    )


def scan(docs: DataFrame, templates=None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base labels come from phrases of consecutive words; spans add theirs. Both are
    sorted, comma-joined, and empty without a license. ``score`` is the largest ``cover`` of a
    span, 1 with a base phrase, 0 without a label. A NULL text
    counts as an empty one: no words, no labels. Without ``templates`` all notices and passages
    are searched for. Rows that repeat an id are scanned each by its own text; other columns
    play no part. An empty table gives an empty result.
    """
    seen = (
        spans(docs, all_templates() if templates is None else templates)
        .groupBy("doc_id", HASH)
        .agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"))
        .select(F.col("doc_id").alias("_id"), F.col(HASH).alias("_hash"), "more", "cover")
    )
    rows = _base(_worded(docs))
    same = rows["doc_id"].eqNullSafe(seen["_id"]) & (rows[HASH] == seen["_hash"])
    more = F.coalesce("more", F.array().cast("array<string>"))
    return rows.join(seen, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
