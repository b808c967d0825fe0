"""Licence scan by a positional rare-token index, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands between words once A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose every place is a base hit, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # the mandatory phrase, part of the text


#: Short public licence notices, in words.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit", "released under the mit license", "the mit license"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
)

#: Rarest words of a template that are its postings.
POSTINGS = 4
#: Postings that must agree on a place, and the share of a template's words that must stand there.
AGREE, SHARE = 2, 0.8


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null gives none.

    ``lower`` maps two letters outside ASCII to ASCII ones; they are words' letters either way, so they
    are replaced first by another such letter.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212A"), F.lit("\uFFFD")), F.lit("\u0130"), F.lit("\uFFFD"))
    return F.array_remove(F.split(F.lower(plain), BETWEEN), "")


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _starts(words: Column, phrase: str) -> Column:
    """Places, from 0, where the words of the phrase stand one after another."""
    wanted = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - len(wanted))
    hit = lambda i: F.slice(words, i + 1, len(wanted)) == _strings(wanted)
    first = lambda i: F.get(words, i) == wanted[0]
    found = F.filter(F.filter(places, first), hit)
    return F.when(F.size(words) >= len(wanted), found).otherwise(F.array().cast("array<int>"))


def vocabulary(templates=TEMPLATES, base=BASE) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()} | {w for phrase, _ in base for w in phrase.split()})


def rarest_first(words: DataFrame, vocab: list[str]) -> list[str]:
    """The licence words by falling inverse document frequency over all rows, ties by word.

    The counts are as many as the vocabulary has words, whatever the corpus.
    """
    present = words.select(F.explode(F.array_intersect(_strings(vocab), F.col("words"))).alias("word"))
    counts = {r["word"]: r["n"] for r in present.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocab, key=lambda w: (counts.get(w, 0), w))


def _literal(templates, posted: list[list[str]]) -> Column:
    """The templates as an array of structs: words, mandatory phrase with its place, postings."""
    rows = []
    for i, (t, rare) in enumerate(zip(templates, posted)):
        wanted, phrase = t.text.split(), t.key.split()
        head = next(i for i in range(len(wanted)) if wanted[i:i + len(phrase)] == phrase)
        postings = [F.struct(F.lit(w).alias("word"), F.lit(q).alias("at")) for w in rare for q, x in enumerate(wanted) if x == w]
        rows.append(F.struct(
            F.lit(i).alias("number"), F.lit(t.label).alias("label"), _strings(wanted).alias("words"), _strings(phrase).alias("phrase"),
            F.lit(head).alias("head"), _strings(rare).alias("rare"), F.array(*postings).alias("postings"),
        ))
    return F.array(*rows)


def _hits(t: Column, agree: int, share: float) -> Column:
    """Where a template stands in the column ``words``, given the licence words of the file in ``present``."""
    words, looked = F.col("words"), F.col("present")
    everywhere = F.sequence(F.lit(0), F.size(words) - 1)
    looked_up = F.filter(t["postings"], lambda x: F.array_contains(looked, x["word"]))

    def starts(x: Column) -> Column:
        return F.transform(F.filter(everywhere, lambda p: F.get(words, p) == x["word"]), lambda p: p - x["at"])

    def stands(d: Column) -> Column:
        votes = F.filter(looked_up, lambda x: F.get(words, d + x["at"]) == x["word"])
        voters = F.size(F.array_distinct(F.transform(votes, lambda x: x["word"])))
        whole = F.slice(words, d + t["head"] + 1, F.size(t["phrase"])) == t["phrase"]
        return F.when(d + t["head"] < 0, False).otherwise((voters >= agree) & whole)

    def scored(d: Column) -> Column:
        size = F.size(t["words"])
        same = F.filter(F.sequence(F.lit(0), size - 1), lambda q: F.get(words, d + q) == F.get(t["words"], q))
        return F.struct(t["number"].alias("template"), t["label"].alias("label"), d.alias("start"), (F.size(same) / size).alias("share"))

    places = F.filter(F.array_distinct(F.flatten(F.transform(looked_up, starts))), stands)
    return F.filter(F.transform(places, scored), lambda x: x["share"] >= share)


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, postings: int = POSTINGS, agree: int = AGREE, share: float = SHARE) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places``, a row for each row.

    All licence words of a file are looked up among the postings of the templates, which are each
    template's rarest words by document frequency in all files.  A posting at word q of a template
    that stands at word p of the file votes for the place p - q; a place with ``agree`` votes is compared
    word by word, and counts if its mandatory phrase is whole and ``share`` of its words agree.  ``score``
    is the best share, 1 with a base hit, else 0; ``places`` holds template number, label,
    start and share.
    Null and empty texts have no words and no labels; places of equal share all stay.  Other columns and
    repeated rows don't matter; an empty table gives no rows.
    """
    vocab = vocabulary(templates, base)
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    order = rarest_first(texts, vocab)
    rank = {w: i for i, w in enumerate(order)}
    posted = [sorted(set(t.text.split()), key=rank.__getitem__)[:postings] for t in templates]
    rows = texts.withColumn("present", F.array_intersect(_strings(order), F.col("words")))

    def base_starts(phrase: str) -> Column:
        there = F.size(F.array_intersect(F.col("present"), _strings(phrase.split()))) == len(set(phrase.split()))
        return F.when(there, _starts(F.col("words"), phrase)).otherwise(F.array().cast("array<int>"))

    rows = rows.select("*", *[base_starts(p).alias(f"base{i}") for i, (p, _) in enumerate(base)])
    rows = rows.withColumn("near", F.filter(_literal(templates, posted), lambda t: F.size(F.array_intersect(F.col("present"), t["rare"])) >= agree))
    rows = rows.withColumn("found", F.flatten(F.transform("near", lambda t: _hits(t, agree, share))))
    starts = F.concat(*[F.col(f"base{i}") for i in range(len(base))])
    named = F.array_compact(F.array(*[F.when(F.size(f"base{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(base)]))
    more = F.transform("found", lambda x: x["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        joined(named).alias("base_labels"),
        joined(F.concat(named, more)).alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.col("found").alias("places"),
    )
