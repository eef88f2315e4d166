"""License scans by diagonal voting.

Templates of license notices are cut into rolling word k-grams, and so is every document. Spark joins the hashes of
all of a document's k-grams to template positions. A hit at document word p and template word t votes for diagonal
p - t; a notice gives many votes to one diagonal, or to neighbouring ones where words were put in or left out. Votes
are added up by diagonal, neighbouring diagonals merged, and spans that cover enough of a template go back to their
documents, where the words themselves are compared. Where more words were put in or left out at one place, the diagonals
on both sides are chained, up to ``PUT_IN`` of the template's length apart; as such words spoil grams too, one gram is
enough for a chain, and the longest row of template words in order along it decides.

The base beside it: places where the words of a fixed phrase stand one after another. Defined cases: a null or empty
text has no words, no labels and score 0; repeated rows have equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import checkpointed
from silverline.llm.hashing import hashed_words, mixed

GRAM, NEAR = 3, 3  # words a gram, distance of diagonals to merge
COVERED, SHORT = 0.8, 12  # share of a template's words to find; templates of fewer words must be found whole
PUT_IN = 0.3  # words put in at one place, as a share of a template's length
BROADCAST_ROWS = 200_000  # documents with candidate spans; more of them are joined by shuffling

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices by label, as their licenses word them.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files, to deal in the Software without restriction",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
        "Licensed under the BSD License",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "gpl-3.0": [
        "licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or any later version",
    ],
    "gpl-2.0": [
        "licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or any later version",
    ],
    "lgpl": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by-4.0": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["has waived all copyright and related or neighboring rights to this work", "released under CC0 1.0 Universal Public Domain Dedication"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

_APART = np.ones(256, dtype=bool)  # bytes between words: all but digits, letters and what lies beyond ASCII
_APART[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = False
_WORDS = bytes(32 if _APART[b] else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORDS).split()


def template_rows() -> list[tuple[str, list[bytes]]]:
    return [(label, words_of(text)) for label, texts in TEMPLATES.items() for text in texts]


def gram_hashes(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    n = len(words) - gram + 1
    if n <= 0:
        return np.empty(0, np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(gram):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(total).view(np.int64)


def _grams(texts: list[bytes]) -> list[np.ndarray]:
    return [gram_hashes(words) for words in hashed_words([t.lower() for t in texts], _APART)]


def document_grams(docs: DataFrame) -> DataFrame:
    """The hash of the k-gram at each word of every document, as an array."""

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                arrays = _grams([value.as_py() or b"" for value in part.column(2).cast("binary")])
                offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), grams], ["__id", "__text", "grams"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"), "text").where("text IS NOT NULL")
    return keyed.mapInArrow(hashed, f"__id {kind}, __text long, grams array<long>")


def candidate_spans(docs: DataFrame) -> DataFrame:
    """Rows ``(__id, __text, spans)``: templates whose k-grams a document covers, with the diagonals that say so."""
    spark = docs.sparkSession
    templates = template_rows()
    rows = [(int(h), number, t, len(words)) for number, (_, words) in enumerate(templates) for t, h in enumerate(_grams([b" ".join(words)])[0])]
    positions = spark.createDataFrame(rows, "__hash long, template int, t int, n int")  # fixed: a row for each template word
    hits = document_grams(docs).select("__id", "__text", F.posexplode("grams").alias("p", "__hash")).join(F.broadcast(positions), "__hash")
    keys = ["__id", "__text", "template", "n"]
    votes = hits.groupBy(*keys, (F.col("p") - F.col("t")).alias("diagonal")).agg(F.collect_set("t").alias("ts"))  # a template's words at most
    along = Window.partitionBy(*keys).orderBy("diagonal")
    step = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(1 << 40))
    chained = F.greatest(F.lit(NEAR), F.floor(F.lit(PUT_IN) * F.col("n")))
    groups = votes.withColumn("step", step).withColumns(
        {"group": F.sum((F.col("step") > NEAR).cast("long")).over(along), "chain": F.sum((F.col("step") > chained).cast("long")).over(along)}
    )
    merged = groups.groupBy(*keys, "chain", "group").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("grams"),
    )
    # an edit spoils the k grams it touches, so fewer grams than words need to be found
    missing = F.when(F.col("n") < SHORT, F.lit(0)).otherwise(F.floor((1 - COVERED) * F.col("n")))
    likely = F.col("grams") >= F.greatest(F.lit(1), F.col("n") - GRAM + 1 - missing * GRAM)
    span = lambda first, last, chain: F.struct("template", first.alias("first"), last.alias("last"), F.lit(chain).alias("chain"))
    chains = merged.groupBy(*keys, "chain").agg(
        F.collect_list(F.when(likely, span(F.col("first"), F.col("last"), False))).alias("near"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    whole = F.when(F.col("n") >= SHORT, F.array(span(F.col("first"), F.col("last"), True))).otherwise(F.array())
    spans = chains.select("__id", "__text", F.explode(F.concat("near", whole)).alias("span"))
    return spans.groupBy("__id", "__text").agg(F.collect_list("span").alias("spans"))


def needed(n: int) -> float:
    return 1.0 if n < SHORT else COVERED


def covered(words: list[bytes], template: list[bytes], first: int, last: int) -> tuple[float, int, int]:
    """The share of a template's words that stand in the document on one of the diagonals, in order, and from where to where."""
    places = []
    for t, word in enumerate(template):
        for place in range(max(t + first, places[-1] + 1 if places else 0, 0), min(t + last, len(words) - 1) + 1):
            if words[place] == word:
                places.append(place)
                break
    return (len(places) / len(template), places[0], places[-1] + 1) if places else (0.0, 0, 0)


def chained(words: list[bytes], template: list[bytes], first: int, last: int) -> tuple[float, int, int]:
    """The same for a chain: the longest row of template words in order, with few enough other words between two of them."""
    size = len(template)
    gap = 1 + max(NEAR, int(PUT_IN * size))
    begin, until = max(first, 0), min(size + last, len(words))
    places: dict[bytes, list[int]] = {}
    for t, word in enumerate(template):
        places.setdefault(word, []).append(t)
    rows: list[tuple[int, np.ndarray]] = []  # for each of the last places: the best row that ends there at template word t
    best = (0, 0, 0)
    for place in range(begin, until):
        if (at := places.get(words[place])) is None:
            continue
        rows = [r for r in rows if place - r[0] <= gap]
        reached = np.zeros(size + 1, np.int64)  # length of the row times 2^32, less where it starts
        if rows:
            reached[1:] = np.maximum.accumulate(np.max([r for _, r in rows], axis=0))
        here = np.zeros(size, np.int64)
        for t in at:
            here[t] = reached[t] + (1 << 32) if reached[t] else (1 << 32) + (1 << 31) - place
        rows.append((place, here))
        length = int(here.max())
        if length >> 32 > best[0]:
            best = (length >> 32, (1 << 31) - (length & ((1 << 32) - 1)), place + 1)
    return best[0] / size, best[1], best[2]


def verified(words: list[bytes], spans: list, templates: list[tuple[str, list[bytes]]]) -> list[tuple[float, str]]:
    """Notices whose words are there. Of notices that share words of the document, the one that fits best counts."""
    fits, found = [], []
    for span in sorted(spans, key=lambda s: s["chain"]):
        label, template = templates[span["template"]]
        first, last = span["first"], span["last"]
        if span["chain"] and any(number == span["template"] and first <= diagonal <= last for number, diagonal in found):
            continue  # found on neighbouring diagonals already
        share, start, end = (chained if span["chain"] else covered)(words, template, first, last)
        if share >= needed(len(template)):
            fits.append((-share, -len(template), start, end, label))
            found.append((span["template"], first))
    kept: list[tuple] = []
    taken = bytearray(len(words))
    for share, size, start, end, label in sorted(fits):
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            kept.append((-share, label))
    return kept


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """The words at which a base phrase starts, with its label."""
    line, places = b" %b " % b" ".join(words), []
    for phrase, label in PHRASES.items():
        sought = b" %b " % phrase.encode()
        at, before, number = line.find(sought), 0, 0
        while at >= 0:
            number += line.count(b" ", before, at)
            before = at
            places.append((number, label))
            at = line.find(sought, at + 1)
    return places


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places and labels, all labels, and how well the best notice is covered."""
    templates = template_rows()

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for value, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = words_of(value.as_py())
                places = base_places(words)
                base, best = {label for _, label in places}, 1.0 if places else 0.0
                labels = set(base)
                for share, label in verified(words, spans.as_py() or [], templates):
                    labels.add(label)
                    best = max(best, share)
                starts = [place for place, _ in places]
                row = (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)
                for values, x in zip(out.values(), row, strict=True):
                    values.append(x)
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
            arrays = [pa.array(values, k) for values, k in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *out])

    spans = checkpointed(candidate_spans(docs))
    spans = F.broadcast(spans) if spans.count() <= BROADCAST_ROWS else spans
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text"))
    joined = keyed.join(spans, same, "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return joined.mapInArrow(verify, schema)
