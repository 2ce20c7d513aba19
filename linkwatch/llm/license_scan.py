"""Licence notices found through a positional index of rare words.

Templates are indexed by word and place.  A corpus count gives each licence
word an inverse document frequency.  A file's licence words are looked up from
the rarest on, their postings are intersected by relative position, and a
template is reported where its mandatory phrase is verified and enough of the
template stands around it.  The index holds the templates alone, whatever the
corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ASCII letters, digits and all characters beyond ASCII, on lower-cased UTF-8
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}

# Label, mandatory phrase, opening of the public notice that holds the phrase.
NOTICES = (
    ("agpl-3.0", "gnu affero general public license",
     "under the terms of the gnu affero general public license version 3"),
    ("apache-2.0", "apache license version 2 0",
     "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met"),
    ("cc-by-4.0", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0",
     "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "licensed under cc by nd 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc0-1.0", "cc0 1 0", "cc0 1 0 universal public domain dedication"),
    ("gpl-2.0", "gnu general public license version 2",
     "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3",
     "licensed under the gnu general public license version 3"),
    ("isc", "to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or"
     " without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license",
     "under the terms of the gnu lesser general public license"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"
     " and associated documentation files"),
    ("mpl-2.0", "mozilla public license",
     "subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "free and unencumbered software",
     "this is free and unencumbered software released into the public domain"),
)

COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)
DOCUMENTS = b""  # the number of documents among word counts; no word is empty
LOOKUPS = 3  # words of a phrase whose postings are intersected before it is verified
DRIFT = 2
DRIFTS = sorted(range(-DRIFT, DRIFT + 1), key=abs)
FINDINGS = "doc_id long, label string, start long, length long, share double"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: tuple[bytes, ...]
    at: int  # place of the phrase in the words
    base: bool

    @classmethod
    def of(cls, label: str, phrase: str, notice: str, base: bool = False) -> Template:
        words, key = tuple(notice.encode().split()), tuple(phrase.encode().split())
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return cls(label, words, key, at, base)


TEMPLATES = tuple(
    [Template.of(k, p, p, True) for k, p in BASE_PHRASES.items()]
    + [Template.of(*x) for x in NOTICES]
)


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def document_frequencies(docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
    """How many documents hold each licence word, and under ``DOCUMENTS`` how many there are.

    Counted over all of them: tasks send one count per licence word, and the
    result has one per word.  An empty table gives no counts.
    """
    vocabulary = {w for t in TEMPLATES for w in t.words}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            found[DOCUMENTS] += batch.num_rows
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
            names=["word", "n"],
        )

    counts = docs.select(text_col).mapInArrow(count, "word binary, n long")
    return {bytes(x.word): x.n for x in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class PositionalIndex:
    """Postings (template, place) of every template word, and the words' rarity.

    ``keys`` holds the postings of mandatory phrases alone: a template can only
    stand where all words of its phrase do, so these open and narrow the places
    where it may begin; ``postings`` tell how much of it stands there.
    """

    def __init__(self, frequencies: dict[bytes, int], templates: tuple[Template, ...] = TEMPLATES):
        documents = frequencies.get(DOCUMENTS, max(frequencies.values(), default=0))
        self.templates = templates
        self.idf = {
            w: math.log((documents + 1) / (frequencies.get(w, 0) + 1))
            for t in templates
            for w in t.words
        }
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.keys: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight = [0.0] * len(templates)
        for n, t in enumerate(templates):
            for i, w in enumerate(t.words):
                self.postings[w].append((n, i))
                self.weight[n] += 1.0 + self.idf[w]
                if t.at <= i < t.at + len(t.phrase):
                    self.keys[w].append((n, i))
        self.needs = [frozenset(t.phrase) for t in templates]

    def starts(self, places: dict[bytes, dict[int, None]]) -> dict[int, list[int]]:
        """Where templates may begin: postings of rare words met by relative position.

        Licence words of the file are taken from the rarest on.  The first that a
        template's phrase holds opens its starts, up to ``LOOKUPS - 1`` others
        narrow them; templates whose phrase lacks a word in the file never open.
        """
        able = {n for n, need in enumerate(self.needs) if need <= places.keys()}
        found: dict[int, list[int]] = {}
        used: Counter[int] = Counter()
        for word in sorted(places.keys() & self.keys.keys(), key=lambda w: (-self.idf[w], w)):
            here = places[word]
            for n, place in self.keys[word]:
                if n not in able or used[n] == LOOKUPS:
                    continue
                used[n] += 1
                if n in found:
                    found[n] = [x for x in found[n] if x + place in here]
                else:
                    found[n] = [i - place for i in here]
        return found

    def share(self, n: int, start: int, places: dict[bytes, dict[int, None]]) -> float:
        """Weighted share of a template's words that stand around a start, its phrase included.

        From the phrase outwards a word may stand up to ``DRIFT`` places off where
        the last one found puts it, so insertions and losses carry on.
        """
        t = self.templates[n]
        matched = sum(1.0 + self.idf[w] for w in t.phrase)
        for side in (range(t.at - 1, -1, -1), range(t.at + len(t.phrase), len(t.words))):
            shift = start
            for k in side:
                here = places.get(t.words[k], ())
                off = next((d for d in DRIFTS if shift + k + d in here), None)
                if off is not None:
                    matched += 1.0 + self.idf[t.words[k]]
                    shift += off
        return matched / self.weight[n]

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Template number, place of its mandatory phrase and the share of it that stands there."""
        places: dict[bytes, dict[int, None]] = {}
        for i, w in enumerate(words):
            if w in self.postings:
                places.setdefault(w, {})[i] = None
        found = []
        for n, starts in self.starts(places).items():
            t = self.templates[n]
            for start in starts:
                key = start + t.at
                if key >= 0 and tuple(words[key : key + len(t.phrase)]) == t.phrase:
                    found.append((n, key, self.share(n, start, places)))
        return found


def scanned(
    docs: DataFrame, frequencies: dict[bytes, int], *, least: float = 0.5, findings: bool = False
) -> DataFrame:
    """One row per document, or one row per notice with its place (``findings``).

    Words are counted from 0 in the whole text; a null or empty text has none.
    Base phrases count wherever their words stand consecutively.  A template of
    the method counts from a weighted share ``least`` of its words on; ``score``
    is the best share, 1 for a base phrase, 0 where nothing was found.  Rows that
    repeat an id are scanned one by one; other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = PositionalIndex(frequencies)
        for batch in batches:
            out = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = words_of(text)
                hits = [
                    x for x in index.scan(words) if TEMPLATES[x[0]].base or x[2] >= least
                ]
                if findings:
                    out += [
                        (doc, TEMPLATES[n].label, key, len(TEMPLATES[n].phrase), share)
                        for n, key, share in hits
                    ]
                    continue
                base = [(n, key) for n, key, _ in hits if TEMPLATES[n].base]
                out.append(
                    (
                        doc,
                        len(words),
                        len(base),
                        min((k for _, k in base), default=None),
                        max((k for _, k in base), default=None),
                        ",".join(sorted({TEMPLATES[n].label for n, _ in base})),
                        ",".join(sorted({TEMPLATES[n].label for n, _, _ in hits})),
                        max((min(1.0, s) for _, _, s in hits), default=0.0),
                    )
                )
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema
            )

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    described = FINDINGS if findings else COLUMNS
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in described.split(", ")])
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(scan, described)
