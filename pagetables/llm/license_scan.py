"""License scans: a positional index of licence templates under their rare words.

A template is a licence notice as a run of words, with key phrases it must not lack.
Its words are weighed by inverse document frequency, counted over all documents; the
index holds, for the rarest of them, the templates and places where they stand. A
file looks up every index word it has, and each place found votes for a
template at a relative position (file place less template place). All
positions with enough weight are alignments, whose key phrases are then verified word by
word; each notice found so has a span. A
template that is one phrase is found at every place where the phrase stands.

Two passes over the texts: document frequencies of the licence words (partial counts
per task, one row per word), and the scan. Nothing is shuffled but those counts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases whose places are counted, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


#: Notices as their licences ask for them, shortened to the sentences that tell them apart.
TEMPLATES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2",
             ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license",
             ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license",
             ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("mit-text",
             "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("bsd",
             "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("isc",
             "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)


@dataclass(frozen=True)
class Scan:
    """A template is found where ``least`` of its index words' weight aligns within
    ``slack`` words; ``rare`` words of a template are indexed."""

    rare: int = 6
    least: float = 0.6
    slack: int = 2


def words_of(text: str | None) -> list[str]:
    """A-Z lower-cased; words are runs without ASCII punctuation, space and controls."""
    return WORD.findall(_lower(text or ""))


_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_TO_LOWER)


def frequencies(docs: DataFrame, text: str, vocabulary: frozenset[str]) -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each word of the vocabulary.

    The result has a row per word of the vocabulary, whatever the number of documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for one in batch.column(0):
                seen[""] += 1
                seen.update(vocabulary.intersection(words_of(one.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"]
        )

    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "word string, n long")
    found = {r["word"]: r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found.pop("", 0), found


class Index:
    """Postings of phrases and templates under their rarest words."""

    def __init__(self, base, templates, total: int, seen: dict[str, int], rule: Scan) -> None:
        self.rule, self.templates = rule, templates
        self.phrases = [(tuple(words_of(p)), label) for p, label in base]
        self.texts = texts = [tuple(words_of(t.text)) for t in templates]
        self.needed = [[tuple(words_of(p)) for p in t.phrases] for t in templates]
        every = set().union(*texts, *(p for p, _ in self.phrases))
        self.idf = {w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1 for w in every}

        def rarest(run: tuple[str, ...], n: int) -> list[str]:
            return sorted(set(run), key=lambda w: (-self.idf[w], w))[:n]

        self.anchors: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (run, _) in enumerate(self.phrases):
            # One word finds a phrase, at each place it has in it; the first is enough.
            word = rarest(run, 1)[0]
            self.anchors[word].append((i, run.index(word)))
        self.postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.weight = []
        for i, run in enumerate(texts):
            own = rarest(run, rule.rare)
            self.weight.append(sum(self.idf[w] for w in own))
            for word in own:
                self.postings[word] += [(i, at) for at, w in enumerate(run) if w == word]
        self.words = frozenset(self.anchors) | frozenset(self.postings)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, float]]]:
        """Count of words; (place, phrase) of phrases; (template, place, score) of templates."""
        tokens = words_of(text)
        here = self.words.intersection(tokens)
        if not here:
            return len(tokens), [], []
        places: dict[str, list[int]] = defaultdict(list)
        for at, w in enumerate(tokens):
            if w in here:
                places[w].append(at)
        phrases = []
        for word in here & self.anchors.keys():
            for i, offset in self.anchors[word]:
                run = self.phrases[i][0]
                starts = (at - offset for at in places[word])
                phrases += [(s, i) for s in starts if s >= 0 and tuple(tokens[s : s + len(run)]) == run]
        return len(tokens), sorted(phrases), self._aligned(tokens, places)

    def _aligned(self, tokens: list[str], places: dict[str, list[int]]) -> list[tuple[int, int, float]]:
        rule = self.rule
        held: dict[int, float] = defaultdict(float)
        for word in sorted(self.postings.keys() & places.keys()):
            for i in {i for i, _ in self.postings[word]}:
                held[i] += self.idf[word]
        votes: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for word in self.postings.keys() & places.keys():
            for i, offset in self.postings[word]:
                # Templates whose words in this file cannot weigh enough are not aligned.
                if held[i] >= rule.least * self.weight[i] - 1e-9:
                    votes[i] += [(at - offset, word) for at in places[word]]
        found = []
        for i, own in votes.items():
            # One span per notice, told by where its first key phrase stands.
            notices: dict[int, tuple[float, int]] = {}
            run = self.texts[i]
            for left, weight in self._windows(sorted(own), rule.least * self.weight[i] - 1e-9):
                start = max(0, left)
                region = tokens[start : start + len(run) + 2 * rule.slack + 1]
                stand = [_places(region, phrase) for phrase in self.needed[i]]
                if not all(stand):
                    continue
                # Of a phrase that stands twice there, the place that this alignment means.
                key = start
                if stand:
                    meant = left - start + (_places(run, self.needed[i][0]) or [0])[0]
                    key += min(stand[0], key=lambda at: abs(at - meant))
                if key not in notices or (-weight, start) < (-notices[key][0], notices[key][1]):
                    notices[key] = (weight, start)
            found += [(i, start, min(1.0, weight / self.weight[i])) for weight, start in notices.values()]
        return found

    def _windows(self, votes: list[tuple[int, str]], least: float) -> list[tuple[int, float]]:
        """Positions where different words within ``slack`` weigh enough, and the most there."""
        found: dict[int, float] = {}
        left, inside = 0, Counter()
        for at, word in votes:
            inside[word] += 1
            while votes[left][0] < at - self.rule.slack:
                inside[votes[left][1]] -= 1
                left += 1
            weight = sum(self.idf[w] for w, n in inside.items() if n)
            if weight >= least:
                found[votes[left][0]] = max(weight, found.get(votes[left][0], 0.0))
        return sorted(found.items())


def _places(words: list[str] | tuple[str, ...], phrase: tuple[str, ...]) -> list[int]:
    n = len(phrase)
    return [s for s in range(len(words) - n + 1) if tuple(words[s : s + n]) == phrase]


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    base: tuple[tuple[str, str], ...] = BASE,
    templates: tuple[Template, ...] = TEMPLATES,
    rule: Scan = Scan(),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base`` (places of base
    phrases), ``first_word`` and ``last_word`` (their least and largest start), ``base_labels``,
    ``labels`` (the templates' too; both distinct, sorted, joined by commas), ``score`` (the
    best template's share of aligned weight; 1 for a base phrase, which stands whole; else 0)
    and ``spans`` (array of ``label``, ``word``: where each template or phrase begins).

    Null and empty texts have no words and no labels. Ids may be null or come twice.
    Other columns are not read.
    """
    vocabulary = frozenset().union(*(words_of(t.text) for t in templates), *(words_of(p) for p, _ in base))
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    total, seen = frequencies(given, "text", vocabulary)
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label: string, word: bigint>>"
    )
    return given.mapInArrow(_scanner(base, templates, total, seen, rule), schema)


def _scanner(base, templates, total: int, seen: dict[str, int], rule: Scan) -> Callable:
    span = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), span]
    names = "doc_id n_words n_base first_word last_word base_labels labels score spans".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(base, templates, total, seen, rule)
        for batch in batches:
            rows = []
            for doc, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, phrases, aligned = index.scan(one.as_py())
                own = {index.phrases[i][1] for _, i in phrases}
                more = {templates[i].label for i, _, _ in aligned}
                spans = [{"label": index.phrases[i][1], "word": at} for at, i in phrases]
                spans += [{"label": templates[i].label, "word": at} for i, at, _ in sorted(aligned)]
                starts = [at for at, _ in phrases]
                score = 1.0 if phrases else max((s for _, _, s in aligned), default=0.0)
                rows.append(
                    (doc, n, len(starts), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted(own)), ",".join(sorted(own | more)), score, spans)
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return run
