"""Benchmark decontamination by the q-gram lemma and banded alignment.

A benchmark item of m characters that stands in a document with at most k edits
shares at least m - q + 1 - k q of its q-grams with it, all on diagonals (document
place less item place) that differ by k at most. So shared q-grams are counted in
overlapping bands of diagonals, 2 (k + 1) wide at steps of k + 1; a band that meets
the bound is a region, and a banded alignment of the item with the region decides.

Items are taken in blocks of bounded size; each block's q-gram index goes along with
one pass over the documents, which are neither shuffled nor collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import worker_state


@dataclass(frozen=True)
class Leaks:
    """Items of ``min_chars`` normalised characters or more are found with up to
    ``edit_percent`` of their length in edits, by grams of ``q`` characters (5 to 8);
    shorter ones, from ``q`` characters on, as they are and between word borders.

    ``block_chars`` bounds the benchmark text that one pass carries; ``segment`` is
    how many characters of documents are searched at a time, ``hits`` how many shared
    grams are held at a time.
    """

    q: int = 8
    edit_percent: int = 10
    min_chars: int = 40
    block_chars: int = 4_000_000
    segment: int = 1 << 21
    hits: int = 1 << 20

    def edits(self, m: int) -> int:
        """The edit budget, lowered where the lemma would no longer ask for a gram."""
        return 0 if m < self.min_chars else max(0, min(m * self.edit_percent // 100, (m - self.q) // self.q))


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split())


class Index:
    """The q-grams of a block of items: sorted grams with the places they stand at."""

    def __init__(self, items: list[tuple[int, str]], rule: Leaks) -> None:
        self.rule, self.ids, self.texts = rule, [i for i, _ in items], [t for _, t in items]
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.array([rule.edits(len(t)) for t in self.texts], np.int64)
        self.bound = self.m - rule.q + 1 - self.k * rule.q
        grams, item, place = [], [], []
        for i, t in enumerate(self.texts):
            places = np.arange(len(t) - rule.q + 1)
            g = grams_at(quads_of(codes(t)), places, rule.q)
            grams.append(g)
            item.append(np.full(len(g), i, np.int64))
            place.append(np.arange(len(g), dtype=np.int64))
        gram = np.concatenate(grams)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = np.concatenate(item)[order], np.concatenate(place)[order]
        self.grams, self.first, rank, self.times = np.unique(
            gram[order], return_index=True, return_inverse=True, return_counts=True
        )
        # Places of a gram lie together, in order of their items: any range of items is a range here.
        self.key = rank * len(items) + self.item
        self.bits = max(16, min(26, int(len(self.grams)).bit_length() + 4))
        self.known = np.zeros(1 << self.bits, bool)
        self.known[self.slots((self.grams >> np.uint64(32)).astype(np.uint32), self.grams.astype(np.uint32))] = True
        #: Between two documents, so that no band reaches into both.
        self.gap = int(self.m.max() + 6 * (self.k.max() + 1)) + rule.q

    def slots(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        mixed = first * np.uint32(0x9E3779B1) + last * np.uint32(0x85EBCA77)
        return mixed >> np.uint32(32 - self.bits)


def codes(text: str) -> np.ndarray:
    """A byte per character; different characters may share one, which only adds candidates."""
    wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (wide ^ (wide >> np.uint32(7))).astype(np.uint8)


def quads_of(code: np.ndarray) -> np.ndarray:
    """Every run of four characters as one number."""
    wide = code.astype(np.uint32)
    pair = wide[:-1] | (wide[1:] << np.uint32(8))
    return pair[:-2] | (pair[2:] << np.uint32(16))


def grams_at(quads: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """The q-grams at some places: the quads they begin and end with."""
    return (quads[at].astype(np.uint64) << np.uint64(32)) | quads[at + (q - 4)]


def candidates(code: np.ndarray, index: Index) -> np.ndarray:
    """Rows (item, first band, last band) of bands that follow one another, at most
    three, whose counts of shared q-grams meet the lemma's bound."""
    q = index.rule.q
    if len(code) < q:
        return np.empty((0, 3), np.int64)
    quads = quads_of(code)
    at = np.flatnonzero(index.known[index.slots(quads[: len(code) - q + 1], quads[q - 4 :])])
    if not len(at):
        return np.empty((0, 3), np.int64)
    grams = grams_at(quads, at, q)
    found = np.searchsorted(index.grams, grams)
    found[found == len(index.grams)] = 0
    real = index.grams[found] == grams
    at, found = at[real], found[real]
    if not len(at):
        return np.empty((0, 3), np.int64)
    span = len(code) + 2 * index.gap
    every = _hits(index, found, 0, len(index.texts))[1].sum()
    # Items are taken a few at a time if their counts could become many, and the hits of
    # those too: what is held at a time does not grow with how common a gram is.
    few = len(index.texts) if every <= index.rule.hits else max(1, index.rule.hits // span)
    regions = [_regions(at, found, index, lo, min(lo + few, len(index.texts)), span) for lo in range(0, len(index.texts), few)]
    return np.concatenate(regions)


def _hits(index: Index, found: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """For grams by rank: the first of their places in items from ``lo`` to ``hi``, and how many."""
    n = len(index.texts)
    if (lo, hi) == (0, n):
        return index.first[found], index.times[found]
    first = np.searchsorted(index.key, found * n + lo)
    return first, np.searchsorted(index.key, found * n + hi) - first


def _regions(at: np.ndarray, found: np.ndarray, index: Index, lo: int, hi: int, span: int) -> np.ndarray:
    """``candidates`` of the items from ``lo`` to ``hi``, for grams found at some places."""
    first, times = _hits(index, found, lo, hi)
    held = np.flatnonzero(times)
    at, first, times = at[held], first[held], times[held]
    if not len(at):
        return np.empty((0, 3), np.int64)
    ends = np.cumsum(times)
    keys, count = np.empty(0, np.int64), np.empty(0, np.int64)
    start = 0
    while start < len(at):
        begun = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, begun + index.rule.hits, "right")))
        # One row for every place of the gram in an item.
        n = times[start:stop]
        row = np.repeat(first[start:stop] - (ends[start:stop] - n - begun), n) + np.arange(n.sum())
        item = index.item[row]
        low = (np.repeat(at[start:stop], n) - index.place[row] + index.gap) // (index.k[item] + 1)
        low += item * span
        more, times_of = np.unique(low, return_counts=True)
        if start:
            both, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
            summed = np.zeros(len(both), np.int64)
            np.add.at(summed, place, np.concatenate([count, times_of]))
            keys, count = both, summed
        else:
            keys, count = more, times_of
        start = stop
    # Every hit counts in its own band and in the one before, which overlaps it.
    after = np.searchsorted(keys, keys + 1)
    after[after == len(keys)] = 0
    both = count + np.where(keys[after] == keys + 1, count[after], 0)
    # A band with no hit of its own can still meet the bound with the next one's.
    enough = both >= index.bound[keys // span]
    lone = count >= index.bound[keys // span]
    keys = np.unique(np.r_[keys[enough], keys[lone] - 1])
    if not len(keys):
        return np.empty((0, 3), np.int64)
    begins = np.r_[True, keys[1:] != keys[:-1] + 1]
    run = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    first = np.flatnonzero(begins | ((np.arange(len(keys)) - run) % 3 == 0))
    last = np.r_[first[1:], len(keys)] - 1
    return np.stack([keys[first] // span, keys[first] % span, keys[last] % span], axis=1)


def align(item: str, region: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """The best place of ``item`` in ``region``: (edits, start, end), None beyond ``k``.

    Only diagonals from ``low`` to ``high`` (region place less item place) are filled;
    the item is aligned whole, the region's ends are free. Of equal alignments the
    first end wins.
    """
    if (at := region.find(item)) >= 0:
        return 0, at, at + len(item)
    x = np.frombuffer(item.encode("utf-32-le", "surrogatepass"), np.uint32)
    y = np.frombuffer(region.encode("utf-32-le", "surrogatepass"), np.uint32)
    width, far = high - low + 1, 1 << 20
    step = np.arange(width)
    # cost[d]: edits so far on diagonal low + d; start[d]: where that alignment began.
    place = low + step
    cost = np.where((place >= 0) & (place <= len(y)), 0, far)
    start = place.copy()
    padded = np.concatenate([np.full(max(0, -low), 0xFFFFFFFF, np.uint32), y, np.full(len(x) + width, 0xFFFFFFFF, np.uint32)])
    shift = max(0, -low)
    for i, c in enumerate(x):
        here = low + i + shift
        differs = padded[here : here + width] != c
        new, begun = cost + differs, start
        down = np.append(cost[1:], far) + 1  # a character of the item is missing in the region
        less = down < new
        new, begun = np.where(less, down, new), np.where(less, np.append(start[1:], 0), begun)
        new = np.where((place + i + 1 >= 0) & (place + i + 1 <= len(y)), new, far)
        # Characters of the region that the item lacks: the least of cost[e] + d - e for e <= d.
        level = new - step
        least = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == least, step, 0))
        cost, start = least + step, begun[source]
        if cost.min() > k:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(start[best]), low + best + len(x)) if cost[best] <= k else None


def _between_borders(item: str, text: str, left: int, right: int) -> tuple[int, int, int] | None:
    """The first place of ``item`` in ``text`` from ``left`` to ``right``, not inside a word: (0,
    start, end) from ``left`` on."""
    at = text.find(item, left, right)
    while at >= 0:
        end = at + len(item)
        before = at > 0 and text[at - 1].isalnum() and item[0].isalnum()
        behind = end < len(text) and text[end].isalnum() and item[-1].isalnum()
        if not before and not behind:
            return 0, at - left, end - left
        at = text.find(item, at + 1, right)
    return None


def search(texts: list[str], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item number, edits, start, end) of the items in normalised texts."""
    rule, gap, at = index.rule, index.gap, 0
    while at < len(texts):
        # As many texts as fit a segment; a text beyond that is taken in overlapping parts.
        parts, size = [], 0
        while at < len(texts) and (not parts or size + len(texts[at]) <= rule.segment):
            t = texts[at]
            for cut in range(0, max(1, len(t) - gap), rule.segment):
                parts.append((at, cut, t[cut : cut + rule.segment + gap]))
            size += len(t) + gap
            at += 1
        for group in _segments(parts, rule.segment + 2 * gap):
            yield from _search_group(group, index)


def _segments(parts: list, most: int) -> Iterator[list]:
    group, size = [], 0
    for part in parts:
        if group and size + len(part[2]) > most:
            yield group
            group, size = [], 0
        group.append(part)
        size += len(part[2])
    if group:
        yield group


def _search_group(group: list[tuple[int, int, str]], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    gap = index.gap
    starts = np.cumsum([0] + [len(t) + gap for _, _, t in group])
    code = np.zeros(starts[-1], np.uint8)
    for (_, _, t), s in zip(group, starts, strict=False):
        code[s : s + len(t)] = codes(t)
    for item, band, last in candidates(code, index):
        k, m = int(index.k[item]), int(index.m[item])
        low = int(band * (k + 1) - gap)  # the least diagonal
        wide = int((last - band + 2) * (k + 1))
        which = int(np.searchsorted(starts, max(0, low + (wide + m) // 2), "right")) - 1
        which = min(which, len(group) - 1)
        text_no, cut, t = group[which]
        base = low - int(starts[which]) - k
        left = max(0, base)
        right = max(left, base + wide + 2 * k + m)
        if m < index.rule.min_chars:
            found = _between_borders(index.texts[item], t, left, right)
        else:
            found = align(index.texts[item], t[left:right], base - left, base - left + wide + 2 * k, k)
        if found:
            yield text_no, int(item), found[0], cut + left + found[1], cut + left + found[2]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rule: Leaks = Leaks(),
) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``start``, ``end``: the best place of every
    item in every document that holds it, as characters of the normalised text (lower
    case, white space as single spaces).

    Null and empty texts hold nothing; items under ``min_chars`` normalised characters
    are sought as they are and not inside words, those under ``q`` are single words and
    not sought. Items with one text are found
    once each. Ids may be null and come out as they are. Rows that repeat an id and
    hold the same item come out once, with the fewest edits and the first place. Very long
    texts are searched whole, in parts that overlap. Other columns are not read; an empty
    table on either side gives no rows.
    """
    found = _held(docs, items, doc_id, text, item_id, item_text, rule)
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.min(F.struct("edits", "start", "end")).alias("best"))
        .select("doc_id", "item_id", "best.*")
    )


def _held(
    docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, rule: Leaks
) -> DataFrame:
    """All places of items in rows of ``docs``, with ``row``, a hash of the row's text."""
    spark = docs.sparkSession
    wanted = items.select(
        F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text")
    ).filter("text is not null")
    total = wanted.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // rule.block_chars))
    given = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(f"`{text}`").alias("row"),
    )
    schema = "doc_id long, row long, item_id long, edits long, start long, end long"
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = wanted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block) if blocks > 1 else wanted
        texts = [(r["id"], normal(r["text"])) for r in own.collect()]
        texts = [(i, t) for i, t in texts if len(t) >= rule.q]
        if texts:
            found = found.union(given.mapInArrow(_searcher(texts, rule), schema))
    return found


def _searcher(texts: list[tuple[int, str]], rule: Leaks):
    # A worker keeps the index of the block it searched last.
    name = hashlib.sha256(repr((texts, rule)).encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Index] = worker_state("leaks", dict)
        if name not in kept:
            kept.clear()
            kept[name] = Index(texts, rule)
        index = kept[name]
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at in range(0, batch.num_rows, 500):
                normals = [normal(x.as_py()) for x in batch.column(1).slice(at, 500)]
                rows = [(ids[at + t], hashes[at + t], index.ids[i], e, s, z) for t, i, e, s, z in search(normals, index)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "row", "item_id", "edits", "start", "end"],
                )

    return run


def clean(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Leaks = Leaks(),
) -> DataFrame:
    """The rows of ``docs`` whose own text holds no item, whatever their ids: null ids and
    ids that come twice are no reason to drop a row."""
    held = _held(docs, items, doc_id, text, "item_id", "text", rule)
    held = held.select(F.col("doc_id").alias("__held"), F.col("row").alias("__row")).distinct()
    same = docs[f"`{doc_id}`"].cast("long").eqNullSafe(held["__held"])
    own = F.xxhash64(docs[f"`{text}`"]) == held["__row"]
    return docs.join(held, same & own, "left_anti")
