"""Substring dedup over sliding spans of sentences and of words.

Two kinds of runs of words are hashed. A text is cut into sentences, and sentences longer
than the least span into parts of that length; from every sentence the shortest run
of ``sentences`` or more that has ``words`` words, and up to every sentence the shortest
such run that ends there. Besides, wherever sentences begin, the run of ``words`` words that
has the least hash of ``words`` neighbouring ones (winnowing): any ``2 * words - 1`` words
hold one, chosen by these words alone. Runs that stand twice or more anywhere are repeats;
the first place keeps its text, and words under a repeat elsewhere are removed.

Such runs cover a repeated passage but for less than ``words`` words at its ends. So
where a removed stretch ends, every run of ``words`` words across that end is hashed too,
at all places of the run that ends there and whose next word two of them share, and counted
likewise. A passage of twice ``words``
words is thus removed to the word, wherever it begins and whichever earlier place has it.

Hashes are counted with partial sums before the shuffle, so a passage that a third
of all documents share is one row per task there; only runs that are likely repeats,
by a bitmap of bounded size, are moved and put in order; those of a hash with very many
places stay where they are and meet its first place in a broadcast. Texts without a repeat stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import maybe_in, portions
from pagetables.session import fresh_path, materialize, remove

# Each shuffle here is a good part of the input, and nothing reads it after its write.
_written = partial(materialize, frees=True)


@dataclass(frozen=True)
class Spans:
    """Runs of ``sentences`` or more with ``words`` words or more."""

    sentences: int = 2
    words: int = 25


_MARKS = frozenset(".!?。！？")
# White space by code point; U+3000 is the last.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


class Words:
    """The words of some texts in one row, and where sentences (or parts) and texts begin.

    A sentence ends at a line's end or at a mark before white space; longer ones are cut
    after ``rule.words`` words.
    """

    def __init__(self, texts: list[str], rule: Spans) -> None:
        self.rule, longest = rule, max(1, rule.words)
        words: list[str] = []
        lines, texts_end = [], [0]
        for text in texts:
            for line in text.split("\n"):
                words += line.split()
                lines.append(len(words))
            texts_end.append(len(words))
        self.words, self.n = words, len(words)
        self.texts = np.array(texts_end, np.int64)
        ends = np.fromiter((w[-1] in _MARKS for w in words), bool, self.n)
        line_ends = np.array(lines, np.int64)
        ends[line_ends[line_ends > 0] - 1] = True
        last = np.flatnonzero(ends) + 1
        first = np.r_[0, last[:-1]] if len(last) else last
        parts = -(-(last - first) // longest)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.begin = np.repeat(first, parts) + step * longest
        self.end = np.minimum(self.begin + longest, np.repeat(last, parts))

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """The number of the text that a word belongs to."""
        return np.searchsorted(self.texts, at, "right") - 1

    def sums(self) -> None:
        import xxhash

        own = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, self.n)
        #: 31 bits of each word's hash, never 0.
        self.short = np.append((own >> np.uint64(33)).astype(np.int32) | np.int32(1), np.int32(0))
        power = np.full(self.n + 1, _BASE, np.uint64)
        self.back = np.full(self.n + 1, _BACK, np.uint64)
        power[0] = self.back[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(self.back, out=self.back)
        self.before = np.r_[np.uint64(0), np.cumsum(own * power[:-1], dtype=np.uint64)]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the words from ``start`` to ``end``, the same wherever they stand."""
        mixed = (self.before[end] - self.before[start]) * self.back[start] + (end - start).astype(np.uint64)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(times)
        return mixed ^ (mixed >> np.uint64(31))

    def sentence_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Shortest runs of enough sentences and words, from and up to every sentence."""
        begin, end, n, k = self.begin, self.end, len(self.begin), self.rule.sentences - 1
        at, text = np.arange(n), self.text_of(self.begin)
        ahead = np.maximum(np.searchsorted(end, begin + self.rule.words), at + k)
        behind = np.minimum(np.searchsorted(begin, end - self.rule.words, "right") - 1, at - k)
        a = np.flatnonzero(ahead < n)
        a = a[text[ahead[a]] == text[a]]
        b = np.flatnonzero(behind >= 0)
        b = b[text[behind[b]] == text[b]]
        return np.r_[begin[a], begin[behind[b]]], np.r_[end[ahead[a]], end[b]]

    def word_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of ``words`` neighbouring runs of ``words`` words, the one of least hash."""
        size = max(1, self.rule.words)
        many = np.maximum(np.diff(self.texts) - size + 1, 0)  # places of a run in each text
        if not many.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ahead = np.cumsum(many + size) - many - size  # each text's places, then a gap
        place = np.repeat(np.arange(len(many)), many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start, slot = self.texts[place] + inside, ahead[place] + inside
        value = np.full(int(ahead[-1] + many[-1] + size), ~np.uint64(0))
        value[slot] = self.hashes(start, start + size)
        least, width = np.arange(len(value)), 1
        while width < size:
            step = min(width, size - width)
            left, right = least[: len(least) - step], least[step:]
            least = np.where(value[right] < value[left], right, left)
            width += step
        # A window lies in its text; of a text with few places, one window has them all.
        window = slot[inside <= np.maximum(many[place] - size, 0)]
        chosen = np.zeros(len(value), bool)
        chosen[least[window]] = True
        start = start[chosen[slot]]
        return start, start + size

    def across(self, text: int, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All runs of ``words`` words across some places (before a word) of one text."""
        size, low, high = max(1, self.rule.words), int(self.texts[text]), int(self.texts[text + 1])
        start = np.unique((np.array(ends, np.int64)[:, None] + low - np.arange(1, size)).ravel())
        start = start[(start >= low) & (start + size <= high)]
        return start, start + size


#: Places of a hash beyond which they are not brought together in one task.
MOST_PLACES = 1 << 16
_FOUND = "hash long, doc_id long, row long, start int, end int, before int, after int"


def _hasher(rule: Spans, rim: bool):
    """From ``doc_id``, ``text``, ``row`` (and ``ends``): the hashed runs of a text (or
    those across the given ends), with the words before and after (0: none)."""
    kinds = [pa.int64()] * 3 + [pa.int32()] * 4
    names = ["hash", "doc_id", "row", "start", "end", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, 500, 1 << 20):
                ids, texts, rows = (batch.column(i).to_pylist() for i in range(3))
                words = Words(texts, rule)
                if not words.n:
                    continue
                words.sums()
                if rim:
                    parts = [words.across(k, own) for k, own in enumerate(batch.column(3).to_pylist())]
                else:
                    parts = [words.sentence_runs(), words.word_runs()]
                start, end = (np.concatenate(p) for p in zip(*parts, strict=True))
                if not len(start):
                    continue
                length = int((end - start).max()) + 1
                key = np.unique(start * length + end - start)
                start, end = key // length, key // length + key % length
                text = words.text_of(start)
                first = words.texts[text]
                columns = [
                    words.hashes(start, end).view(np.int64),
                    np.array(ids, np.int64)[text],
                    np.array(rows, np.int64)[text],
                    start - first,
                    end - first,
                    np.where(start > first, words.short[start - 1], 0),
                    np.where(end < words.texts[text + 1], words.short[end], 0),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return run


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(f"`{text}`", F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(f"`{text}`", F.lit(""))).alias("row"),
    )


def _places(found: DataFrame) -> DataFrame:
    """``found`` where a hash stands twice or more, and whether a place is ``again``: not
    the first one by document, text and position."""
    # Of most runs only the hash is moved; first places are sought among the few that repeat.
    often = _written(found.groupBy("hash").count().filter("count > 1"), "repeated-hashes")
    likely = maybe_in(found, F.col("hash"), often.select("hash"), "maybe").filter("maybe").drop("maybe")
    hot = often.filter(F.col("count") > MOST_PLACES).select("hash")
    some_hot = not hot.isEmpty()
    if some_hot:
        likely = likely.join(F.broadcast(hot), "hash", "left_anti")
    in_order = Window.partitionBy("hash").orderBy("doc_id", "row", "start", "end")
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = likely.select(
        *found.columns, (F.rank().over(in_order) > 1).alias("again"), F.count("*").over(every).alias("n")
    )
    placed = ranked.filter("n > 1").drop("n")
    if not some_hot:
        return placed
    # Hashes with many places are few: first places by partial minima, which are broadcast.
    place = F.struct("doc_id", "row", "start", "end")
    many = found.join(F.broadcast(hot), "hash", "left_semi")
    heads = many.groupBy("hash").agg(F.min(place).alias("head"))
    return placed.union(many.join(F.broadcast(heads), "hash").select(*found.columns, (place != F.col("head")).alias("again")))


def _ends_of(rule: Spans):
    """From ``runs``, the runs removed: for both ends of each removed stretch, the keys of
    the runs that end there and of the outermost of ``words`` words, unless the text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            if not len(flat):
                continue
            own = {n: flat.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "before", "after", "hash")}
            text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())).astype(np.int64) << 32
            start, end = own["start"] + text, own["end"] + text
            order = np.lexsort((end, start))
            own = {n: v[order] for n, v in own.items()}
            start, end = start[order], end[order]
            begins = np.r_[True, start[1:] > np.maximum.accumulate(end)[:-1]]
            first, stretch = np.flatnonzero(begins), np.cumsum(begins) - 1
            plain = end - start == rule.words
            left, right = np.zeros(len(start), bool), np.zeros(len(start), bool)
            for some in (np.ones(len(start), bool), plain):
                left |= some & (start == np.minimum.reduceat(np.where(some, start, 1 << 62), first)[stretch])
                right |= some & (end == np.maximum.reduceat(np.where(some, end, -1), first)[stretch])
            keys = np.r_[own["hash"][left & (own["before"] != 0)], ~own["hash"][right & (own["after"] != 0)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys), pa.int64())], names=["key"])

    return run


def repeated_runs(docs: DataFrame, doc_id: str, text: str, rule: Spans) -> DataFrame:
    """``doc_id``, ``row``, ``runs`` (array of ``start``, ``end`` in words): repeats that are
    not the first."""
    given = _given(docs, doc_id, text).filter("doc_id is not null")
    # The two large tables that nothing reads any more are removed as soon as that is so.
    spark = docs.sparkSession
    runs_path, sides_path = fresh_path(spark, "runs"), fresh_path(spark, "next-words")
    found = _written(given.mapInArrow(_hasher(rule, False), _FOUND), "runs", runs_path)
    places = _written(_places(found), "places")
    remove(spark, runs_path)
    again = places.filter("again")
    run = F.struct("start", "end", "before", "after", "hash")
    removed = again.groupBy("doc_id", "row").agg(F.collect_list(run).alias("runs"))
    ends = _written(removed.select("runs").mapInArrow(_ends_of(rule), "key long").distinct(), "ends")
    # A run that is taken for one at an end only adds hashes, of real repeats or of none.
    sides = F.array(
        F.struct(F.col("hash").alias("key"), F.col("before").alias("word"), F.col("start").alias("at")),
        F.struct(F.expr("~hash").alias("key"), F.col("after").alias("word"), F.col("end").alias("at")),
    )
    sides = places.select("doc_id", "row", F.inline(sides)).filter("word != 0")
    sides = maybe_in(sides, F.col("key"), ends, "maybe").filter("maybe")
    sides = sides.select("doc_id", "row", "at", F.xxhash64("key", "word").alias("next"))
    sides = _written(sides, "next-words", sides_path)
    shared = _written(sides.groupBy("next").count().filter("count > 1").select("next"), "shared-next-words")
    near = maybe_in(sides, F.col("next"), shared, "maybe").filter("maybe")
    near = near.groupBy("doc_id", "row").agg(F.collect_set("at").alias("ends"))
    near = _written(near, "ends-of-texts")
    remove(spark, sides_path)
    wanted = maybe_in(given, F.col("row"), near.select("row"), "maybe").filter("maybe")
    # Rows equal in id and text are one document.
    wanted = wanted.join(near, ["doc_id", "row"]).select("doc_id", "text", "row", "ends")
    rim = wanted.mapInArrow(_hasher(rule, True), _FOUND).drop("before", "after")
    rim = _written(rim, "runs-across")
    every = again.select("doc_id", "row", "start", "end").union(
        _places(rim).filter("again").select("doc_id", "row", "start", "end")
    )
    return every.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Spans = Spans()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_sentences``, ``n_removed`` (sentences,
    or parts of long ones, that go whole), ``spans`` (array of ``start``, ``end``: the
    characters removed, apart from white space around them) and ``text`` without them.

    Null texts count as empty. Rows without an id are never called repeats and do not
    make others so. Rows equal in id and text are one document, and are cleaned alike.
    Other columns are not read.
    """
    gone = _written(repeated_runs(docs, doc_id, text, rule), "covered")
    # Texts without a repeat, the most of them, are not moved.
    flagged = maybe_in(_given(docs, doc_id, text), F.col("row"), gone.select("row"), "maybe")
    none = F.lit(None).cast(gone.schema["runs"].dataType).alias("runs")
    sure = flagged.filter("not maybe").select("doc_id", "text", none)
    tried = flagged.filter("maybe").join(gone, ["doc_id", "row"], "left").select("doc_id", "text", "runs")
    joined = sure.union(tried)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 500, 1 << 20):
                ids, texts = (part.column(i).to_pylist() for i in range(2))
                words = Words(texts, rule)
                covered = pc.fill_null(pc.list_value_length(part.column(2)), 0).to_numpy()
                gone = _covered(words, part.column(2).flatten(), covered)
                total = np.r_[0, np.cumsum(gone)]
                whole = np.r_[0, np.cumsum(total[words.end] - total[words.begin] == words.end - words.begin)]
                first = np.searchsorted(words.begin, words.texts)
                many, removed = np.diff(first).tolist(), np.diff(whole[first]).tolist()
                rows = []
                for k, (doc, one) in enumerate(zip(ids, texts, strict=True)):
                    own = gone[words.texts[k] : words.texts[k + 1]]
                    spans, left = _without(one, own) if covered[k] else ([], one)
                    rows.append((doc, many[k], removed[k], spans, left))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    names = ["doc_id", "n_sentences", "n_removed", "spans", "text"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), span, pa.string()]
    schema = "doc_id long, n_sentences long, n_removed long, spans array<struct<start: bigint, end: bigint>>, text string"
    return joined.select("doc_id", "text", "runs").mapInArrow(cut, schema)


def _covered(words: Words, runs: pa.StructArray, many: np.ndarray) -> np.ndarray:
    """Which words lie under a run; ``many`` of the runs belong to each text."""
    low = np.repeat(words.texts[:-1], many)
    start, end = (runs.field(n).to_numpy(zero_copy_only=False).astype(np.int64) + low for n in ("start", "end"))
    depth = np.bincount(start, minlength=words.n + 1) - np.bincount(end, minlength=words.n + 1)
    return np.cumsum(depth)[:-1] > 0


def _word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters before which words start and end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[np.minimum(codes, len(_SPACE) - 1)]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True]))
    return edge[::2], edge[1::2]


def _without(text: str, gone: np.ndarray) -> tuple[list[dict], str]:
    """The characters that go with some words, as spans, and the text that stays."""
    begin, end = _word_places(text)
    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    spans = [
        {"start": a, "end": z} for a, z in zip(begin[edge[::2]].tolist(), end[edge[1::2] - 1].tolist(), strict=True)
    ]
    left, at = "", 0
    for s in [*spans, {"start": len(text), "end": len(text)}]:
        more = text[at : s["start"]]
        if at:
            # What is left on both sides of a gap keeps one space or one line end between.
            left = left.rstrip(" ")
            if left.endswith("\n") or not left:
                more = more.lstrip(" \n")
            elif not more.startswith("\n"):
                more = " " + more.lstrip(" ") if more.strip() else ""
        left, at = left + more, s["end"]
    return spans, left
