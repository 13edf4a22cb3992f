"""Spelling variants: words one letter apart, found on a bit-sliced position index.

For each place and letter a set of bits tells which words of the vocabulary hold that
letter there, 64 words to a machine word. A word is sought by running over its
letters once and keeping four sets up to date, all words of the index at a time:

* ``same``     words that agree with it so far,
* ``replaced`` words with one other letter so far,
* ``shorter``  words that lack one of its letters, read one place further left,
* ``longer``   words with one more letter, read one place further right.

An index over a whole vocabulary would be run over by each of its words. A word and
its neighbour share two of three parts of their letters, though: the shorter one of
``c`` letters is cut after ``c // 3`` and ``2 * (c // 3)``, and the one edit falls into
one part. So every word goes under the keys of those parts, with its own length and the
length below as ``c``, and each key has an index of its own. A pair that shares several
keys counts under the first only; ``same`` tells that as the letters go by.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.session import materialize


@dataclass(frozen=True)
class Spelling:
    """Words are runs of ``letters`` with A-Z in lower case, of at least ``least_letters``
    code points (3 or more) and ``least_count`` occurrences. A variant's form occurs
    ``times`` as often. ``unit`` bounds the words of one index, ``pack`` and ``pairs``
    what a task handles at a time."""

    letters: str = "[A-Za-zÀ-ÿ]+"
    least_letters: int = 7
    least_count: int = 2
    times: int = 10
    unit: int = 4096
    pack: int = 1 << 15
    pairs: int = 1 << 19


_LOWER = {c: c + 32 for c in range(65, 91)}


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Spelling = Spelling(),
    misspell: int = 0,
) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough.

    With ``misspell``, a run loses a letter where its CRC-32 after ``<doc_id>:`` is a
    multiple of that number: letter ``crc % length``. This plants misspellings to find.
    A null text has no words, a null id is written as nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, found = re.compile(rule.letters), Counter()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter(runs.findall((value or "").translate(_LOWER)))
                begin = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in own.items():
                    if misspell and (h := zlib.crc32(word.encode(), begin)) % misspell == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                    if len(word) >= rule.least_letters:
                        found[word] += n
                if len(found) > 200_000:
                    yield _rows(found)
                    found.clear()
        yield _rows(found)

    def _rows(found: Counter) -> pa.RecordBatch:
        arrays = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

    given = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    counts = given.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= rule.least_count)


def _keys(word: Column, rule: Spelling) -> Column:
    """The keys of a word: (letters of the shorter word, side, shared letters)."""
    size = F.length(word)

    def of(c: Column) -> Column:
        k = F.floor(c / 3).cast("int")
        shared = (
            F.substring(word, F.lit(1), 2 * k),
            F.concat(F.substring(word, F.lit(1), k), F.lit(" "), F.substring(word, size - c + 2 * k + 1, c - 2 * k)),
            F.substring(word, size - c + k + 1, c - k),
        )
        return F.array(
            *(F.struct(c.alias("c"), F.lit(side).alias("side"), s.alias("shared")) for side, s in enumerate(shared))
        )

    own, below = of(size), of(size - 1)
    return F.when(size > rule.least_letters, F.concat(own, below)).otherwise(own)


def _units(words: DataFrame, rule: Spelling) -> DataFrame:
    """The rows of all indexes: ``c``, ``side``, ``unit``, ``asks`` (only asked for, not
    held), ``word``, ``n``.

    A key with too many words is cut into blocks; each word is held by one of them and
    asked for in all. Such keys are few by their definition (65,536 at most), so they
    can be broadcast.
    """
    keyed = words.select("word", "n", F.explode(_keys(F.col("word"), rule)).alias("key"))
    sizes = materialize(keyed.groupBy("key").agg(F.count("*").alias("words")), "key-sizes")
    rows = sizes.agg(F.sum("words")).first()[0] or 0
    most = max(rule.unit, rows >> 16)
    blocks = F.ceil(F.col("words") / most)
    heavy = sizes.filter(F.col("words") > most).select("key", blocks.alias("blocks"))
    dealt = keyed.join(F.broadcast(heavy), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    dealt = dealt.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    unit = F.concat_ws("|", "key.shared", "block")
    return dealt.select("key.c", "key.side", unit.alias("unit"), (F.col("own") != F.col("block")).alias("asks"), "word", "n")


class _Pack:
    """Whole units as arrays: letters as numbers, and for each row its unit."""

    def __init__(self, rows: pa.Table) -> None:
        self.words = rows["word"].to_pylist()
        self.n = rows["n"].to_numpy()
        self.asks = rows["asks"].to_numpy()
        self.c, self.side = rows["c"].to_numpy(), rows["side"].to_numpy()
        # Sorted by unit: a row begins one if it differs from the row before.
        unit = rows["unit"]
        differs = pc.not_equal(unit[1:], unit[:-1]).to_numpy()
        differs = differs | (self.c[1:] != self.c[:-1]) | (self.side[1:] != self.side[:-1])
        self.unit = np.concatenate([[0], np.cumsum(differs)])
        self.size = np.fromiter(map(len, self.words), np.int64, len(self.words))
        points = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        known, codes = np.unique(points, return_inverse=True)
        self.codes, self.letters = codes.reshape(-1), len(known)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def letters_at(self, rows: np.ndarray, place: int) -> np.ndarray:
        return self.codes[self.begin[rows] + place]


def _bits(rows: np.ndarray, places: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Bit sets ``shape`` with the bit of each place set in its row."""
    table = np.zeros(shape, np.uint64)
    np.bitwise_or.at(table, (rows, places >> 6), np.uint64(1) << (places & 63).astype(np.uint64))
    return table


class _Index:
    """Bit sets over the held words of a pack, by place and letter and by length."""

    def __init__(self, pack: _Pack) -> None:
        self.pack = pack
        self.held = np.flatnonzero(~pack.asks)
        self.lanes = (len(self.held) + 63) >> 6
        self.at = np.arange(len(self.held))
        self.sizes = pack.size[self.held]
        units = pack.unit[self.held]
        every = np.arange(pack.unit[-1] + 1 if len(pack.unit) else 0)
        self.first, self.last = np.searchsorted(units, every), np.searchsorted(units, every, "right")

    def letter_sets(self, place: int) -> np.ndarray:
        has = np.flatnonzero(self.sizes > place) if place >= 0 else self.at[:0]
        letters = self.pack.letters_at(self.held[has], place) if len(has) else has
        return _bits(letters, has, (self.pack.letters, self.lanes))

    def of_size(self, size: int) -> np.ndarray:
        has = np.flatnonzero(self.sizes == size)
        return _bits(np.zeros_like(has), has, (1, self.lanes))[0]


def _near(pack: _Pack, index: _Index, asked: np.ndarray, m: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking rows, their neighbours' places in the index) for rows of ``m`` letters."""
    unit = pack.unit[asked]
    first, last = index.first[unit], index.last[unit]
    lane0, lanes = first >> 6, np.where(last > first, ((last - 1) >> 6) - (first >> 6) + 1, 0)
    ends = np.cumsum(lanes)
    start = 0
    while start < len(asked):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        part = np.repeat(np.arange(start, stop), lanes[start:stop])
        lane = lane0[part] + np.arange(len(part)) - np.repeat(ends[start:stop] - lanes[start:stop], lanes[start:stop]) + (
            ends[start - 1] if start else 0
        )
        start = stop
        if not len(part):
            continue
        rows = asked[part]
        near = _run(pack, index, rows, lane, first[part], last[part], m)
        hit = np.flatnonzero(near)
        spread = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(spread)
        yield rows[hit[which]], (lane[hit[which]] << 6) + bit


def _run(
    pack: _Pack, index: _Index, rows: np.ndarray, lane: np.ndarray, first: np.ndarray, last: np.ndarray, m: int
) -> np.ndarray:
    """The bits of the neighbours of ``rows`` among the 64 words of each one's lane."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.clip(first - (lane << 6), 0, 63).astype(np.uint64)
    high = np.clip((lane << 6) + 64 - last, 0, 63).astype(np.uint64)
    same = (full << low) & (full >> high)
    replaced, shorter, longer = np.zeros_like(same), np.zeros_like(same), np.zeros_like(same)
    # Pairs that share an earlier key: the first two parts, or the first and the last.
    c, side = pack.c[rows], pack.side[rows]
    counted_at = np.where(side == 1, 2 * (c // 3), np.where(side == 2, c // 3, -1))
    counted = np.zeros_like(same)
    before, here = index.letter_sets(-1), index.letter_sets(0)
    for i in range(m):
        after = index.letter_sets(i + 1)
        taken = counted_at == i
        if taken.any():
            counted[taken] = same[taken]
        letter = pack.letters_at(rows, i)
        fits = here[letter, lane]
        longer = (longer | same) & after[letter, lane]
        shorter = (shorter & before[letter, lane]) | same
        replaced = (replaced & fits) | (same & ~fits)
        same &= fits
        before, here = here, after
    equal, more = index.of_size(m)[lane], index.of_size(m + 1)[lane]
    near = np.where(c == m, (replaced & equal) | ((longer | same) & more), shorter & index.of_size(m - 1)[lane])
    return near & ~counted


def _answers(rows: pa.Table, answered: int, rule: Spelling) -> pa.RecordBatch:
    """``word``, ``n_near``, ``best_n``, ``best`` of the rows that have neighbours, but
    for the first ``answered`` ones."""
    pack = _Pack(rows)
    index = _Index(pack)
    held_words = [pack.words[i] for i in index.held]
    held_n = pack.n[index.held]
    by_word = np.empty(len(held_words), np.int64)
    by_word[sorted(range(len(held_words)), key=held_words.__getitem__)] = np.arange(len(held_words))
    order = np.lexsort((by_word, -held_n))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    near, best = np.zeros(len(pack.words), np.int64), np.full(len(pack.words), len(order), np.int64)
    for m in np.unique(pack.size).tolist():
        asked = np.flatnonzero(pack.size[answered:] == m) + answered
        for asking, found in _near(pack, index, asked, m, rule.pairs):
            near += np.bincount(asking, minlength=len(near))
            np.minimum.at(best, asking, rank[found])
    has = np.flatnonzero(near)
    top = order[best[has]]
    arrays = [
        pa.array([pack.words[i] for i in has], pa.string()),
        pa.array(near[has], pa.int64()),
        pa.array(held_n[top], pa.int64()),
        pa.array([held_words[i] for i in top], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "best_n", "best"])


def neighbours(words: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: how many words of ``words`` (``word``,
    ``n``; words unique and long enough) are one letter away, and the most frequent one,
    of equally frequent ones the first in code-point order."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, answered = None, 0  # rows to answer, after the held ones of a unit that goes on
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = rows if kept is None else pa.concat_tables([kept, rows])
            if kept.num_rows - answered < rule.pack:
                continue
            whole = _whole(kept)
            if whole:
                yield _answers(kept.slice(0, whole), answered, rule)
                kept, answered = kept.slice(whole), 0
            elif kept["asks"][-1].as_py():
                # One unit alone, and all it holds has come: rows that only ask go by.
                yield _answers(kept, answered, rule)
                kept = kept.filter(pc.invert(kept["asks"]))
                answered = kept.num_rows
        if kept is not None and kept.num_rows > answered:
            yield _answers(kept, answered, rule)

    def _whole(rows: pa.Table) -> int:
        """How many rows come before the last unit."""
        other = np.zeros(rows.num_rows, bool)
        for name in ("c", "side", "unit"):
            other |= pc.not_equal(rows[name], rows[name][-1]).to_numpy()
        return int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0

    units = _units(words, rule).repartition("c", "side", "unit").sortWithinPartitions("c", "side", "unit", "asks")
    found = units.mapInArrow(ask, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return summed.select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))


def _roots(linked: DataFrame, rule: Spelling) -> DataFrame:
    """``word`` and ``root`` of the words that have a form: the last form of the chain.

    Counts grow ``times``-fold at each step, which bounds the chains; every round doubles
    the steps that are taken.
    """
    top = linked.agg(F.max("n")).first()[0]
    steps = linked.filter("form is not null").select("word", F.col("form").alias("root"))
    if top is None:
        return steps
    longest = math.floor(math.log(max(top, 1) / rule.least_count, rule.times) + 1e-9) if top > rule.least_count else 0
    for _ in range(max(0, math.ceil(math.log2(longest))) if longest > 1 else 0):
        steps = materialize(steps, "steps")
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return steps


def variants(words: DataFrame, rule: Spelling = Spelling()) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word.

    ``words`` has ``word`` and ``n``. A repeated word counts with its rows' sum, a null word
    or count is left out, and so are words under ``least_letters`` or ``least_count``. Words are near
    if one letter is inserted, deleted or replaced; the most frequent near word (ties:
    the first in code-point order) is the form if it occurs ``times`` as often. The root is
    the last form on the way from form to form, the word itself if it has none. An empty
    table has no words; other columns are not read.
    """
    clean = words.select(F.col("word"), F.col("n").cast("long").alias("n")).filter("word is not null and n is not null")
    clean = clean.groupBy("word").agg(F.sum("n").alias("n"))
    clean = clean.filter((F.length("word") >= rule.least_letters) & (F.col("n") >= rule.least_count))
    clean = materialize(clean, "vocabulary")
    joined = clean.join(neighbours(clean, rule), "word", "left")
    often = F.col("best_n") >= rule.times * F.col("n")
    linked = materialize(
        joined.select(
            "word",
            F.when(often, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    rooted = linked.join(_roots(linked, rule), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
