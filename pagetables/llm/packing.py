"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities.

A document is its token ids and an end id. Whatever is longer than a sequence is cut
at multiples of its length; the pieces are dealt at random into groups of bounded
size, and each group is packed on its own. In a group, pieces go in order of falling
length into the first bin that has room; the tree holds the largest room under each
of its nodes, so the first such bin is found in as many steps as the tree is deep.

Only places move between tasks (document, start, length, checksum), never token ids;
``sequences`` brings ids and places together for those who want the sequences.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import portions
from pagetables.session import materialize


@dataclass(frozen=True)
class Packing:
    """Sequences of ``length`` tokens; ``end`` closes a document. A group has about
    ``group`` pieces. ``most_words`` bounds the words whose ids a worker remembers."""

    length: int = 4096
    end: int = 2
    group: int = 4096
    most_words: int = 1_600_000


#: Words with more characters are encoded anew wherever they come.
_LONGEST = 64
_MARK = "~"


def _words_to_ids(model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some words, one word after the other, and how many each has.

    Words are encoded many at a time with a mark between. Where marks are not found
    again as often as they were set, each word of that stretch is encoded on its own.
    """
    mark = model.encode(_MARK, add_special_tokens=False).ids
    own, many = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for at in range(0, len(words), 256):
        some = words[at : at + 256]
        ids = np.array(model.encode_batch_fast([f" {_MARK} ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
        marks = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else []
        if len(marks) == len(some) - 1:
            own.append(np.delete(ids, marks))
            many.append(np.diff(np.r_[-1, marks, len(ids)]).astype(np.int64) - 1)
        else:
            each = [e.ids for e in model.encode_batch_fast(some, add_special_tokens=False)]
            own += [np.array(ids, np.uint32) for ids in each]
            many.append(np.array([len(ids) for ids in each], np.int64))
    return np.concatenate(own), np.concatenate(many)


def _gathered(values: np.ndarray, start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``many`` values from each ``start`` on, one stretch after the other."""
    return values[np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())]


def encoder(tokenizer: str, rule: Packing) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """A function from texts to their ids, equal to encoding each text on its own.

    The tokenizer must drop white space and never merge across it, as those with word
    ends do: then a text's ids are those of its parts between spaces, and parts come
    again and again. What is remembered hangs on the tokenizers library, since
    functions travel by value and would begin anew with every task.
    """
    import tokenizers

    # Spark runs a worker per core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = tokenizers.__dict__.setdefault("_ids_of_words", {})
    if tokenizer not in kept:
        # The number of each word; word n has the ids from at[n] to at[n + 1].
        nothing = {"number": {}, "ids": np.empty(0, np.uint32), "at": np.zeros(1, np.int64)}
        kept[tokenizer] = {"model": tokenizers.Tokenizer.from_file(tokenizer), **nothing}
    held = kept[tokenizer]

    def encode(texts: pa.Array) -> Iterator[np.ndarray]:
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        words, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        number = np.fromiter(map(held["number"].get, words, repeat(-1)), np.int64, len(words))
        # Words with a mark stand together, so that few others share a stretch with them.
        new = np.array(sorted(np.flatnonzero(number < 0).tolist(), key=lambda n: _MARK in words[n]), np.int64)
        fresh, many = _words_to_ids(held["model"], [words[n] for n in new])
        old = np.flatnonzero(number >= 0)
        start, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        size[old], size[new] = np.diff(held["at"])[number[old]], many
        known = _gathered(held["ids"], held["at"][number[old]], size[old])
        start[old], start[new] = np.cumsum(size[old]) - size[old], len(known) + np.cumsum(many) - many
        room = max(0, rule.most_words - len(held["number"]))
        keep = [k for k, n in enumerate(new.tolist()) if len(words[n]) <= _LONGEST][:room]
        if keep:
            held["number"].update(zip((words[n] for n in new[keep]), range(len(held["at"]) - 1, rule.most_words)))
            held["ids"] = np.r_[held["ids"], _gathered(fresh, np.cumsum(many)[keep] - many[keep], many[keep])]
            held["at"] = np.r_[held["at"], held["at"][-1] + np.cumsum(many[keep])]
        own = np.r_[known, fresh]
        bounds = cut.offsets.to_numpy()
        bounds = bounds - bounds[0]
        for first in range(0, len(cut), 500):
            some = bounds[first : first + 501]
            here = place[some[0] : some[-1]]
            ids = _gathered(own, start[here], size[here])
            ends = np.r_[0, np.cumsum(size[here])][some - some[0]].tolist()
            yield from map(ids.__getitem__, map(slice, ends[:-1], ends[1:]))

    return encode


def _pieces_of(ids: np.ndarray, rule: Packing) -> Iterator[tuple[int, np.ndarray]]:
    whole = np.append(ids, np.uint32(rule.end)).astype("<u4")
    for start in range(0, len(whole), rule.length):
        yield start, whole[start : start + rule.length]


def pieces(
    docs: DataFrame, tokenizer: str, doc_id: str, text: str, rule: Packing = Packing(), with_ids: bool = False
) -> DataFrame:
    """``doc_id``, ``row`` (a hash of the text), ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens`` of every piece; ``ids`` too if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, rule)
        for batch in batches:
            for part in portions(batch, 10_000, 1 << 22):
                rows, texts = [], part.column(1)
                given = zip(part.column(0).to_pylist(), part.column(2).to_pylist(), encode(texts), strict=True)
                for doc, row, ids in given:
                    for start, piece in _pieces_of(ids, rule):
                        crc = zlib.crc32(piece.tobytes())
                        rows.append((doc, row, start, len(piece), crc, len(ids) + 1, piece if with_ids else None))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in columns[6]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    fields = ["doc_id long", "row long", "start long", "length long", "ids_crc32 long", "doc_tokens long"]
    schema = ", ".join(fields + ["ids array<int>"] * with_ids)
    names = [x.split()[0] for x in schema.split(", ")]
    given = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.coalesce(f"`{text}`", F.lit(""))).alias("row"),
    )
    return given.mapInArrow(cut, schema)


class Bins:
    """Bins of one capacity; a tournament tree finds the first with enough room."""

    def __init__(self, capacity: int, most: int) -> None:
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """Put a piece into the first bin with room for it; the bin's number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        bin_number = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin_number


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, which come in order of falling length."""
    bins, used = Bins(capacity, len(lengths)), {}
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        numbers[i] = b = bins.put(size)
        offsets[i] = used.get(b, 0)
        used[b] = offsets[i] + size
    return numbers, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Packing = Packing(),
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``.

    A null text counts as empty; an empty document is its end id alone. Rows without
    an id and rows that come twice are packed like any other, a row each. Pieces of
    equal length are taken by document, text and start; pieces equal in all of these
    are exchangeable, so a task that runs again packs as it did before.
    """
    cut = materialize(pieces(docs, tokenizer, doc_id, text, rule), "pieces")
    groups = max(1, -(-cut.count() // rule.group))
    # Drawn per row of a written table, so that a hot document or text is spread too.
    number = F.floor(F.rand(7) * groups)

    def fill(block: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"), ("start", "ascending")]
        block = block.sort_by(order)
        bins, offsets = first_fit_decreasing(block["length"].to_numpy(), rule.length)
        block = block.append_column("sequence_id", pa.array((block["group"].to_numpy() << 32) + bins))
        return block.append_column("offset", pa.array(offsets)).select(columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = ", ".join(f"{c} long" for c in columns)
    return cut.withColumn("group", number).groupBy("group").applyInArrow(fill, schema)


def sequences(
    docs: DataFrame,
    packed: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Packing = Packing(),
) -> DataFrame:
    """``sequence_id`` and ``ids``: the token ids of every sequence, without padding.

    Ids must be unique and not null here: they tell which text a place belongs to.
    """
    own = pieces(docs, tokenizer, doc_id, text, rule, with_ids=True).select("doc_id", "start", "ids")
    placed = own.join(packed.select("doc_id", "start", "sequence_id", "offset"), ["doc_id", "start"])
    in_order = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return in_order.select("sequence_id", F.flatten("parts.ids").alias("ids"))
