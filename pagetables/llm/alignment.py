"""Which tokens of one tokenizer lie on which of another, counted over a corpus.

The bytes of a text (a space before it) are cut by a byte-level tokenizer A and by a
piece tokenizer B. Places where tokens of both end cut the text into groups. A group of
one token each is mostly the same string in both vocabularies: an array from A's ids to
the B id of the same bytes tells so, and such groups are counted in a vector as long as
A's vocabulary. The links of all other groups are counted as pairs of ids; only these go
through the shuffle as pairs.

Both tokenizers cut at a space or a line break after other characters, whatever the
text, so a text's groups are those of its parts there, and parts come again and again. A
worker remembers parts up to a bound in bytes; new ones beyond it are cut for their batch.

Each text's links are written as a bag, so that no text is cut twice. The counts of
all links come back to the bags by broadcast: the vector, the highest
count of each B id, and the most frequent pairs, all of bounded size. Links of rarer pairs
are joined to their counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import worker_state
from pagetables.session import materialize


@dataclass(frozen=True)
class Alignment:
    """``bytes_file`` is A's file (byte-level, JSON), ``pieces_file`` B's; both lie at one
    place on all machines. ``part_bytes`` bounds what a worker remembers, ``most_pairs``
    the pairs that are broadcast."""

    bytes_file: str
    pieces_file: str
    part_bytes: int = 160 << 20
    most_pairs: int = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones
    stand for themselves, the others for the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both tokenizers, the bytes of their ids, and the map from A's ids to B's."""

    def __init__(self, rule: Alignment) -> None:
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        self.a = tokenizers.Tokenizer.from_file(rule.bytes_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=rule.pieces_file)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.space = self.b.piece_to_id("▁")
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        # How ids are written inside a group and at the end of its A or B side.
        self.a_shown = np.array([[b"%d," % i, b"%d|" % i] for i in range(len(self.a_bytes))], object)
        self.b_shown = np.array([[b"%d," % i, b"%d;" % i] for i in range(len(self.b_bytes))], object)
        # Several ids may have the same bytes; a piece goes before a byte's fallback.
        of_bytes = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if x and self.b.is_byte(i)}
        of_bytes |= {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if x and not self.b.is_byte(i)}
        self.same = np.array([of_bytes.get(x, -1) for x in self.a_bytes], np.int64)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_unknown(i) or self.b.is_control(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and B of texts that begin with a space or line break; None where
        one of them does not give back the text's bytes."""
        of_a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        # B adds a space of its own; before a line break it is a token that is taken off.
        of_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for text, a, b in zip(texts, (e.ids for e in of_a), of_b, strict=True):
            b = [self.space] if text == " " else b if text[0] == " " else b[1:]
            whole = text.encode()
            fits = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, b) if fits else None


def tokens_of(rule: Alignment) -> Tokens:
    return worker_state(f"tokens {rule.bytes_file} {rule.pieces_file}", lambda: Tokens(rule))


def _cut(text: str) -> list[str]:
    """The parts of a text with a space before it; each begins with white space.

    Joined they are the text again. A part begins at a space or a line break after a
    character that is no white space: neither tokenizer has a token across such a place.
    """
    if re.search(r"\s\s|^\s|\s\Z", text):
        return re.split(r"(?<=\S)(?=[ \n])", " " + text)
    parts = []
    for mark, line in zip(" " + "\n" * text.count("\n"), text.split("\n"), strict=True):
        first, *rest = line.split(" ")
        parts.append(mark + first)
        parts.extend([" " + w for w in rest])
    return parts


class Parts:
    """Parts of texts with their groups. Part ``i`` has one-to-one groups of equal bytes
    ``plain[plain_to[i]:plain_to[i + 1]]`` (ids of A) and other links
    ``pairs[pairs_to[i]:pairs_to[i + 1]]`` (``a << 32 | b``)."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.fits = array("b")
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.plain, self.plain_to = array("q"), array("q", [0])
        self.pairs, self.pairs_to = array("q"), array("q", [0])
        self.bytes = 0

    def add(self, parts: list[str], tokens: Tokens) -> None:
        """Cut new parts by both tokenizers.

        Those that end in a letter are cut many at a time, as one text: it is cut
        between them anyway.
        """
        parts = sorted(parts, key=lambda p: p[-1].isspace())
        closed = sum(not p[-1].isspace() for p in parts)
        runs = [parts[i : min(i + 256, closed)] for i in range(0, closed, 256)]
        runs += [[p] for p in parts[closed:]]
        ids_a, ids_b, sizes = array("q"), array("q"), array("q")  # sizes: bytes, -1 if a part does not fit
        for run, ids in zip(runs, tokens.encode(["".join(r) for r in runs]), strict=True):
            apart = [(run, ids)] if ids else zip([[p] for p in run], tokens.encode(run) if len(run) > 1 else [None], strict=True)
            for own, got in apart:
                ids_a.extend(got[0] if got else ())
                ids_b.extend(got[1] if got else ())
                sizes.extend([len(p.encode()) if got else -1 for p in own])
        self._take(parts, np.array(ids_a), np.array(ids_b), np.array(sizes), tokens)

    def _take(self, parts: list[str], a: np.ndarray, b: np.ndarray, sizes: np.ndarray, tokens: Tokens) -> None:
        """``a`` and ``b`` are the ids of all ``parts`` on end, which lie side by side in bytes."""
        n, many = len(self.shown), len(parts)
        end_a, end_b = np.cumsum(tokens.a_size[a]), np.cumsum(tokens.b_size[b])
        part_ends = np.cumsum(np.maximum(sizes, 0))
        ends = end_a[np.isin(end_a, end_b, assume_unique=True)]  # of groups
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        last_a, last_b = np.isin(end_a, ends, assume_unique=True), np.isin(end_b, ends, assume_unique=True)
        # One token of B from its group's first one on, for groups of one token each.
        first_b = np.cumsum(in_b) - in_b
        plain = (in_a == 1)[group_a] & (in_b == 1)[group_a]
        plain[plain] = tokens.same[a[plain]] == b[first_b[group_a[plain]]]
        # Tokens of B that end after a token of A begins and begin before it ends.
        low = np.searchsorted(end_b, end_a - tokens.a_size[a], "right")
        high = np.searchsorted(end_b - tokens.b_size[b], end_a, "left")
        links = np.where(plain, 0, high - low)
        of = np.repeat(np.arange(len(a)), links)
        to = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(links) - links, links)
        self.plain.frombytes(a[plain].astype("q").tobytes())
        self.pairs.frombytes((a[of] << 32 | b[to]).astype("q").tobytes())
        # Written on end: each group's tokens of A, then those of B.
        written = np.empty(len(a) + len(b), object)
        written[np.arange(len(a)) + first_b[group_a]] = tokens.a_shown[a, last_a.astype(int)]
        written[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = tokens.b_shown[b, last_b.astype(int)]
        place = lambda x: np.searchsorted(x, part_ends, "right")
        to_a, to_b = place(end_a), place(end_b)
        counted = [np.diff(x, prepend=0) for x in (to_a, to_b, place(ends))]
        for own, more in zip((self.n_a, self.n_b, self.n_groups), counted, strict=True):
            own.frombytes(more.astype("q").tobytes())
        for own, more in ((self.plain_to, plain), (self.pairs_to, links)):
            sums = np.concatenate([[0], np.cumsum(more)])
            own.frombytes((own[-1] + sums[to_a]).astype("q").tobytes())
        self.number.update(zip(parts, range(n, n + many), strict=True))
        words, begin = written.tolist(), 0
        self.fits.frombytes((sizes >= 0).astype("b").tobytes())
        for end in (to_a + to_b).tolist():
            self.shown.append(b"".join(words[begin:end])[:-1])
            begin = end
        self.bytes += 320 * many + 2 * int(part_ends[-1] if many else 0) + 16 * len(a)

    def forget(self, parts: list[str], before: int) -> None:
        """Take off the parts that were added last; ``before`` is what ``bytes`` was."""
        n = len(self.shown) - len(parts)
        for part in parts:
            del self.number[part]
        self.bytes = before
        del self.shown[n:], self.fits[n:], self.n_a[n:], self.n_b[n:], self.n_groups[n:]
        del self.plain_to[n + 1 :], self.pairs_to[n + 1 :]
        del self.plain[self.plain_to[n] :], self.pairs[self.pairs_to[n] :]


def _stretch(values: array, to: array, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the parts ``of``, and for each the place of its part in ``of``."""
    ends = np.array(to)
    n = ends[of + 1] - ends[of]
    part = np.repeat(np.arange(len(of)), n)
    place = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n) + ends[of][part]
    return np.array(values)[place], part


def _lists(keys: np.ndarray, rows: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys ``row * span + value``: where each row's distinct values begin, the values,
    and how often each one comes."""
    keys, n = np.unique(keys, return_counts=True)
    return np.searchsorted(keys, np.arange(rows + 1) * span).astype(np.int32), keys % span, n


def cut(docs: DataFrame, rule: Alignment, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's tokens and groups: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256``; its one-to-one groups of equal bytes ``plain`` (ids of
    A) with ``plain_n``, and its other links ``a``, ``b`` with ``n``."""

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(rule)
        known: Parts = worker_state(f"parts {rule}", Parts)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                own = [_cut(t) if t else [] for t in rows.column(1).to_pylist()]
                new, before = list(set().union(*own).difference(known.number)), known.bytes
                known.add(new, tokens)
                yield pa.RecordBatch.from_arrays([rows.column(0), *_columns(own, known, tokens)], names=names)
                if known.bytes > rule.part_bytes:
                    known.forget(new, before)

    names = "doc_id n_a n_b n_groups n_links groups_sha256 plain plain_n a b n".split()
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "plain array<int>, plain_n array<int>, a array<int>, b array<int>, n array<int>"
    )
    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).mapInArrow(shown, schema)


def _columns(own: list[list[str]], known: Parts, tokens: Tokens) -> list[pa.Array]:
    """All columns but the id, of texts that are cut into known parts."""
    texts = len(own)
    numbers = [np.fromiter(map(known.number.__getitem__, parts), np.int64, len(parts)) for parts in own]
    fits = np.array(known.fits, bool)
    numbers = [x if fits[x].all() else x[:0] for x in numbers]
    flat, sizes = np.concatenate([np.empty(0, np.int64), *numbers]), [len(x) for x in numbers]
    of = np.repeat(np.arange(texts), sizes)
    facts = []
    for fact in (known.n_a, known.n_b, known.n_groups):
        sums = np.concatenate([[0], np.cumsum(np.array(fact)[flat] if len(flat) else flat)])
        ends = np.cumsum(sizes)
        facts.append(sums[ends] - sums[ends - sizes])
    digests = [
        hashlib.sha256(b";".join(map(known.shown.__getitem__, x.tolist()))).hexdigest() if len(x) else "" for x in numbers
    ]
    n_ids, n_pieces = len(tokens.a_size), len(tokens.b_size)
    plain, part = _stretch(known.plain, known.plain_to, flat)
    begin, ids, ids_n = _lists(of[part] * n_ids + plain, texts, n_ids)
    pairs, part = _stretch(known.pairs, known.pairs_to, flat)
    pairs = (pairs >> 32) * n_pieces + (pairs & 0xFFFFFFFF)
    pair_begin, pairs, pairs_n = _lists(of[part] * (n_ids * n_pieces) + pairs, texts, n_ids * n_pieces)
    summed = [np.concatenate([[0], np.cumsum(x)]) for x in (ids_n, pairs_n)]
    facts.append(np.diff(summed[0][begin]) + np.diff(summed[1][pair_begin]))
    lists = [(begin, ids), (begin, ids_n), *((pair_begin, x) for x in (pairs // n_pieces, pairs % n_pieces, pairs_n))]
    return [
        *(pa.array(x, pa.int64()) for x in facts),
        pa.array(digests, pa.string()),
        *(pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for at, x in lists),
    ]


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column on end, and for each the row it is in."""
    sizes = pc.list_value_length(column).to_numpy()
    return column.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(column)), sizes)


def link_counts(texts: DataFrame, rule: Alignment) -> DataFrame:
    """``a``, ``b``, ``n``, ``plain`` of every pair of ids that is linked: how many links
    there are, and whether B's id is the one with the bytes of A's. ``texts`` is of ``cut``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(rule)
        vector = np.zeros(len(tokens.same), np.int64)
        pairs, times, held = [], [], 0
        for batch in batches:
            plain, plain_n, a, b, n = (_flat(c)[0] for c in batch.columns)
            np.add.at(vector, plain, plain_n)
            pairs.append(a << 32 | b)
            times.append(n)
            held += len(a)
            if held > 1 << 21:
                both = _summed(np.concatenate(pairs), np.concatenate(times))
                pairs, times, held = [both[0]], [both[1]], len(both[0])
                if held > 1 << 20:
                    yield rows(*both, tokens)
                    pairs, times, held = [], [], 0
        ids = np.flatnonzero(vector)
        yield rows(ids << 32 | tokens.same[ids], vector[ids], tokens)
        if pairs:
            yield rows(*_summed(np.concatenate(pairs), np.concatenate(times)), tokens)

    def rows(pairs: np.ndarray, times: np.ndarray, tokens: Tokens) -> pa.RecordBatch:
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        arrays = [pa.array(a), pa.array(b), pa.array(times), pa.array(tokens.same[a] == b)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "n", "plain"])

    found = texts.select("plain", "plain_n", "a", "b", "n").mapInArrow(count, "a long, b long, n long, plain boolean")
    return found.groupBy("a", "b", "plain").agg(F.sum("n").alias("n")).select("a", "b", "n", "plain")


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


@dataclass
class _Counts:
    """What every task knows of the counts: of plain pairs by A's id, the highest by B's
    id, and the most frequent other pairs."""

    plain: np.ndarray
    highest: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def of(self, pairs: np.ndarray, same: np.ndarray) -> np.ndarray:
        """Counts of pairs; -1 where they are not known here."""
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        other = np.full(len(pairs), -1)
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            other = np.where(self.pairs[place] == pairs, self.times[place], -1)
        return np.where(same[a] == b, self.plain[a], other)


def _known_counts(links: DataFrame, rule: Alignment) -> _Counts:
    """Gathers arrays as long as the vocabularies, and at most ``most_pairs`` pairs: those
    that occur at least some power of two times."""
    tokens = tokens_of(rule)
    plain, highest = np.zeros(len(tokens.same), np.int64), np.zeros(len(tokens.b_size), np.int64)
    own = links.filter("plain").select("a", "n").toArrow()
    plain[own["a"].to_numpy()] = own["n"].to_numpy()
    top = links.groupBy("b").agg(F.max("n").alias("n")).toArrow()
    highest[top["b"].to_numpy()] = top["n"].to_numpy()
    others = links.filter("not plain")
    sizes = others.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("pairs")).collect()
    bits, held = 64, 0
    for size in sorted(sizes, key=lambda r: -r["bits"]):
        if held + size["pairs"] > rule.most_pairs:
            break
        bits, held = size["bits"], held + size["pairs"]
    often = others.filter(F.length(F.bin("n")) >= bits).select("a", "b", "n").toArrow()
    pairs, times = often["a"].to_numpy() << 32 | often["b"].to_numpy(), often["n"].to_numpy()
    order = np.argsort(pairs)
    return _Counts(plain, highest, pairs[order], times[order])


def align(docs: DataFrame, rule: Alignment, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The texts' alignments and the counts of all linked pairs (see ``link_counts``).

    A row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_links`` (pairs of tokens whose bytes overlap), ``n_best`` (links whose pair is
    the most frequent one of its B id, ties too), ``count_sum`` (the counts of all links'
    pairs) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2``). Texts that are null, empty, or
    that a tokenizer doesn't give back byte by byte have zeros and an empty digest; they
    count for nothing. Rows that come twice count twice; null ids stay null; very long
    texts are cut whole; other columns are not read. An empty table has no rows and no pairs.
    """
    row = F.monotonically_increasing_id().alias("row")
    texts = materialize(cut(docs, rule, doc_id, text).select("*", row), "aligned")
    links = materialize(link_counts(texts, rule), "links")
    counts = docs.sparkSession.sparkContext.broadcast(_known_counts(links, rule))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known = tokens_of(rule), counts.value
        for batch in batches:
            (plain, of_plain), (plain_n, _), (a, of_pair), (b, _), (n, _) = (_flat(c) for c in batch.columns[-5:])
            pairs = a << 32 | b
            times = known.of(pairs, tokens.same)
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for of, to, linked, occurs in (
                (of_plain, tokens.same[plain], plain_n, known.plain[plain]),
                (of_pair, b, n, times),
            ):
                np.add.at(n_best, of, np.where(occurs == known.highest[to], linked, 0))
                np.add.at(count_sum, of, linked * np.maximum(occurs, 0))
            rare = times < 0
            begin = np.searchsorted(of_pair[rare], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(begin), pa.array(x[rare])) for x in (pairs, n)]
            arrays = [*batch.columns[:-5], pa.array(n_best), pa.array(count_sum), *lists]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    facts = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    names = [*facts, "n_best", "count_sum", "rare", "rare_n"]
    kinds = {"groups_sha256": "string", "rare": "array<long>", "rare_n": "array<long>"}
    judged = texts.select(*facts, "plain", "plain_n", "a", "b", "n").mapInArrow(
        judge, ", ".join(f"{x} {kinds.get(x, 'long')}" for x in names)
    )
    judged = materialize(judged, "judged")

    pair = F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair")
    highest = links.groupBy("b").agg(F.max("n").alias("highest"))
    best = (F.col("n") == F.col("highest")).alias("best")
    of_pair = links.filter("not plain").join(highest, "b").select(pair, F.col("n").alias("times"), best)
    rare = judged.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select(
        "row", F.col("x.rare").alias("pair"), F.col("x.rare_n").alias("n")
    )
    more = rare.join(of_pair, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("best_more"),
        F.sum(F.col("n") * F.col("times")).alias("sum_more"),
    )
    whole = judged.join(more, "row", "left")
    aligned = whole.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("best_more", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("sum_more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
    return aligned, links.select("a", "b", "n")
