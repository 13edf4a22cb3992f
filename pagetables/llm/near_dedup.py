"""MinHash near-dedup with odd sketches.

A text is its set of word shingles. MinHash samples are cut into bands; texts that
agree on a band are candidates. The same samples are folded into an odd sketch, a
bitmap in which every sample flips one bit: the population count of two sketches'
XOR estimates how many samples differ, precisely where similarities are high. Pairs
whose estimate leaves room for the threshold are confirmed on their full sets.

No group is expanded into its pairs. Texts with one and the same set are one class
from the start. In a band's bucket every class is compared with the bucket's first
class only (a star); linked classes are merged. Buckets that still hold classes of
different components are compared in full, block by block, on their sketches: this
is the exact rest, and it is small because stars have merged what is alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import maybe_in
from pagetables.session import materialize

_MASK = (1 << 64) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similar:
    """Shingles of ``shingle`` words; linked from ``percent`` Jaccard similarity on.

    ``bands`` of ``rows`` samples find a pair of similarity 0.8 with probability
    1 - (1 - 0.8 ** rows) ** bands: 0.999995 for 40 bands of 6. The sketch lets a pair
    pass up to ``deviations`` standard deviations beyond the expected difference.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    sketch_bits: int = 512
    deviations: float = 5.0
    block: int = 512

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """The largest XOR count that a pair at the threshold can plausibly have.

        A sample that differs flips a bit on either side, so up to 2 d of the n bits
        are hit, of which about n/2 (1 - exp(-4 d / n)) remain set.
        """
        d = self.samples * (1 - self.percent / 100)
        d += self.deviations * (d * self.percent / 100) ** 0.5
        n = self.sketch_bits
        bits = n / 2 * (1 - np.exp(-4 * d / n))
        return int(bits + self.deviations * (n / 4) ** 0.5 * (bits / (n / 2)))


def shingle_maker(size: int, most_words: int = 500_000) -> Callable[[str | None], np.ndarray]:
    """A function from a text to its sorted distinct shingle hashes.

    A-Z are lower-cased and words lie between white space (space and 09-0D). A text
    with fewer words than a shingle is one shingle of them all; without words it has
    none. Word hashes are kept, up to a bound, since words come again and again.
    """
    import xxhash

    digest = xxhash.xxh3_64_intdigest

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) > most_words:
                self.clear()
            found = self[word] = digest(word)
            return found

    hash_of = Hashes().__getitem__
    weights = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(size)]

    def shingles(text: str | None) -> np.ndarray:
        tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not tokens:
            return np.empty(0, np.uint64)
        if len(tokens) < size:
            return np.array([digest(b" ".join(tokens), seed=len(tokens))], np.uint64)
        h = np.fromiter(map(hash_of, tokens), np.uint64, len(tokens))
        n = len(h) - size + 1
        mixed = np.zeros(n, np.uint64)
        for k, w in enumerate(weights):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + h[k : k + n] * w
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    return shingles


def _signer(rule: Similar) -> Callable[[np.ndarray], tuple[bytes, np.ndarray, np.ndarray]]:
    """A function from a shingle set to its digest, band keys and odd sketch."""
    import xxhash

    seeds = np.random.default_rng(20_240_229)
    k = rule.samples
    factor = (seeds.integers(1, 1 << 32, k, np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
    shift = seeds.integers(0, 1 << 32, k, np.uint64).astype(np.uint32)[:, None]
    band_seed = seeds.integers(1, 1 << 63, (rule.bands, 1), np.uint64)
    row_factor = seeds.integers(1, 1 << 63, (1, rule.rows), np.uint64) | np.uint64(1)
    place_factor = seeds.integers(1, 1 << 63, k, np.uint64) | np.uint64(1)
    slice_length = 4096

    def sign(shingles: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        low = (shingles >> np.uint64(16)).astype(np.uint32)
        least = np.full(k, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), slice_length):
            part = low[None, at : at + slice_length] * factor
            part += shift
            np.minimum(least, part.min(axis=1), out=least)
        wide = least.astype(np.uint64)
        keys = (wide.reshape(rule.bands, rule.rows) + np.uint64(1)) * row_factor
        keys ^= keys >> np.uint64(31)
        keys = (keys * _MIX).sum(axis=1, dtype=np.uint64)[:, None] ^ band_seed
        keys = (keys ^ (keys >> np.uint64(30))) * _MIX
        keys ^= keys >> np.uint64(32)
        place = ((wide + np.uint64(1)) * place_factor * _MIX) >> np.uint64(40)
        flips = np.bincount((place % np.uint64(rule.sketch_bits)).astype(np.int64), minlength=rule.sketch_bits)
        sketch = np.packbits((flips & 1).astype(np.uint8)).view(np.int64)
        return xxhash.xxh3_128_digest(shingles.tobytes()), keys[:, 0].view(np.int64), sketch

    return sign


def hash_of(text: str) -> Column:
    """128 bits that tell texts apart; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))


def signatures(docs: DataFrame, doc_id: str, text: str, rule: Similar = Similar()) -> DataFrame:
    """``id``, ``text_hash`` (see ``hash_of``), ``n_shingles``, ``digest`` of the set, ``bands`` and
    ``sketch``; the last three are null for an empty set. One row per row of ``docs``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, signed = shingle_maker(rule.shingle), _signer(rule)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, digests, bands, sketches = [], [], [], []
                for one in part.column(1):
                    found = make(one.as_py())
                    sizes.append(len(found))
                    d, b, s = signed(found) if len(found) else (None, None, None)
                    digests.append(d)
                    bands.append(b)
                    sketches.append(s)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    names=["id", "text_hash", "n_shingles", "digest", "bands", "sketch"],
                )

    given = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
        hash_of(text).alias("text_hash"),
    )
    schema = "id long, text_hash binary, n_shingles long, digest binary, bands array<bigint>, sketch array<bigint>"
    return given.mapInArrow(sign, schema)


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: ``digest``, its ``first`` row (of least id, none last, then of
    least text hash), ``n``, ``bands``, ``sketch``."""
    signature = F.min_by(F.struct("n_shingles", "bands", "sketch"), "text_hash").alias("s")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "row")).alias("first")
    found = signed.filter("digest is not null").groupBy("digest").agg(first, signature)
    return found.select("digest", "first", F.col("s.n_shingles").alias("n"), "s.bands", "s.sketch")


def xor_bits(left: Column, right: Column) -> Column:
    """The population count of two sketches' XOR."""
    both = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("long"))
    return F.aggregate(both, F.lit(0).cast("long"), lambda total, x: total + x)


def sizes_allow(n: Column, m: Column, rule: Similar) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * rule.percent


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, text: str, rule: Similar) -> DataFrame:
    """Those of the pairs (``a``, ``b``) of classes whose full shingle sets are similar enough.

    Only texts that occur in a pair are moved. A text that is in many pairs is a hot
    key of one join side, which adaptive execution splits.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    texts = materialize(_texts(docs, text, reps, wanted), "pair-texts")
    # Joined by ``a`` last, so that pairs of one text come one after another.
    both = pairs.join(texts.toDF("b", "right"), "b").join(texts.toDF("a", "left"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingle_maker(rule.shingle)
        last: tuple[str, np.ndarray] = ("", np.empty(0, np.uint64))
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                one = left.as_py()
                if one != last[0]:
                    last = (one, make(one))
                mine, other = last[1], make(right.as_py())
                shared = len(np.intersect1d(mine, other, assume_unique=True))
                linked.append(shared * 100 >= (len(mine) + len(other) - shared) * rule.percent)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(linked, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    return both.select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of an edge list (``a``, ``b``).

    Every round links each node to the least label among its neighbours and then to
    that label's own label; labels at least halve their distance to the root of a
    path each round. Rounds are written to the shared folder, which cuts lineage.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = materialize(both.distinct(), f"{label}-edges")
    state = materialize(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"),
        label,
    )
    while True:
        seen = both.join(state.toDF("b", "seen"), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        nearer = state.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "seen").alias("component")
        )
        jumped = nearer.join(
            state.toDF("component", "root"), "component"
        ).select("node", F.least("component", "root").alias("component"), "old")
        state = materialize(jumped, label)
        moved = state.filter("component < old").limit(1).count()
        state = state.select("node", "component")
        if not moved:
            return state


def _texts(docs: DataFrame, text: str, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rep`` and ``text`` of the classes in ``wanted``; hardly any other text is moved, and
    copies of one text are one before they are."""
    hashes = materialize(reps.select("rep", "first.text_hash").join(wanted, "rep"), "wanted-texts")
    given = docs.select(hash_of(text).alias("text_hash"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    held = maybe_in(given, F.col("text_hash"), hashes.select("text_hash"), "maybe").filter("maybe")
    return held.groupBy("text_hash").agg(F.min("text").alias("text")).join(hashes, "text_hash").select("rep", "text")


def _shingle_sets(texts: DataFrame, rule: Similar) -> DataFrame:
    """``rep`` and ``shingles``, the sorted hashes of its text's set as bytes."""

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingle_maker(rule.shingle)
        for batch in batches:
            sets = pa.array([make(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["rep", "shingles"])

    return texts.select("rep", "text").mapInArrow(make_sets, "rep long, shingles binary")


def _meetings(members: DataFrame, rule: Similar) -> DataFrame:
    """``members`` dealt so that every two of a bucket (``key``) meet in one group.

    A bucket is dealt into blocks of about ``rule.block`` members, and every two of its
    blocks (``low``, ``high``) are a group, so no task holds a whole bucket.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / rule.block).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    meets = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return meets.select(*members.columns, "block", low, high)


def _likely_rows(block: pd.DataFrame, rule: Similar) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a group with later rows of other components that sizes and sketches allow."""
    counts = np.array([bin(i).count("1") for i in range(256)], np.uint8)
    sketch = np.array(block["sketch"].tolist(), np.int64).view(np.uint8)
    n, comp, part = block["n"].to_numpy(), block["component"].to_numpy(), block["block"].to_numpy()
    one_block = block["low"].iloc[0] == block["high"].iloc[0]
    for i in range(len(block) - 1):
        rest = slice(i + 1, None)
        fits = comp[rest] != comp[i]
        fits &= np.minimum(n[rest], n[i]) * 100 >= np.maximum(n[rest], n[i]) * rule.percent
        if not one_block:
            fits &= part[rest] != part[i]
        at = np.flatnonzero(fits) + i + 1
        if len(at):
            at = at[counts[sketch[at] ^ sketch[i]].sum(axis=1, dtype=np.int64) <= rule.most_bits]
        if len(at):
            yield i, at


def _in_likely_pairs(members: DataFrame, rule: Similar) -> DataFrame:
    """``key``, ``rep`` of the members whose sketch is near one of another component."""

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(block), bool)
        for i, at in _likely_rows(block, rule):
            seen[i] = True
            seen[at] = True
        return block.loc[seen, ["key", "rep"]]

    return _meetings(members, rule).groupBy("key", "low", "high").applyInPandas(compare, "key long, rep long").distinct()


def _links_in_blocks(members: DataFrame, rule: Similar) -> DataFrame:
    """Links inside buckets, between components, found on sketches and full sets.

    Two members that share several bands are compared in the bucket of the first, and
    what a group has found to be one component is not linked a second time.
    """
    percent = rule.percent

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in block["shingles"]]
        n, bands, rep = block["n"].to_numpy(), np.array(block["bands"].tolist(), np.int64), block["rep"].to_numpy()
        comp, key = block["component"].to_numpy().copy(), block["key"].iloc[0]
        links = []
        for i, at in _likely_rows(block, rule):
            at = at[bands[i, (bands[at] == bands[i]).argmax(axis=1)] == key]
            at = at[comp[at] != comp[i]]
            if not len(at):
                continue
            theirs = np.concatenate([sets[j] for j in at])
            place = np.minimum(np.searchsorted(sets[i], theirs), n[i] - 1)
            ends = np.cumsum(n[at])
            shared = np.add.reduceat((sets[i][place] == theirs).astype(np.int64), np.r_[0, ends[:-1]])
            for j in at[shared * 100 >= (n[i] + n[at] - shared) * percent]:
                if comp[j] != comp[i]:
                    links.append((rep[i], rep[j]))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return _meetings(members, rule).groupBy("key", "low", "high").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Similar = Similar()
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    Documents are linked when their shingle sets are similar enough; a component is
    what links reach, named by its smallest id, and the document of that id is kept.

    Null and empty texts have no shingles, are linked with nothing and kept, each a component
    of its own. Every distinct text is compared, whatever its id: a row without an id, or with one
    that other texts have as well, belongs to the component that its own text is in.
    A component whose rows have no ids has no name, its ``component_id`` is null. One row of
    each component is kept: the one of least id (none comes last), then of least text hash,
    then one of those that repeat it. Other columns are not read; an empty table has no rows.
    """
    judged = _judged(docs, doc_id, text, rule)
    return judged.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, doc_id: str, text: str, rule: Similar) -> DataFrame:
    """``near_duplicates`` with ``text_hash``."""
    row = F.monotonically_increasing_id().alias("row")
    signed = materialize(signatures(docs, doc_id, text, rule).select("*", row), "signatures")
    # Classes are numbered as they are written, once.
    reps = materialize(classes(signed).withColumn("rep", F.monotonically_increasing_id()), "classes")
    banded = reps.select("rep", F.explode("bands").alias("key"))
    least, most = F.min("rep").alias("first"), F.max("rep").alias("last")
    buckets = banded.groupBy("key").agg(least, most, F.count("*").alias("members")).filter("members > 1")
    buckets = materialize(buckets, "buckets")
    # Two members are known by their extremes; only larger buckets are filled again.
    larger = materialize(buckets.filter("members > 2").select("key", "first"), "larger-buckets")
    members = maybe_in(banded, F.col("key"), larger.select("key"), "maybe").filter("maybe")
    members = materialize(members.select("key", "rep").join(larger, "key"), "members")

    sides = reps.select("rep", "n", "sketch")
    stars = members.filter("rep <> first").select("first", "rep")
    stars = stars.union(buckets.filter("members = 2 and first < last").select("first", "last")).distinct()
    stars = stars.join(sides.toDF("first", "n1", "s1"), "first").join(sides.toDF("rep", "n2", "s2"), "rep")
    likely = stars.filter(
        sizes_allow(F.col("n1"), F.col("n2"), rule) & (xor_bits(F.col("s1"), F.col("s2")) <= rule.most_bits)
    )
    pairs = materialize(likely.select(F.col("first").alias("a"), F.col("rep").alias("b")), "stars")
    links = materialize(confirmed(pairs, reps, docs, text, rule), "star-links")
    state = components(links, "star-components")

    # Two members are the star itself; more may hold a pair that no star has tried.
    labelled = members.join(state.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    left = materialize(labelled.join(mixed.filter("lo < hi").select("key"), "key").join(sides, "rep"), "open-buckets")
    near = materialize(_in_likely_pairs(left, rule), "likely-members")
    sets = _shingle_sets(_texts(docs, text, reps, near.select("rep").distinct()), rule)
    sets = materialize(sets.join(reps.select("rep", "bands"), "rep"), "likely-sets")
    tried = left.join(near, ["key", "rep"]).join(sets, "rep")
    more = materialize(_links_in_blocks(tried, rule), "more-links")
    state = components(links.union(more), "components")

    # A class without links is a component by itself. Its first row names it and stays.
    linked = reps.select("rep", "digest", "first").join(state.withColumnRenamed("node", "rep"), "rep", "left")
    named = linked.select("digest", F.coalesce("component", "rep").alias("component"), "first")
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    of_set = named.select("digest", "component").join(heads, "component").select("digest", "head")
    rows = signed.select("row", "id", "text_hash", "n_shingles", "digest").join(of_set, "digest", "left")
    return rows.select(
        "id",
        "text_hash",
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("head.row"), F.lit(True)).alias("kept"),
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Similar = Similar()) -> DataFrame:
    """One row of ``docs`` for each component, and all rows without a shingle.

    A row goes only if its own text was compared and another row of its component is kept.
    Of rows that are equal in id and text one stays, whatever their other columns.
    """
    judged = _judged(docs, doc_id, text, rule)
    per_text = judged.groupBy("id", "text_hash").agg(F.bool_or("kept").alias("stays"), F.count_if(~F.col("kept")).alias("less"))
    # What is not here stays as it is: once and for all, or as often as it comes.
    judged_texts = per_text.filter("less > 0").select(
        F.xxhash64("id", "text_hash").alias("__key"),
        F.col("id").alias("__gone"),
        F.col("text_hash").alias("__gone_hash"),
        F.col("stays").alias("__stays"),
    )
    gone = materialize(judged_texts, "gone")
    own = docs.select("*", F.col(f"`{doc_id}`").cast("long").alias("__id"), hash_of(text).alias("__hash"))
    flagged = maybe_in(own, F.xxhash64("__id", "__hash"), gone.select("__key").distinct(), "__maybe")
    sure = flagged.filter("not __maybe")
    tried = flagged.filter("__maybe").join(
        gone.drop("__key"), F.expr("__hash = __gone_hash and __id <=> __gone"), "left"
    )
    free = tried.filter("__stays is null")
    one = tried.filter("__stays").dropDuplicates(["__id", "__hash"])
    columns = [f"`{c}`" for c in docs.columns]
    return sure.select(*columns).union(free.select(*columns)).union(one.select(*columns))
