"""Archives, token alignment and spelling variants against brute force and round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from pagetables.llm import alignment, spelling, warc
from pagetables.llm.queries import QUERIES, tokenizer_file
from pagetables.sources.tables import table

BIG = "x" * 300
PAGES = [
    (5, "http://A.example.org/a?b#c", BIG),
    (3, "https://a.example.org/a?b", BIG),
    (None, None, BIG),
    (3, "http://b.example.org/ü x", BIG),
    (9, "u", None),
    (10, "u", "short"),
    (11, "u", "short"),
    (None, "http://h/", "y" * 200),
    (None, "http://h/", "y" * 200),
    (12, "http://h:80/\r\nX: y", BIG + "é"),
    (13, "http://h:80/\r\nX: y", BIG + "é"),
    (14, "http://h", "WARC/1.1\r\n\r\n" * 50),
    (15, "http://long", "long text " * 200_000),
]
SMALL_FILES = warc.Archive(block_lines=2, shard_lines=3, file_bytes=1000, gap_bytes=0)


@pytest.fixture(scope="module")
def archive(spark):
    columns = "page_id long, url string, html string"
    wide = spark.createDataFrame(PAGES, columns).select("*", *(F.lit(1).alias(c) for c in ("digest", "first", "key", "maybe")))
    folder = warc.new_folder(spark)
    captures = warc.write(wide, folder, rule=SMALL_FILES)
    return folder, captures, warc.index(captures, folder, SMALL_FILES)


def test_archive_round_trip(archive):
    folder, captures, shards = archive
    found = warc.fetch(warc.lookup(captures.select("key"), shards, folder), folder, SMALL_FILES).collect()
    assert len(found) == len(PAGES)
    texts = Counter((p, t or "") for p, _, t in PAGES)
    for row in found:
        if row["type"] == "response":
            assert texts[row["page_id"], bytes(row["payload"]).decode()] > 0
            assert row["refers_to"] is None and row["digest"] == hashlib.sha256(row["payload"]).hexdigest()
        else:
            assert row["payload"] is None and row["bytes"] >= 100
    kinds = sorted((str(r["page_id"]), r["type"], r["refers_to"]) for r in found)
    assert kinds == sorted(
        [("5", "revisit", 3), ("3", "response", None), ("3", "response", None), ("None", "revisit", 3)]
        + [(x, "response", None) for x in ("9", "10", "11", "12", "14", "15", "None", "None")]
        + [("13", "revisit", 12)]
    )


def test_archive_files_are_gzip_members_of_records(spark, archive):
    folder, captures, _ = archive
    fs, root = warc.store(folder)
    for name, places in captures.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length")))).collect():
        data = fs.open_input_file(f"{root}/{name}").read()
        assert zlib.decompressobj(31).decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        for offset, length in places:
            fields, http, payload = warc.read_record(data[offset : offset + length])
            assert "\n" not in fields.get("WARC-Target-URI", "") and "x" not in http
            assert fields["WARC-Type"] != "response" or len(payload) == int(http["content-length"])
        assert places[-1][0] + places[-1][1] == len(data)


def test_index_finds_what_a_scan_finds(spark, archive):
    folder, captures, shards = archive
    keys = [")", ")u", "org,example,a)/a?b", "org,example,", "h)/", "zzz", "", "h:80)/\r\nX: y"]
    asked = spark.createDataFrame([(k,) for k in [*keys, ")u", None]], "key string")
    found = Counter(tuple(r) for r in warc.lookup(asked, shards, folder).collect())
    assert found == Counter(tuple(r) for r in captures.filter(F.col("key").isin(keys)).collect())
    assert sum(found.values()) == 10
    assert shards.agg(F.sum("lines")).first()[0] == len(PAGES)


def test_empty_archive(spark, archive):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc.new_folder(spark)
    captures = warc.write(empty, folder)
    shards = warc.index(captures, folder)
    assert (captures.count(), shards.count()) == (0, 0)
    assert warc.fetch(warc.lookup(archive[1].select("key"), shards, folder), folder).count() == 0


def test_shared_payload_of_most_pages(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://h/"), "id").alias("url"),
        F.when(F.col("id") % 3 > 0, F.lit(BIG)).when(F.col("id") % 2 == 0, F.concat(F.lit(BIG), F.floor(F.col("id") / 12))).otherwise(F.concat(F.lit(BIG + "z"), "id")).alias("html"),
    )
    captures = warc.write(pages, warc.new_folder(spark))
    first = {}
    rows = sorted((r["page_id"], r["html"]) for r in pages.collect())
    for page, text in rows:
        first.setdefault(text, page)
    wanted = {p: "response" if first[t] == p else "revisit" for p, t in rows}
    assert {r["page_id"]: r["type"] for r in captures.collect()} == wanted


def aligned(docs):
    """Every text cut on its own, every pair of tokens compared by their bytes."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    # Byte-level letters: bytes without a printable letter follow U+0100 in their order.
    shown = [x for x in range(256) if 33 <= x < 127 or 161 <= x < 173 or x > 173]
    letters = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(shown)))}
    of_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items() if set(t) <= set(letters)}

    def of_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    rows, counts = [], Counter()
    for doc, text in docs:
        cut = []
        for ids, size in ((a.encode(" " + (text or ""), add_special_tokens=False).ids, of_a.get), (b.encode(text or ""), of_b)):
            end, places = 0, []
            for i in ids:
                places.append((i, end, end := end + len(size(i))))
            cut.append((places, b"".join(map(size, ids))))
        if not text or any(whole != (" " + text).encode() for _, whole in cut):
            rows.append((doc, 0, 0, 0, [], ""))
            continue
        (of_text, _), (of_other, _) = cut
        groups, links = [], []
        start = 0
        for end in sorted({e for *_, e in of_text} & {e for *_, e in of_other}):
            one, two = ([t for t in side if start <= t[1] < end] for side in (of_text[:], of_other[:]))
            groups.append(",".join(str(t[0]) for t in one) + "|" + ",".join(str(t[0]) for t in two))
            links += [(x[0], y[0]) for x in one for y in two if max(x[1], y[1]) < min(x[2], y[2])]
            of_text, of_other, start = of_text[len(one) :], of_other[len(two) :], end
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((doc, sum(map(lambda g: g.split("|")[0].count(",") + 1, groups)), sum(g.split("|")[1].count(",") + 1 for g in groups), len(groups), links, digest))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return counts, Counter(
        (d, n_a, n_b, g, len(ls), sum(counts[x] == highest[x[1]] for x in ls), sum(counts[x] for x in ls), h)
        for d, n_a, n_b, g, ls, h in rows
    )


def rule(**more):
    return alignment.Alignment(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"), **more)


@pytest.mark.parametrize("more", [{}, {"part_bytes": 20_000, "most_pairs": 50}, {"part_bytes": 0, "most_pairs": 0}])
def test_alignment_equals_brute_force(spark, more):
    rnd = random.Random(5)
    parts = list("ab  \n\t é中 　\U0001f600'0½ﬁ\x00\x85 é") + ["<s>", "</s>", "<|endoftext|>", " the", " word", "\n\n"]
    parts += ["   ", "▁", "<0x41>", "aaaa", "'s", "</"]
    docs = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(500)]
    docs += [(None, None), (-1, ""), (-2, " "), (-3, "\n"), (-4, "a" * 5000), (-5, "a b" * 3000), (-4, "a" * 5000), (None, "x y")]
    wide = spark.createDataFrame(docs, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("row", "n", "a", "pair", "rare")))
    found, links = alignment.align(wide, rule(**more))
    counts, wanted = aligned(docs)
    assert Counter(tuple(r) for r in found.collect()) == wanted
    assert {(r["a"], r["b"]): r["n"] for r in links.collect()} == counts
    assert [x.count() for x in alignment.align(wide.limit(0), rule(**more))] == [0, 0]


def test_alignment_query(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op12_token_alignment"](spark, SMALL)
    assert Counter(tuple(r) for r in found.collect()) == aligned(docs)[1]


def spelled(words):
    """Every word's neighbours by way of all words with one letter less."""
    less = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less[w[:i] + w[i + 1 :]].add(w)
    near = {}
    for w in words:
        cut = {w[:i] + w[i + 1 :] for i in range(len(w))}
        found = less[w] | (cut & set(words)) | set().union(*(less[c] for c in cut))
        # Two words with a common shorter word may differ in two places.
        near[w] = {x for x in found if x != w and (len(x) != len(w) or sum(a != b for a, b in zip(x, w, strict=True)) == 1)}
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: x for w, x in best.items() if words[x] >= 10 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words)


@pytest.mark.parametrize("more", [{}, {"unit": 16, "pack": 50, "pairs": 64}, {"unit": 5, "pack": 3, "pairs": 7}])
def test_variants_equal_brute_force(spark, more):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(7, 12))) for _ in range(500)]
    words += ["prefixx" + "".join(rnd.choice("abcé") for _ in range(3)) for _ in range(60)]
    words += ["z" * 3000, "z" * 3001, "z" * 1500 + "y" + "z" * 1499, "日本語日本語日本語", "日本語日本語日本誤"]
    counts = {w: int(10 ** rnd.uniform(0.4, 5)) for w in words}
    rows = [(w, n) for w, n in counts.items()] + [(None, 5), ("abababab", None), ("short", 90), ("onlyonce", 1)]
    rows += [("twicegiven", 1), ("twicegiven", 1)]
    counts["twicegiven"] = 2
    wide = spark.createDataFrame(rows, "word string, n long").select("*", *(F.lit(1).alias(c) for c in ("form", "key", "c", "unit", "best")))
    found = spelling.variants(wide, spelling.Spelling(**more))
    assert sorted(tuple(r) for r in found.collect()) == spelled(counts)
    assert spelling.variants(wide.limit(0), spelling.Spelling(**more)).count() == 0


def test_chains_of_forms(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb", "aaabbbb", "aabbbbb", "abbbbbb"]
    words = {w: 3 * 10**i for i, w in enumerate(chain)}
    found = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {r["root"] for r in found} == {chain[-1]} and sorted(tuple(r) for r in found) == spelled(words)


def test_word_counts(spark):
    docs = [(1, "Éclairs éclairs ECLAIRS"), (1, "eclairs"), (None, "eclairs×÷ eclairs"), (2, None), (3, ""), (4, "Eclairs " * 9000)]
    wide = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("word"), F.lit(1).alias("n"))
    assert {tuple(r) for r in spelling.word_counts(wide).collect()} == {("eclairs", 9003)}
    assert spelling.word_counts(wide.limit(0)).count() == 0


def test_spelling_query(spark):
    counts = Counter()
    for doc, text in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    found = QUERIES["op13_spelling_variants"](spark, SMALL)
    assert sorted(tuple(r) for r in found.collect()) == spelled(words)
