"""The corpus operators: SQL, brute force, and rows that are out of the ordinary."""

import random
import zlib
from itertools import combinations

import numpy as np
import oracle
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from pagetables.llm import (
    chat_format,
    decontam,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    quality_rules,
    sharding,
    span_dedup,
    url_filter,
)
from pagetables.llm.queries import ORACLES, QUERIES, tokenizer_file
from pagetables.plans.registry import PLANS, Plan
from pagetables.sources.tables import table

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "One line. And another one that says a little more than that.", "en", "a", 3),
    (4, "One line. And another one that says a little more than that.", "en", "a", 3),
    (5, "One line. And another one that says a little more than that.", "en", None, 3),
    (None, "No id here, but a text that is long enough for the quality rules.", None, "b", 1),
    (6, LONG, "en", "b", len(LONG)),
    (7, "\\ <|im_end|> ümläut 'x' \U0001f600 ", "de", "b", 9),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name, monkeypatch):
    monkeypatch.setitem(PLANS, name, Plan(name, QUERIES[name], ORACLES[name]))
    assert oracle.difference(spark, oracle.database(SMALL), SMALL, name) is None


OPERATORS = {
    "quality": lambda d: quality_rules.judge(d),
    "quality_clean": lambda d: quality_rules.clean(d),
    "lines": lambda d: line_dedup.dedup(d, host="source"),
    "lines_clean": lambda d: line_dedup.clean(d, host="source"),
    "near": lambda d: near_dedup.near_duplicates(d),
    "near_clean": lambda d: near_dedup.clean(d),
    "licenses": lambda d: license_scan.scan(d),
    "spans": lambda d: span_dedup.dedup(d),
    "shards": lambda d: sharding.assign(d, rule=sharding.Shards(limit=64)),
    "packing": lambda d: packing.pack(d, tokenizer_file()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, odd, name):
    more = "quality line_dedup shard verdict id row cell hash bytes host lines digest rep n maybe __id0 group".split()
    wide = odd.select("*", *(F.lit(i).alias(c) for i, c in enumerate(more)))
    found = OPERATORS[name](wide).count()
    assert found >= {"packing": 9}.get(name, 1)
    if name not in ("quality_clean", "near_clean", "packing"):
        assert found == len(ODD)
    assert OPERATORS[name](odd.limit(0)).count() == 0


def test_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SMALL).columns == odd.columns, name
        assert stage(spark, odd.limit(0), SMALL).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, odd, SMALL).collect()} == {
        1, 2, 3, 4, 6, 7, None
    }


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://X.EXAMPLE.ORG/en/12?q", "http://example.org/es", "http://aorg/", "http://org/",
            "http://a.com/de/x", "http://a.com/fr/", "http://big.casino.net/", "http://a.com?x://y/de/"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    rules = [found[i]["rule"] for i in range(len(urls))]
    assert rules == [None, None, None, "example.org/en/1", "org/", None, "org/", "com/de/", "com/fr/", None, None]
    assert [found[i]["verdict"] for i in (0, 3, 4, 9, 10)] == ["allow", "block", "allow", "block", "allow"]
    assert found[9]["pattern"] == "casino" and (found[3]["host"], found[3]["path"]) == ("x.example.org", "/en/12")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_chats_read_back(spark):
    said = ["", "a\\b", "<|im_end|>\n<|im_start|>user\nx", "</s>[INST] ok [/INST]", "\\<|im_end|>\\", "<<SYS>>\n\n", "ü\U0001f600"]
    rows = [(7, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(said)]
    rows += [(8, 1, "assistant", "b"), (8, 0, "ro\nle", "a"), (9, 0, None, None), (None, 0, "user", "n"), (9, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.format_chats(turns)
    found = {r["conv_id"]: r for r in chat_format.read_back(made, "formatted", "segments").collect()}
    assert [tuple(t) for t in found[7]["turns"]] == [(r[2], r[3]) for r in rows[:7]]
    assert found[7]["loss_text"] == "".join(said[1::2]) and not found[7]["valid"]
    assert found[7]["formatted"].count("<|im_start|>") == len(said) and "[INST]" not in found[7]["formatted"]
    assert [tuple(t) for t in found[8]["turns"]] == [("ro\nle", "a"), ("assistant", "b")]
    assert [tuple(t) for t in found[9]["turns"]] == [("", ""), ("", "")] and len(found) == 4
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_licenses(docs, texts, spark):
    notice = "See <Apache License, Version 2.0>, the MIT\nLicense, mit-license or GNU General Public License version 3."
    extra = spark.createDataFrame([(-1, notice), (-2, "licensed under the gnu general public")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs.select("doc_id", "text").union(extra)).collect()}
    for doc, text in [*texts.items(), (-1, notice)]:
        words = license_scan.words_of(text)
        places = [
            (s, label)
            for phrase, label in license_scan.BASE
            for s in range(len(words))
            if words[s : s + len(phrase.split())] == phrase.split()
        ]
        row = found[doc]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((s for s, _ in places), default=None)
        assert row["last_word"] == max((s for s, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1
    assert found[-1]["n_base"] == 4 and found[-2]["labels"] == ""
    assert {"apache-2.0", "gpl-3.0"} <= set(found[-1]["labels"].split(","))


def test_licenses_of_files_with_several_notices(docs, spark):
    notice = {t.label: t.text for t in license_scan.TEMPLATES}
    files = [
        ("mit-text", "bsd", "apache-2.0"),
        ("mit-text", "bsd", "gpl-3.0"),
        ("mit-text", "bsd", "isc", "mpl-2.0"),
        tuple(notice),
    ]
    rows = [(-1 - i, " filler words between . ".join(notice[label] for label in own)) for i, own in enumerate(files)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan.scan(docs.select("doc_id", "text").union(extra)).filter("doc_id < 0").collect()
    for r in found:
        assert set(files[-1 - r["doc_id"]]) <= set(r["labels"].split(",")), r["doc_id"]


def test_licenses_verify_every_alignment():
    """Version digits are common words here, so they are not indexed and both notices weigh the same."""
    notice = {t.label: t.text for t in license_scan.TEMPLATES}
    seen = {w: 900 for w in ("2", "3", "version", "0", "4")}
    index = license_scan.Index(license_scan.BASE, license_scan.TEMPLATES, 1000, seen, license_scan.Scan())
    names = [t.label for t in license_scan.TEMPLATES]
    own = ("gpl-2.0", "gpl-3.0", "gpl-3.0", "mit-text", "gpl-2.0", "mit-text", "gpl-3.0")
    text, starts = "", []
    for label in own:
        text += "some words of the file itself . "
        starts.append((label, len(license_scan.words_of(text))))
        text += notice[label] + " . "
    found = [(names[i], at) for i, at, _ in index.scan(text)[2]]
    for label in set(own):
        wanted = [at for name, at in starts if name == label]
        at = sorted(at for name, at in found if name == label)
        assert len(at) == len(wanted) and all(abs(a - w) <= 2 for a, w in zip(at, wanted, strict=True)), (label, at)
    # A notice at the very start, and two in a row with nothing between.
    twice = [at for i, at, _ in index.scan(notice["gpl-3.0"] + " " + notice["gpl-3.0"])[2] if names[i] == "gpl-3.0"]
    assert sorted(twice) == [0, 9]


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text).replace("\x0b", " ").replace("\x0c", " ")
    tokens = [w for line in words.split("\n") for part in line.split("\t") for c in part.split("\r") for w in c.split(" ") if w]
    return {tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))} if tokens else set()


def reach(sets, percent=80):
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations([i for i in sets if sets[i]], 2):
        shared = len(sets[a] & sets[b])
        if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(docs, texts, size):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    wanted = reach(sets)
    found = near_dedup.near_duplicates(docs, rule=near_dedup.Similar(shingle=size)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == wanted[r["doc_id"]]) for r in found)


def test_near_copies_of_one_text(spark):
    """A group in which many pairs are just below the threshold, dealt into small blocks."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = {}
    for i in range(90):
        own = list(base)
        for _ in range(rng.randrange(2, 12)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_dedup.near_duplicates(frame, rule=near_dedup.Similar(shingle=2, block=16)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == reach({i: shingles(t, 2) for i, t in texts.items()})


def test_every_text_is_compared_whatever_its_id(spark):
    """A third of the rows has no id; ids come twice with one text and with several."""
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def near(own):
        return " ".join([*own[:-1], "else"])

    a, b, c, d, e = (words(60) for _ in range(5))
    texts = {n: " ".join(x) for n, x in zip("abcde", (a, b, c, d, e), strict=True)}
    rows = [(1, texts["a"]), (2, texts["a"]), (2, texts["c"])]  # a unique text under the id of a copy
    rows += [(None, texts["a"]), (None, near(a)), (None, texts["b"]), (None, texts["b"]), (None, near(b))]
    rows += [(5, texts["d"]), (5, texts["d"]), (5, near(d)), (4, near(d)), (6, texts["e"]), (None, None), (None, ""), (7, ""), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("kept", F.lit(2))
    kept = [(r["doc_id"], r["text"]) for r in near_dedup.clean(frame).collect()]
    b_texts = {texts["b"], near(b)}
    assert len([t for _, t in kept if t in b_texts]) == 1
    others = sorted([r for r in kept if r[1] not in b_texts], key=str)
    assert others == sorted([(1, texts["a"]), (2, texts["c"]), (4, near(d)), (6, texts["e"]), (None, None), (None, ""), (7, ""), (7, "")], key=str)
    judged = near_dedup.near_duplicates(frame).collect()
    assert len(judged) == len(rows)
    found = sorted((str(r["doc_id"]), str(r["component_id"]), r["n_shingles"] > 0) for r in judged)
    wanted = [(1, 1), (2, 1), (2, 2), (None, 1), (None, 1), *[(None, None)] * 3, *[(5, 4)] * 3, (4, 4), (6, 6)]
    empty = [(None, None), (None, None), (7, 7), (7, 7)]
    assert found == sorted([(str(x), str(y), True) for x, y in wanted] + [(str(x), str(y), False) for x, y in empty])
    assert sum(r["kept"] for r in judged) == len(kept)


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_file())
    rows = packing.pack(docs, tokenizer_file(), rule=packing.Packing(group=64)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    ids = packing.sequences(docs, packing.pack(docs, tokenizer_file()), tokenizer_file())
    assert ids.agg(F.sum(F.size("ids"))).first()[0] == sum(r["length"] for r in rows)


def test_first_fit_against_a_plain_scan():
    rng = random.Random(1)
    lengths = np.array(sorted((rng.randint(1, 100) for _ in range(300)), reverse=True))
    room, wanted = [], []
    for size in lengths:
        b = next((i for i, r in enumerate(room) if r >= size), len(room))
        room += [100] * (b == len(room))
        room[b] -= size
        wanted.append(b)
    assert packing.first_fit_decreasing(lengths, 100)[0].tolist() == wanted


def test_shards_fit(spark, docs):
    limit = 20_000
    rows = sharding.assign(docs, rule=sharding.Shards(limit)).select("shard.*").collect()
    total = {}
    for r in rows:
        total.setdefault(r["shard"], []).append(r["bytes"])
    assert all(sum(v) <= limit or len(v) == 1 for v in total.values()) and len(total) > 5
    assert {r["shard"]: r["shard_bytes"] for r in rows} == {k: sum(v) for k, v in total.items()}
    assert not any(a != b and b.startswith(a) for a in total for b in total)
    # One key, one text: only chance can split it.
    same = spark.range(200).select(F.lit(1).alias("doc_id"), F.lit("x" * 100).alias("text"))
    sizes = [r["n"] for r in sharding.assign(same, rule=sharding.Shards(2000)).groupBy("shard.shard").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200 and max(sizes) <= 20


def test_spans(spark):
    rng = random.Random(3)

    def sentence(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)) + "."

    passages = [" ".join(sentence(n) for n in sizes) for sizes in ((20, 20, 4, 12), (30, 30), (9, 8, 20, 18, 3), (26, 27))]
    rows, seen = [], set()
    for i in range(40):
        p = passages[i % 4] if i % 3 == 0 else ""
        gap = " " if i % 2 else "\n"
        rows.append((i, gap.join([sentence(8) + " " + sentence(17), p, sentence(5)])))
    found = {r["doc_id"]: r for r in span_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        p = passages[i % 4] if i % 3 == 0 else ""
        left = text.replace(p, "") if p in seen and p else text
        seen.add(p)
        assert found[i]["text"].split() == left.split(), i
        assert [text[s["start"] : s["end"]] for s in found[i]["spans"]] == ([p] if left != text else [])


def test_spans_inside_sentences(spark):
    """Passages that begin and end in the middle of sentences, one of them longer at some places."""
    rng = random.Random(4)

    def some(n, mark=0):
        own = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 9))) for _ in range(n)]
        return " ".join(w + "." * bool(mark and i % mark == mark - 1) for i, w in enumerate(own))

    core, more = some(70, 31), some(20)
    passages = [some(50), some(60, 40), some(90, 13), core, f"{core} {more}", f"{core} {more}"]
    rows = [(i, f"{some(3 + 5 * (i % 4))} {passages[i % 6]} {some(2 + i % 17)}.") for i in range(24)]
    found = {r["doc_id"]: r for r in span_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        wanted = [passages[i % 6]] if i > 5 or i == 5 else [core] if i == 4 else []
        assert [text[s["start"] : s["end"]] for s in found[i]["spans"]] == wanted, i


def test_spans_remove_their_largest_tables(spark):
    from pagetables.session import children, shared_dir

    text = " ".join(f"word{i}" for i in range(120)) + "."
    before = set(children(spark, shared_dir(spark)))
    rows = [(1, text), (2, f"Before it. {text}"), (3, None)]
    found = span_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in found} == {1: text, 2: "Before it.", 3: ""}
    made = {n.rsplit("-", 1)[0] for n in set(children(spark, shared_dir(spark))) - before}
    assert "places" in made and not made & {"runs", "next-words"}


def test_leaks(spark, docs, texts):
    items = {r["item_id"]: decontam.normal(r["text"]) for r in table(spark, SMALL, "benchmark").collect()}
    wanted = {(d, i) for d, t in texts.items() for i, x in items.items() if x in decontam.normal(t)}
    found = decontam.leaks(docs, table(spark, SMALL, "benchmark")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if not r["edits"]} == wanted
    assert decontam.leaks(docs, table(spark, SMALL, "benchmark").limit(0)).count() == 0


def test_clean_drops_only_rows_that_hold_an_item(spark, docs):
    benchmark = table(spark, SMALL, "benchmark")
    item = benchmark.first()["text"]
    rows = [(None, f"Before it. {item} After it."), (None, "A clean text."), (None, None), (None, ""), (None, "Other."),
            (1, f"Again {item}"), (1, "A clean text of a repeated id."), (2, "A clean text."), (3, item), (3, item), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    kept = [(r["doc_id"], r["text"]) for r in decontam.clean(frame, benchmark).collect()]
    wanted = [r for r in rows if item not in (r[1] or "")]
    assert sorted(kept, key=str) == sorted(wanted, key=str)


def distance(item, text):
    """The fewest edits between ``item`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edited_leaks_against_full_alignment(texts):
    rng, rule = random.Random(2), decontam.Leaks(segment=400)
    pool = [decontam.normal(t) for t in texts.values() if len(t) > 300]
    items = [(i, pool[i][20 : 20 + rng.randint(60, 200)]) for i in range(12)]
    index = decontam.Index(items, rule)
    for i, item in items:
        own, k = list(item), int(index.k[i])
        for _ in range(rng.randint(0, k)):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice(([], ["q"], [own[at], "z"]))
        text = pool[i + 20][:250] + "".join(own) + pool[i + 40][:700]
        found = [r for r in decontam.search([pool[60], text], index) if r[0] == 1 and r[1] == i]
        assert min(r[2] for r in found) == distance(item, text) <= k
        assert all(distance(item, text[r[3] : r[4]]) <= r[2] for r in found)


def test_templated_items_in_bounded_memory(texts):
    """Thousands of items with one stem, and a text full of its words."""
    import tracemalloc

    stem = "which of the following statements about the history of the old town of {} is true according to the text"
    items = [(i, stem.format(f"q{i * 7919 % 100_003}x")) for i in range(14_000)]
    index = decontam.Index(items, decontam.Leaks())
    rng = random.Random(1)
    words = stem.replace("{}", "place").split()
    code = decontam.codes(" ".join(rng.choice(words) for _ in range(3_500)))
    tracemalloc.start()
    decontam.candidates(code, index)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6
    text = f"words of the town, {items[7][1].replace('history', 'hystory')} and more of the text"
    found = {r[1]: r[2] for r in decontam.search([text, "clean"], decontam.Index(items[:20], decontam.Leaks()))}
    assert found[7] == 1 == min(found.values())


def test_hits_a_few_at_a_time(texts):
    """The regions do not depend on how many hits are held at a time."""
    pool = [decontam.normal(t) for t in texts.values() if len(t) > 300]
    items = [(i, pool[i][20:180]) for i in range(12)] + [(12, "a b " * 30)]
    code = decontam.codes(" ".join([*(p[:300] for p in pool[:20]), "a b " * 90]))
    whole = decontam.candidates(code, decontam.Index(items, decontam.Leaks()))
    for hits in (500, 5_000):
        part = decontam.candidates(code, decontam.Index(items, decontam.Leaks(hits=hits)))
        assert part.tolist() == whole.tolist() and len(whole) >= 13


def test_short_items_on_word_borders(spark):
    items = spark.createDataFrame([(1, "What is the capital city of Peru?"), (2, "in Peru now"), (3, "tiny"), (4, None)], "item_id long, text string")
    rows = [(1, "He asked: what is  the capital\ncity of peru? Lima."), (2, "again in Peru nowhere, within peru now"), (3, "tiny"),
            (4, "within peru now, in peru now!"), (5, "What is the capital town of Peru?"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("row", F.lit(1))
    found = {(r["doc_id"], r["item_id"], r["edits"], r["start"], r["end"]) for r in decontam.leaks(docs, items).collect()}
    assert found == {(1, 1, 0, 10, 43), (4, 2, 0, 17, 28)}
    assert {r["doc_id"] for r in decontam.clean(docs, items).collect()} == {2, 3, 5, 6}
    long = spark.createDataFrame([(1, "word " * 500_000 + "what is the capital city of peru?")], "doc_id long, text string")
    assert decontam.leaks(long, items).count() == 1


def test_pipeline_against_its_stages(spark, texts):
    """What the stages keep, by plain rules: no rejected, no second copy, no leak; all ids packed."""
    rows = corpus_pipeline.run(spark, SMALL).collect()
    kept = {r["doc_id"] for r in rows}
    assert kept and kept < set(texts)
    items = [decontam.normal(r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    assert not [d for d in kept for x in items if x in decontam.normal(texts[d])]
    cleaned = {r["doc_id"]: r["text"] for r in quality_rules.clean(table(spark, SMALL, "documents")).collect()}
    groups = reach({i: shingles(t, 5) for i, t in cleaned.items()})
    leaky = {d for d in cleaned for x in items if x in decontam.normal(cleaned[d])}
    assert kept == {d for d in cleaned if groups[d] == d} - leaky


def test_new_words_are_encoded_many_at_a_time():
    import pyarrow as pa
    import tokenizers

    class Counting:
        calls = 0

        def encode(self, text, **more):
            return model.encode(text, **more)

        def encode_batch_fast(self, texts, **more):
            self.calls += len(texts)
            return model.encode_batch_fast(texts, **more)

    model, counting = tokenizers.Tokenizer.from_file(tokenizer_file()), Counting()
    given = ["", "~", "a~b", "\t~́a", "It's", "AÉ́", "ΑΣ", "<|endoftext|>b", "漢字。1234", "x" * 99]
    plain = [f"w{i}" for i in range(990)]
    ids, many = packing._words_to_ids(counting, plain + given)
    wanted = [e.ids for e in model.encode_batch_fast(plain + given, add_special_tokens=False)]
    assert many.tolist() == [len(w) for w in wanted] and ids.tolist() == sum(wanted, [])
    assert counting.calls < 300  # only the stretch with marks of its own goes word by word
    texts = [" ".join(given), None, "\n".join(plain), *given, " ".join(plain[:9] * 3)]
    for most in (5, 10_000):
        tokenizers.__dict__.pop("_ids_of_words", None)
        encode = packing.encoder(tokenizer_file(), packing.Packing(most_words=most))
        for own in (pa.array(texts), pa.array(texts).slice(1, 9), pa.array(texts[:0], pa.string())):
            found = [ids.tolist() for ids in encode(own)]
            assert found == [model.encode(t or "", add_special_tokens=False).ids for t in own.to_pylist()]
        kept = tokenizers._ids_of_words[tokenizer_file()]["number"]
        assert len(kept) <= most and max(map(len, kept)) <= 64


def test_first_places_of_runs(spark, monkeypatch):
    rng = random.Random(6)
    rows = {(rng.choice((rng.randrange(30), 99)), rng.choice((None, 0, 1, -5)) or 7, rng.randrange(3), rng.randrange(40)) for _ in range(300)}
    rows = [(*r, r[3] + 25, 1, 2) for r in rows]
    rows += rows[:20]  # rows equal in id and text are one document
    found = spark.createDataFrame(rows, span_dedup._FOUND)
    by_hash = {}
    for r in rows:
        by_hash.setdefault(r[0], []).append(r)
    wanted = sorted((*r, r[1:] != min(own)[1:]) for own in by_hash.values() if len(own) > 1 for r in own)
    for most in (span_dedup.MOST_PLACES, 20, 0):
        monkeypatch.setattr(span_dedup, "MOST_PLACES", most)
        places = span_dedup._places(found)
        assert sorted(map(tuple, places.collect())) == wanted
        if most > 20:  # rows are moved and sorted once
            plan = places._jdf.queryExecution().executedPlan().toString()
            assert "rank(" in plan and "min(struct" not in plan
