"""Phrase collocations, the filter audit and packing, against plain versions."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER, WORDS
from conftest import same

from priceframe.llm import collocations, filter_audit, packing
from priceframe.llm.queries import TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/word_bpe_49k.json"


def phrases(rows: list[tuple], support: int, most: int = 2000) -> list[tuple]:
    import re

    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            f.update((lang, w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    longer, out = defaultdict(int), defaultdict(list)
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], a)
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] < 80 * a:
            score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return [(lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, own in out.items() for r, (s, a, p, x, y) in enumerate(sorted(own)[:most], 1)]


def prose(seed: int, count: int) -> list[tuple]:
    draw = random.Random(seed)
    word = lambda: draw.choice(["Red", "red", "car", "é", "tea", "ÉA", "x y", "of", "the", "a\x00b", "zz"])
    gap = lambda: draw.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\r\n", "?"])
    rows = [(k, "".join(word() + gap() for _ in range(draw.choice([0, 1, 5, 60]))), draw.choice(["en", "de", None, "und", ""])) for k in range(count)]
    return rows + [(None, "new york city " * 40, "en"), (1, None, "en"), (2, "", None), rows[5], rows[5], (3, "york " * 3000, "en"), (4, " \t.", "fr"), (5, "ab" * 1024 + " " + "ba" * 1024, "en")]


@pytest.mark.parametrize(("parts", "support"), [(1, 30), (4, 30), (60, 7), (7, 2)])
def test_phrases(spark, parts, support):
    """Few large shards, which mine at a support above one, and many small ones."""
    rows = prose(3, 400)
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, lang string, chunk string, n long")
    size = sum(len((r[1] or "").encode()) for r in rows)
    counted = collocations.counts(docs, support=support, chunk_bytes=size // parts + 1, bucket_bytes=size // 3)
    same(collocations.top(collocations.score(counted.cache(), support=support)), phrases(rows, support))
    same(collocations.top(collocations.score(counted, support=support), most=5), phrases(rows, support, 5))


def test_phrase_edges(spark):
    schema = "doc_id long, text string, lang string"
    assert collocations.mine(spark.createDataFrame([], schema)).count() == 0
    assert collocations.mine(spark.createDataFrame([(1, None, None), (2, " . ", "x")], schema)).count() == 0
    rows = [(k, "a b. c d. e f. g h", "en") for k in range(40)]
    same(collocations.mine(spark.createDataFrame(rows, schema), most=3), phrases(rows, 30, 3))


def test_scores_past_64_bits(spark):
    big = 2**60 + 1
    counted = spark.createDataFrame([("x", "", 0, 2 * big), ("x", "a", 1, big), ("x", "b", 1, big), ("x", "a b", 2, big - 1)], "lang string, phrase string, k int, n long")
    row = collocations.score(counted).first()
    assert (row.a, row.l, row.r, row.n, row.score) == (big - 1, big, big, 2 * big, 2_000_000 * (big - 1) // (2 * big))


def audit(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    texts = defaultdict(list)
    for doc, text, _ in rows:
        if doc is not None:
            texts[text or ""].append(doc)
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    parts = defaultdict(list)
    for doc, text, lang in rows:
        t = text or ""
        w = WORDS.findall(t)
        fails = (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), doc is not None and min(texts[t]) < doc)
        parts[lang or ""].append(({f for f, x in zip("ABCDE", fails, strict=True) if x}, doc in good, doc in toxic))
    out = []
    for part, docs in parts.items():
        own, removed = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed[f] += len(gone)
                own.append((part, order, step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r, removed[r[1][r[2] - 1]]) for r in own]
    return out


def test_filter_audit(spark):
    draw = random.Random(4)
    rows = []
    for k in range(300):
        kind = draw.choice([["lorem", "Ipsum"], [f"w{i}" for i in range(900)], ["ABC", "DEF#"], ["a b", "é", "|"]])
        rows.append((k, draw.choice([" ", "\t", "\x0b", " \r\n"]).join(draw.choice(kind) for _ in range(draw.choice([0, 1, 99, 100, 180]))) + draw.choice(["", " "]), draw.choice(["en", "de", None, ""])))
    rows += [(500 + k, rows[draw.randrange(60)][1], "en") for k in range(100)] + [rows[3], rows[3], (7, None, None), (9, "", "en"), (None, rows[8][1], "en"), (None, None, "fr"), (None, "x", "fr")]
    rows += [(900, " ".join(f"v{i}" for i in range(20000)), "long"), (901, " ".join(["Ab"] * 20000), "long")]
    labels = [(k, draw.choice([0, 1, None]), draw.choice([0, 1])) for k in range(0, 320, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (7, 1, 1)]
    docs = spark.createDataFrame([(*r, "d", 0, "p") for r in rows], "doc_id long, text string, lang string, digest string, fails int, part string").repartition(5)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    same(filter_audit.audit(docs, said), audit(rows, labels))
    same(filter_audit.audit(docs, said.limit(0)), audit(rows, []))
    assert filter_audit.audit(docs.limit(0), said).count() == 0


def test_carry_save_popcounts():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 7, 100, 4097):
        words = draw.integers(0, 2**32, n, dtype=np.uint32)
        assert filter_audit.popcounts(words).tolist() == [int((words >> np.uint32(k) & np.uint32(1)).sum()) for k in range(32)]


ODD = [
    None, "", " ", "It's <|endoftext|> we'll<|startoftext|>x 12ab 3.5% ÀÉ é ́x a b c \x1c d\x85e", "ΟΔΟΣ οδος İI", "日本語 テキスト 123", "\U0001f600\U0001f600 !!??", "'s 't're", "x" * 5000, "̈́ ཱི",
    "a\x00b \x0b\x0c", "don 't can' t", "ﬁ Å", "&amp; <b>", "word " * 3000,
]


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    texts = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, r[1]) for k, r in enumerate(rows)] + [(None, "null id"), (None, "null id"), (3, "again")]
    docs = spark.createDataFrame([(*t, "k", 1) for t in texts], "doc_id long, text string, key string, piece int").repartition(4)
    placed = packing.place(docs, VOCABULARY, length=64, group=50, ids=True).collect()
    expected = []
    for doc, text in texts:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        expected += [(doc, k, at, tuple(ids[at : at + 64])) for k, at in enumerate(range(0, len(ids), 64))]
    key = lambda r: (r[0] is None, r)
    assert sorted([(r.doc_id or -1, r.piece, r.start, tuple(r.ids)) for r in placed], key=key) == sorted([(d or -1, *x) for d, *x in expected], key=key)
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in placed)
    bins = defaultdict(list)
    for r in placed:
        bins[r.sequence_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 64
    assert len(bins) <= -(-sum(r.length for r in placed) // 64) * 1.02 + -(-len(placed) // 50)
    packed = packing.sequences(docs, VOCABULARY, length=64, group=50).collect()
    assert sorted(len(r.ids) for r in packed) == sorted(sum(x.length for x in own) for own in bins.values()) and all(sum(r.lengths) == len(r.ids) for r in packed)


def test_packing_empty(spark):
    assert packing.place(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0


def test_parts_encode_like_whole_texts():
    from tokenizers import Tokenizer

    draw, whole = random.Random(9), Tokenizer.from_file(VOCABULARY)
    spaces = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    letters = ["a", "b", "H", "\u0331", "\u0338", "<", "'", ",", "(", "|",  "Zo", "'s", "é", "é", "́", "̧", "1", "½", "ς", "Σ", "ß", "ﬁ", "한", "ᄒ", "ᅡ", "<|endoftext|>", "<|", "|>", "!", "‍", "\x00", "İ"]
    texts = ["".join(draw.choice(letters if draw.random() < 0.8 else spaces) for _ in range(draw.randint(0, 30))) for _ in range(4000)]
    for a, ids, bounds in packing.encode(pa.array(texts), VOCABULARY):
        for k in range(len(bounds) - 1):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == whole.encode(texts[a + k], add_special_tokens=False).ids + [0], texts[a + k]


def test_best_two_fit():
    assert packing.two_fit([], 10) == []
    # greedy is 6 + 3, 2 + 2; the two 2 fit the gap of 4 behind 6 better than 3
    assert sorted(sorted(x) for x in packing._fill([6, 3, 2, 2], 10, True)) == [[0, 2, 3], [1]]
    assert sorted(sorted(x) for x in packing._fill([6, 3, 2, 2], 10, False)) == [[0, 1], [2, 3]]
    draw = random.Random(2)
    for _ in range(40):
        top = draw.choice([20, 30, 50])
        sizes = [draw.randint(1, top) for _ in range(300)]
        bins = packing.two_fit(sizes, 50)
        assert sorted(k for b in bins for k in b) == list(range(300)) and all(sum(sizes[k] for k in b) <= 50 for b in bins)
        assert len(bins) == min(len(packing._fill(sizes, 50, s)) for s in (True, False)) <= -(-sum(sizes) // 50) * 1.1


def test_count_messages_keep_rows_and_are_small():
    """Odd words, languages, lone control bytes and big counts come back as sent; a phrase costs its new words and little more."""
    draw = random.Random(8)
    words = [chr(1), "é", "a\x0eb", "ßt", *("".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 7))) for _ in range(300))]
    texts = [" ".join(draw.choice(words[:60] if k % 3 else words) for _ in range(40)) + (". " if k % 2 else "\t") + "x" for k in range(300)] + ["", " . ", "a " * 700]
    langs = [("en", "und", "日本", "")[k % 4] for k in range(len(texts))]
    shard = pa.table({"id": pa.array(range(len(texts))), "lang": langs, "text": texts, "chunk": pa.array([7] * len(texts), pa.int32())})
    expected = Counter()
    for text, lang in zip(texts, langs, strict=True):
        for piece in text.translate(LOWER).split("."):
            w = piece.replace("\t", " ").split(" ")
            w = [x for x in w if x]
            expected[lang, 0, ""] += len(w)
            expected.update((lang, k, " ".join(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    buckets, own = 5, collocations._Shard(shard)
    cells = np.unique(np.concatenate([collocations._cells(own.hashes(own.all(k), k), buckets) for k in range(1, 5)]))
    named = [(7, b, collocations.anchors._pack((cells[cells >> np.uint64(32) == b] & np.uint64(0xFFFFFFFF)).astype(np.uint32))) for b in range(buckets)]
    answers = pa.table([pa.array(c) for c in zip(*named, strict=True)], schema=collocations.anchors._ANSWER)
    messages = collocations._count(shard, answers, "chunk", 4, buckets).column("payload").to_pylist()
    got = pa.concat_tables([collocations._unstream(p) for p in messages]).to_pylist()
    assert {(r["lang"], r["k"], r["phrase"]): r["n"] for r in got} == {key: n for key, n in expected.items() if n} and len(got) == sum(n > 0 for n in expected.values())
    assert sum(map(len, messages)) < 5 * len(got)
    big = np.array([2**40, 0, 300])
    assert (collocations._from_planes(collocations._planes(big, 8), 3, 8) == big).all()


@pytest.mark.parametrize("support", [2, 30, 300])
def test_reports_keep_cells_and_counts(support):
    tags, count = np.array([3, 9, 2**24 - 1], np.uint32), np.array([1, support, 2])
    one = collocations._pack(tags, count, support, 1)
    table = pa.table([pa.array([4, 4], pa.int32()), pa.array([0, 1], pa.int32()), pa.array([one, collocations._pack(tags[:1], count[:1], support, 1)])], schema=collocations.anchors._MESSAGE)
    answers = {r["chunk"]: collocations.anchors._unpack(r["payload"])[0].tolist() for r in collocations._union(table, support).to_pylist()}
    assert answers == ({0: [3, 9, 2**24 - 1], 1: [3]} if support == 2 else {0: [9]})
