"""Substring, byte, line, near-duplicate and vector dedup against brute force, with nulls, blanks, repeats and clashing names."""

import random

import brute
import pytest
from conftest import SCHEMA, same

from priceframe.llm import components, embedding_dedup, line_dedup, minhash_dedup, substring_dedup, suffix_dedup


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def test_substring_words(docs, rows, none):
    same(substring_dedup.digest(docs), brute.substring_words(pairs(rows)))
    assert substring_dedup.digest(none).count() == 0


def test_substring_remove_keeps_columns_and_rows(docs, rows):
    out = substring_dedup.remove(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    kept = {r[0]: r[3] for r in brute.substring_words(pairs(rows)) if r[2]}
    for r in out.where("doc_id in (0, 3, 60)").collect():
        if r.doc_id in kept:
            assert brute.sha(r.text) == kept[r.doc_id]


def test_suffix_bytes(docs, rows, none):
    same(suffix_dedup.digest(docs), brute.substring_bytes(pairs(rows)))
    assert suffix_dedup.digest(none).count() == 0


def test_suffix_small_windows(spark):
    draw = random.Random(2)
    rows = [(k, "".join(draw.choice("ab") for _ in range(draw.randint(0, 120)))) for k in range(40)]
    same(suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string"), window=20, gram=6), brute.substring_bytes(rows, 20))


def test_suffix_hot_anchors_and_many_buckets(spark):
    """Boilerplate with different surroundings, more than a window long in some: hot anchors, several chunks, buckets, slices."""
    draw = random.Random(7)
    make = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    core = make(30)
    rows = [(k, make(draw.randint(0, 60)) + core + make(draw.randint(0, 60))) for k in range(150)]
    rows += [(1000 + k, rows[k][1][: draw.randint(20, 90)] + rows[k + 1][1]) for k in range(60)] + [(2000, rows[3][1]), (2001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute.substring_bytes(rows, 40)
    assert sum(r[2] for r in expected) > 1000
    for hot in (1, 4, 64):
        same(suffix_dedup.digest(df, window=40, gram=8, hot=hot, bucket_bytes=1000, chunk_bytes=1500), expected)


def test_run_index_gives_matching_statistics():
    import numpy as np

    draw = random.Random(3)
    parts = ["".join(draw.choice("ab") for _ in range(draw.randint(5, 60))) for _ in range(12)]
    heads = np.cumsum([0, *(len(x) + 1 for x in parts[:-1])])
    text = "\0".join(parts) + "\0"
    symbols = np.frombuffer(text.encode(), np.uint8).astype(np.uint16)
    index = suffix_dedup.RunIndex(symbols, heads, 100)
    assert index.run_lengths.sum() == len(text) and (index.run_heads[1:] != index.run_heads[:-1]).all() and len(index.run_heads) < len(text)
    got = index.statistics(100)
    for head, part in zip(heads.tolist(), parts, strict=True):
        for i in range(head, head + len(part)):
            end = head + len(part)
            longest = next(n for n in range(end - i, -1, -1) if any(text[j : j + n] == text[i : i + n] for j in range(len(text) - n + 1) if j != i))
            assert min(got[i], end - i) == longest


def test_run_index_keeps_repeats_whose_segments_go_on_alike():
    """Two segments end alike, and those laid behind them begin alike, for a few symbols more than are sorted by. In every order
    of the segments no repeat may get lost."""
    import itertools

    import numpy as np
    import pyarrow as pa

    draw, window = random.Random(5), 20
    make = lambda n: bytes(draw.choice(b"abcdefgh") for _ in range(n))
    for _ in range(10):
        one = make(49)
        segments = [make(3) + one[3:], one, one[:20] + make(29)]
        seen = lambda x: sum(s[i : i + window] == x for s in segments for i in range(30))  # noqa: B023, E731
        expected = {k: [i for i in range(30) if seen(s[i : i + window]) > 1] for k, s in enumerate(segments)}
        assert all(len(x) for x in expected.values())
        for places in itertools.permutations(range(3)):
            messages = [suffix_dedup._pack(k, {0: [(9, k, 0, segments[k])]}, 1) for k in places]
            got = suffix_dedup._index(pa.concat_tables(messages), window)
            marked = {k: [] for k in range(3)}
            for chunk, payload in zip(got.column("chunk").to_pylist(), got.column("payload").to_pylist(), strict=True):
                for digest, first, end in np.frombuffer(payload, "<u8").reshape(-1, 3).tolist():
                    assert digest == chunk
                    marked[chunk] += range(first, end)
            assert marked == expected, places


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Buckets of more than one block, with members between half similar and linked."""
    draw = random.Random(4)
    monkeypatch.setattr(minhash_dedup, "_BLOCK", 3)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(70):
        own = list(base)
        for at in draw.sample(range(80), draw.randint(1, 4)):
            own[at] = f"x{k}y{at}"
        rows.append((k, " ".join(own)))
    same(minhash_dedup.cluster(spark.createDataFrame(rows, "doc_id long, text string")), brute.near_duplicates(rows))


def test_dense_vectors_in_blocks(spark):
    """One dense cell of unequal vectors, repeated ids, other columns; lengths with and without pivots."""
    draw = random.Random(8)
    base = [draw.gauss(0, 1) for _ in range(6)]
    rows = [(k, [x + draw.gauss(0, 0.15) for x in base], 1) for k in range(90)] + [(200 + k, [draw.gauss(0, 1) for _ in range(3)], 1) for k in range(30)]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, label int, cell string, query int")
    same(embedding_dedup.cluster(df, cell_rows=40, part_rows=7), brute.vector_links(rows))
    twice = embedding_dedup.cluster(df.unionByName(df.limit(1)), cell_rows=40, part_rows=7)
    assert twice.count() == len(rows) + 1


def test_near_duplicates(docs, rows, none):
    own = [r for r in pairs(rows) if r[0] is not None]
    expected = brute.near_duplicates(own) + [(3, *next(r for r in brute.near_duplicates(own) if r[0] == 3)[1:])] * 2
    same(minhash_dedup.cluster(docs).where("doc_id is not null"), expected)
    assert [r.kept for r in minhash_dedup.cluster(docs).where("doc_id is null").collect()] == [True, True]
    assert minhash_dedup.cluster(none).count() == 0


def test_near_duplicate_chains(spark):
    """Chains whose ends are not linked themselves, around the threshold."""
    draw = random.Random(9)
    rows, text = [], [f"w{k}" for k in range(60)]
    for k in range(80):
        rows.append((k, " ".join(text)))
        text = list(text)
        text[draw.randrange(60)] = f"x{k}"
    same(minhash_dedup.cluster(spark.createDataFrame(rows, "doc_id long, text string")), brute.near_duplicates(rows))


def test_keep_one_keeps_columns(docs):
    out = minhash_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert out.where("doc_id is null").count() == 2


def test_lines(spark, docs, rows, none):
    out = {(r.doc_id, r.n_lines): r.n_removed for r in line_dedup.digest(docs).collect()}
    assert line_dedup.digest(docs).count() == len(rows)
    assert sum(out.values()) > 0
    texts = {r.doc_id: r.text for r in line_dedup.remove(docs).where("doc_id is not null").collect()}
    lines = [tuple(t.split("\n")) for t in texts.values() if t]
    assert any(len(x) > 5 for x in lines)
    for r in rows:
        if r[0] is not None and (r[1] is None or "\n" not in r[1]):
            assert texts[r[0]] == r[1]
    assert line_dedup.remove(none).count() == 0


def test_lines_keep_the_first_of_equal_chunks(spark):
    body = "\n".join(f"line {k}" for k in range(40))
    rows = [(2, body), (1, body), (None, body), (3, "other\n" + body), (1, body)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.digest(df).collect()}
    assert out[1].n_removed == 0 and out[2].n_removed > 30 and out[3].n_removed > 30 and out[None].n_removed > 30


def test_vectors(spark):
    draw = random.Random(3)
    rows = []
    for k in range(60):
        v = [draw.gauss(0, 1) for _ in range(8)]
        rows.append((3 * k, v, k % 2))
        rows.append((3 * k + 1, [x + draw.gauss(0, 0.12) for x in v], k % 2))
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 1), (502, [2 * x for x in rows[0][1]], 0)]
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 8, 0), (603, [1.0, None] * 4, 0), (604, [float("nan")] * 8, 0), (605, [float("inf")] * 8, 0), (606, rows[0][1], None), (607, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    same(embedding_dedup.cluster(df, cell_rows=5, part_rows=4), brute.vector_links(rows))
    assert embedding_dedup.cluster(df.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(7, 7)]
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
    expected = brute.components({x for e in edges for x in e}, edges)
    assert {r.node: r.root for r in components.components(df, "a", "b", loops=True).collect()} == expected
    assert components.components(df.limit(0), "a", "b").count() == 0


def test_schema_has_clashing_names():
    assert {"chunk", "digest", "found", "state", "row"} <= set(x.split()[0] for x in SCHEMA.split(", "))


def _structured(n: int) -> tuple[str, str]:
    """Two words whose polynomials modulo 2**64 are equal for every odd base: a Thue-Morse word and its complement."""
    bits = [k.bit_count() % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 512, 1024, 2048])
def test_structured_words_are_told_apart(spark, n):
    x, y = _structured(n)
    tail = " ".join(f"w{k}" for k in range(34))
    rows = [(1, f"{x} {tail}"), (2, f"{y} {tail}"), (3, x), (4, y), (5, f"a {x} b {y} c d"), (6, f"a {y} b {x} c d"), (7, f"q\t{x} {tail}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(substring_dedup.digest(df), brute.substring_words(rows))
    same(minhash_dedup.cluster(df), brute.near_duplicates(rows))


def test_repeats_in_several_chunks_and_buckets(spark, docs, rows):
    same(substring_dedup.digest(docs, chunk_bytes=3000), brute.substring_words([(r[0], r[1]) for r in rows]))


def test_suffix_segments_are_found_once_and_only_hot_windows_compared(spark):
    """Segments go with their documents: they hold every window once, and hot anchors give their own windows and no other."""
    import numpy as np
    import pyarrow as pa

    draw = random.Random(11)
    texts = ["".join(draw.choice("abé ") for _ in range(draw.choice([0, 5, 39, 40, 41, 300]))) for _ in range(60)] + [None]
    packed = suffix_dedup._segments_of(pa.array(texts), 40, 8)
    table = pa.table({"text": pa.array(texts), "s": packed})
    data = [(t or "").encode() for t in texts]
    off = np.cumsum([0, *map(len, data)])
    chunk = suffix_dedup._Chunk(table, "s", 40, off)
    windows = [at + i for at, d in zip(off.tolist(), data) for i in range(len(d) - 39)]
    assert [i for a, b in zip(chunk.first.tolist(), chunk.end.tolist()) for i in range(a, b - 39)] == windows
    many = np.unique(chunk.anchor)[::3]
    own = [i for x, a, b in zip(chunk.anchor, chunk.first.tolist(), chunk.end.tolist()) if x in many for i in range(a, b - 39)]
    buf = np.frombuffer(b"".join(data), np.uint8)
    assert [int(i) + at for _, at, starts in chunk.hot_windows(buf, off, many, 40) for i in starts] == own and 0 < len(own) < len(windows)
    plan = suffix_dedup.digest(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow bring" in plan


def test_suffix_planted_passages_go_by_bytes_not_words(spark):
    """Passages of over 50 words in two documents each: all of 400 bytes and more are removed, shorter ones are left."""
    draw = random.Random(4)
    make = lambda n, size: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.choice(size))) for _ in range(n))
    rows, planted = [], {}
    for k in range(60):
        passage = make(draw.randint(51, 70), (4, 6) if k % 2 else (7, 9))
        planted[2 * k] = planted[2 * k + 1] = len(passage)
        rows += [(2 * k + j, make(draw.randint(0, 90), (4, 9)) + "|" + passage + "#" + make(draw.randint(0, 90), (4, 9)) + f"{j}") for j in (0, 1)]
    rows += [(1000 + k, make(100, (4, 9))) for k in range(40)]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] >= n if n >= 400 else (n < 390) <= (got[k] == 0) for k, n in planted.items())
    assert not any(got[1000 + k] for k in range(40)) and {n >= 400 for n in planted.values()} == {True, False}
    same(suffix_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")), brute.substring_bytes(rows))
