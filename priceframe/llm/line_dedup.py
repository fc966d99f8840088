"""Line dedup, DataFrame functions only: content-defined chunks of lines, repeated ones removed after byte comparison.

A hash over the last three line hashes ends a chunk after a line when its first hexadecimal digit is below ``cut`` (5 of 16,
so about three lines a chunk). Boundaries depend on nearby lines only and so survive shifts. Of a chunk of two or more lines
that occurs at several places, the first occurrence stays (by id, null last, then by the document's digest and the line) and
the others lose their lines.

1. Narrow rows (64-bit hash and length of each multi-line chunk, and its place) are grouped with partial minima and maxima;
   hashes whose places differ are candidates. No group is gathered.
2. The candidates' places go back to their documents, whose texts are shuffled once by a digest of id and text.
3. Candidate chunks are grouped by their whole text, which compares them byte by byte; repeats other than the first of each
   text are taken out of their documents.

Boundaries lie inside a repeated passage by chance only, so short passages are missed. With ``cut`` None every two neighbouring
lines are a chunk instead. Each line of a repeated passage of two or more lines lies in such a pair, so none is missed, and
the union of the repeated pairs is exactly the union of these passages; the first place of each line's text always stays.

Defined cases: null texts have no lines and stay null; the empty text is one empty line; a document whose lines are all
removed gets the empty text; single-line chunks always stay; rows equal in id and text are one document, whose chunks do not
repeat each other; null ids are compared as such. Other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

CUT = 5


def _ends(lines: Column, cut: int) -> Column:
    """Indexes of the last lines of chunks."""
    hashes = F.transform(lines, lambda x: F.md5(x.cast("binary")))
    blank = lambda n: F.array(*[F.lit("")] * n)
    size = F.size(lines)
    shifted = lambda n: F.slice(F.concat(blank(n), hashes), F.lit(1), size)
    last_three = F.zip_with(F.zip_with(shifted(2), shifted(1), lambda a, b: F.concat(a, b)), hashes, lambda a, b: F.concat(a, b))
    flags = F.transform(last_three, lambda x, i: F.when((F.substring(F.md5(x.cast("binary")), 1, 1) < F.lit(f"{cut:x}")) | (i == size - 1), i))
    return F.filter(flags, lambda i: i.isNotNull())


def _chunks(ends: Column) -> Column:
    starts = F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda i: i + 1))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))


def _spans(lines: Column, cut: int | None) -> Column:
    """First and last lines of the chunks of two or more lines; of all pairs of neighbours where cut is None."""
    if cut is None:
        return F.transform(F.sequence(F.lit(0), F.size(lines) - 2), lambda i: F.struct(i.alias("s"), (i + 1).alias("e")))
    return F.filter(_chunks(_ends(lines, cut)), lambda c: c["e"] > c["s"])


def _text(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["s"] + 1, span["e"] - span["s"] + 1), "\n")


def _place(start: Column) -> Column:
    return F.struct(F.col("doc").isNull().alias("none"), "doc", "digest", start.alias("s"))


def mark(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: int | None = CUT, into: str = "remove") -> DataFrame:
    """docs with the indexes of the lines to remove in ``into``, null where there are none."""
    own = tk.fresh("digest", [*docs.columns, into])
    docs = docs.withColumn(own, F.xxhash64(id_col, text_col))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(own).alias("digest"), F.col(text_col).alias("text"))
    bare = texts.where(F.instr("text", "\n") > 0).select("doc", "digest", F.split("text", "\n").alias("lines"))
    chunks = bare.select("doc", "digest", "lines", _spans(F.col("lines"), cut).alias("chunks"))
    keyed = chunks.select("doc", "digest", F.explode(F.transform("chunks", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.xxhash64(_text(F.col("lines"), c)).alias("key"), F.length(_text(F.col("lines"), c)).alias("size")))).alias("c"))
    keyed = keyed.select("doc", "digest", "c.*")
    twice = keyed.groupBy("key", "size").agg(F.min(_place(F.col("s"))).alias("first"), F.max(_place(F.col("s"))).alias("last")).where("first != last").select("key", "size")
    candidates = keyed.join(twice, ["key", "size"]).groupBy("digest", "doc").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    spots = texts.alias("t").join(candidates.alias("c"), (F.col("t.digest") == F.col("c.digest")) & F.col("t.doc").eqNullSafe(F.col("c.doc"))).select("t.doc", "t.digest", F.split("t.text", "\n").alias("lines"), "c.spans")
    spots = spots.select("doc", "digest", F.explode(F.transform("spans", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _text(F.col("lines"), c).alias("chunk")))).alias("c")).select("doc", "digest", "c.*")
    firsts = spots.groupBy("chunk").agg(F.min(_place(F.col("s"))).alias("first"), F.max(_place(F.col("s"))).alias("last")).where("first != last")
    repeats = spots.join(firsts, "chunk").where(_place(F.col("s")) != F.col("first"))
    doc = tk.fresh("doc", [*docs.columns, into])
    removed = repeats.groupBy(F.col("digest").alias(f"{own}_2"), F.col("doc").alias(doc)).agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("s", "e")))).alias(into))
    out = docs.join(removed, (docs[own] == removed[f"{own}_2"]) & docs[id_col].eqNullSafe(removed[doc]), "left")
    return out.drop(own, f"{own}_2", doc)


def _kept(lines: Column, remove: Column) -> Column:
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), remove)
    return F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: int | None = CUT) -> DataFrame:
    """docs with the repeats' lines removed from the texts, same columns."""
    gone, lines = tk.fresh("gone", docs.columns), tk.fresh("lines", docs.columns)
    marked = mark(docs, id_col=id_col, text_col=text_col, cut=cut, into=gone).withColumn(lines, F.when(F.col(gone).isNotNull(), F.split(F.col(text_col), "\n")))
    text = F.when(F.col(gone).isNotNull(), _kept(F.col(lines), F.col(gone))).otherwise(F.col(text_col))
    return marked.withColumn(text_col, text).select(*docs.columns)


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: int | None = CUT) -> DataFrame:
    """One row per document: id, n_lines, n_removed (lines), kept_sha256 of the text that stays."""
    marked = mark(docs.select(id_col, text_col), id_col=id_col, text_col=text_col, cut=cut, into="gone").withColumn("lines", F.split(text_col, "\n"))
    kept = F.when(F.col("gone").isNotNull(), _kept(F.col("lines"), F.col("gone"))).otherwise(F.coalesce(F.col(text_col), F.lit("")))
    return marked.select(
        id_col,
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), cuts AS (
  SELECT doc_id, text, ls, list_filter(range(len(ls)), lambda i: i = len(ls) - 1 OR substr(md5(
      coalesce(CASE WHEN i >= 2 THEN md5(ls[i - 1]) END, '') || coalesce(CASE WHEN i >= 1 THEN md5(ls[i]) END, '') || md5(ls[i + 1])), 1, 1) < '5') AS ends
  FROM lines
), spans AS (
  SELECT doc_id, text, ls, unnest(ends) AS e, unnest(list_concat([0], list_transform(ends[:-2], lambda x: x + 1))) AS s FROM cuts
), chunks AS (
  SELECT doc_id, text, s, e, array_to_string(ls[s + 1 : e + 1], chr(10)) AS chunk FROM spans WHERE e > s
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) AS place FROM chunks
), gone AS (
  SELECT doc_id, list(s) AS ss, list(e) AS es FROM ranked WHERE place > 1 GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
    coalesce(list_sum(list_transform(range(len(g.ss)), lambda k: g.es[k + 1] - g.ss[k + 1] + 1)), 0) AS n_removed,
    CASE WHEN g.ss IS NULL THEN coalesce(d.text, '') ELSE array_to_string(list_transform(list_filter(range(len(string_split(d.text, chr(10)))),
      lambda i: len(list_filter(range(len(g.ss)), lambda k: i BETWEEN g.ss[k + 1] AND g.es[k + 1])) = 0), lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)) END AS kept
  FROM documents d LEFT JOIN gone g USING (doc_id)
)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM kept
"""
