"""Document fingerprints: a Merkle tree over sections and paragraphs, in SQL functions.

A text is cut into sections (after blank lines), sections into paragraphs (after line
ends) and paragraphs into pieces (sentences, in stretches of at most ``PIECE`` characters).
Nothing is dropped by a cut, so the pieces in order are the text. A leaf is the SHA-256 of
a piece, an inner node the SHA-256 of its children's, and the root covers everything:
equal roots mean equal texts. Where roots differ, the branches that differ lead to the
sections, paragraphs and pieces that were edited.

A fingerprint is the tree as a string: the root, then ``|`` and the section's hash, ``;``
and the paragraph's hash, ``:`` and the leaves, joined by ``,`` (inner nodes and leaves
shortened to 12 hex digits). The likeness of two fingerprints is 1 for equal roots, else
twice the distinct leaves both have over the sum of their distinct leaves.

Defined results:

* null or empty text: the fingerprint of the empty text, a root without sections;
* two texts without leaves in common: likeness 0; equal texts: 1;
* repeated rows and ids: every row is returned; rows of one doc_id follow each other by a
  hash of their text (rows equal in both share a range, hence a task); null doc_ids come last; a table of one row is its own next document;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table

PIECE = 64
_SHORT = 12


def fingerprint(text: str) -> Column:
    """Fingerprint of the SQL expression ``text`` (a column, non-null)."""
    pieces = f"regexp_extract_all(p, r'[^.!?]{{1,{PIECE}}}[.!?]*|[.!?]+', 0)"
    leaves = f"transform({pieces}, x -> sha2(x, 256))"
    paragraph = f"transform(array({leaves}), l -> named_struct('l', l, 'h', sha2(array_join(l, ''), 256)))[0]"
    section = (f"transform(array(transform(filter(split(s, r'(?<=\\n)'), p -> p <> ''), p -> {paragraph})), "
               "ps -> named_struct('h', sha2(array_join(ps.h, ''), 256), 't', array_join(transform(ps, "
               f"q -> concat(left(q.h, {_SHORT}), ':', array_join(transform(q.l, x -> left(x, {_SHORT})), ','))), ';')))[0]")
    tree = (f"transform(array(transform(filter(split({text}, r'(?<=\\n\\n)(?!\\n)'), s -> s <> ''), s -> {section})), "
            "ss -> concat(sha2(array_join(ss.h, ''), 256), array_join(transform(ss, "
            f"s -> concat('|', left(s.h, {_SHORT}), ';', s.t)), '')))[0]")
    return F.expr(f"CASE WHEN {text} = '' THEN sha2('', 256) ELSE {tree} END")


def likeness(a: str, b: str) -> Column:
    """Likeness (0 to 1) of two fingerprint columns."""
    def leaves(f: str) -> str:     # what follows ':' up to ';' or '|', cut at ','
        return f"split(array_join(regexp_extract_all({f}, r':([0-9a-f,]+)', 1), ','), ',')"
    return F.expr(
        f"CASE WHEN left({a}, 64) = left({b}, 64) THEN 1D "
        f"WHEN length({a}) = 64 OR length({b}) = 64 THEN 0D "
        f"ELSE transform(array(named_struct('x', {leaves(a)}, 'y', {leaves(b)})), z -> "
        "2D * size(array_intersect(z.x, z.y)) / (size(array_distinct(z.x)) + size(array_distinct(z.y))))[0] END")


def differing_branches(pairs: DataFrame, a: str = "fingerprint", b: str = "edited_fingerprint") -> DataFrame:
    """``pairs`` plus where the trees ``a`` and ``b`` differ, for both sides.

    ``sections`` are the 0-based sections of ``a`` whose hash no section of ``b`` has,
    ``paragraphs`` the (section, paragraph) branches in them whose hash no paragraph of the
    sections only ``b`` has; ``other_sections`` and ``other_paragraphs`` are those of ``b``.
    Children are matched by hash before anything is opened, so an inserted or moved section
    leaves the others equal; equal roots open nothing. A section that one tree repeats more
    often than the other does not count as a difference.
    """
    cut = lambda f: f"slice(split({f}, r'\\|'), 2, 1000000000)"
    below = lambda d: f"slice(split({d}, ';'), 2, 1000000000)"
    heads = lambda xs: f"transform({xs}, x -> left(x, {_SHORT}))"
    inner = lambda opened: f"flatten(transform({opened}, d -> {heads(below('d.x'))}))"
    # sections only one side has, as (i, x); the one-row generators compute each step once
    out = pairs.select("*", F.inline(F.array(F.struct(
        F.expr(f"CASE WHEN left({a}, 64) = left({b}, 64) THEN slice({cut(a)}, 1, 0) ELSE {cut(a)} END").alias("_xs"),
        F.expr(f"CASE WHEN left({a}, 64) = left({b}, 64) THEN slice({cut(b)}, 1, 0) ELSE {cut(b)} END").alias("_ys")))))
    out = out.select("*", F.inline(F.array(F.struct(
        F.expr(f"array_except({heads('_xs')}, {heads('_ys')})").alias("_xo"),
        F.expr(f"array_except({heads('_ys')}, {heads('_xs')})").alias("_yo")))))
    opened = lambda xs, only: (f"filter(transform({xs}, (x, i) -> named_struct('i', i, 'x', x)), "  # noqa: E731
                               f"d -> array_contains({only}, left(d.x, {_SHORT})))")
    out = out.select("*", F.inline(F.array(F.struct(
        F.expr(opened("_xs", "_xo")).alias("_xd"), F.expr(opened("_ys", "_yo")).alias("_yd")))))
    out = out.select("*", F.inline(F.array(F.struct(
        F.expr(f"array_except({inner('_xd')}, {inner('_yd')})").alias("_xp"),
        F.expr(f"array_except({inner('_yd')}, {inner('_xd')})").alias("_yp")))))
    branches = lambda ds, only: (
        f"flatten(transform({ds}, d -> transform(filter(transform({below('d.x')}, (p, j) -> named_struct('j', j, 'p', p)), "
        f"e -> array_contains({only}, left(e.p, {_SHORT}))), e -> named_struct('section', d.i, 'paragraph', e.j))))")
    return out.select(*pairs.columns, F.expr("transform(_xd, d -> d.i)").alias("sections"),
                      F.expr(branches("_xd", "_xp")).alias("paragraphs"),
                      F.expr("transform(_yd, d -> d.i)").alias("other_sections"),
                      F.expr(branches("_yd", "_yp")).alias("other_paragraphs"))


def range_heads(keys: DataFrame, buckets: int) -> DataFrame:
    """One row: the smallest key ``_key`` of each of ``buckets`` ranges, ascending (``fine``), and
    every ``step``-th of them (``coarse``). Rows with equal keys are in one range.

    Its size is one key (17 bytes) per range, whatever the table holds.
    """
    step = max(1, math.isqrt(buckets))
    heads = (keys.repartitionByRange(buckets, "_key").groupBy(F.spark_partition_id()).agg(F.min("_key").alias("_key"))
             .agg(F.sort_array(F.collect_list("_key")).alias("fine")))
    return heads.select(F.lit(step).alias("step"), "fine", F.expr(
        f"filter(fine, (b, i) -> i % {step} = 0)").alias("coarse"))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(_id, _text, _next): every row's text and that of the next row by descending doc_id.

    Rows are dealt to ranges of (doc_id, hash of the text), so rows without an id, or of one
    id, spread as well; a row that heads its range is also handed to the range before as its
    end, so a window over one range sees every neighbour. The texts are shuffled once. The
    heads of the ranges enter as one row of a scalar subquery: the plan's text does not grow
    with the number of ranges.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    # ascending keys are descending ids, nulls last; ~x falls as x grows and never overflows
    rows = rows.withColumn("_key", F.struct(F.col("_id").isNull().alias("n"), F.bitwise_not("_id").alias("i"),
                                            F.xxhash64("_text").alias("h")))
    heads = materialise(range_heads(materialise(rows.select("_key"), "merkle-keys"), buckets), "merkle-heads")
    h = heads.select(F.struct("step", "fine", "coarse")).scalar()
    # the number of heads at or below the key: whole strides by the coarse list, the rest in one stride
    dealt = rows.select("*", h.alias("_h")).select("*", F.expr("size(filter(_h.coarse, b -> b <= _key))").alias("_c"))
    dealt = dealt.select("_id", "_text", "_key", "_h", F.expr(
        "(_c - 1) * _h.step + size(filter(slice(_h.fine, (_c - 1) * _h.step + 1, _h.step), b -> b <= _key))").alias("_b"))
    places = dealt.select("_id", "_text", "_key", F.explode(F.expr(
        "CASE WHEN _key = get(_h.fine, _b - 1) "
        "THEN array(named_struct('b', _b, 'end', 0), named_struct('b', if(_b = 1, size(_h.fine), _b - 1), 'end', 1)) "
        "ELSE array(named_struct('b', _b, 'end', 0)) END")).alias("_place"))
    order = Window.partitionBy("_place.b").orderBy("_place.end", "_key", "_text")
    return (places.select("_id", "_text", "_place", F.lead("_text").over(order).alias("_next"))
            .where("_place.end = 0").select("_id", "_text", "_next"))


def edited_pairs(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, text, next text and edited text of every document.

    The edited text ends in the first floor(n_chars / 3) code points of the next document
    (or all it has) in place of as many of its own.
    """
    third = F.expr("cast(floor(n_chars / 3) AS int)")
    return (with_next(docs, buckets).withColumn("n_chars", F.length("_text").cast("long"))
            .withColumn("_third", third)
            .select(F.col("_id").alias("doc_id"), "n_chars", "_text", "_next", F.expr(
                "concat(substring(_text, 1, cast(n_chars AS int) - _third), substring(_next, 1, _third))").alias("_edited")))


def op5_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    pairs = edited_pairs(read_table(spark, sf_dir, "documents"))
    # one-row generators keep each fingerprint computed once
    trees = pairs.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), F.inline(F.array(F.struct(
        fingerprint("_text").alias("fingerprint"), fingerprint("_edited").alias("edited_fingerprint"),
        fingerprint("_next").alias("_next_fingerprint")))))
    trees = differing_branches(trees)
    return trees.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        "sections", "other_sections", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                        likeness("fingerprint", "_next_fingerprint").alias("near_next"))
