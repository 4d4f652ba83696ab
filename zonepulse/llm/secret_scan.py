"""Secret scans with DataFrame functions only.

Three patterns give the base spans: assignments of a secret-like name, access key ids and
long hexadecimal runs. The method adds high-entropy strings. A candidate is a run of
base64 letters with a digit; its class is ``hex`` (only 0-9a-f), ``base64`` (lower case,
upper case and digits), ``hex_upper`` (only 0-9A-F), ``upper`` or ``lower`` (letters of one
case, with a stretch of ``WINDOW`` letters and digits and a digit between letters, which
paths and numbered words lack); digits alone are never a secret. A window of ``WINDOW`` characters slides over it. The Shannon
entropy of a window is log2(w) - S / w with S the sum of c * log2(c) over its character
counts, so a step changes S by the counts of the one character that leaves and the one
that enters. A candidate is a secret if its best window reaches the threshold of its
class, unless the allow list knows it or base spans cover all of it. Where they cover a
part and a letter or digit goes on beside them, the whole candidate is judged; if it is no
secret, or a separator stands between, each remainder of ``WINDOW`` characters or more.

Spans come without positions from the engine's regex functions; they follow from the
lengths of the gaps and matches. Their running sums go block by block, so a text with many
secrets costs about n to the power 1.5 and never a self-join.

Defined results:

* null or empty text: no spans, SHA-256 of the empty string;
* repeated rows and ids: one result row per input row; null doc_id is passed on;
* spans of different kinds may overlap; equal starts order as the kinds are listed;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import other_columns_aside, read_table

#: Patterns of the base kinds, in the order in which ties are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates of the entropy scan, its window and its thresholds in bits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
THRESHOLDS = {"hex": 2.9, "base64": 3.7, "hex_upper": 2.9, "upper": 3.4, "lower": 3.4}
#: Classes of the query and the pipeline, and those of ``find_secrets`` without others asked for.
CLASSES = tuple(THRESHOLDS)
MIXED_CLASSES = ("hex", "base64")
#: Candidates with one of these parts are known to be harmless.
ALLOWED = r"(?i)example|abcdef|0123456|1234567|deadbeef|(.)\1{7}"

_BLOCK = 256


def _sql(text: str) -> str:
    """A raw SQL string literal."""
    return 'r"' + text.replace('"', r"\x22") + '"'


def _matches(text: str, pattern: str) -> str:
    """SQL: array of (gap, len, t) for each match of ``pattern`` in column ``text``."""
    rx = _sql(pattern)
    return (f"CASE WHEN rlike({text}, {rx}) THEN filter(zip_with(split({text}, {rx}, -1), "
            f"regexp_extract_all({text}, {rx}, 0), (g, m) -> named_struct('gap', length(g), 'len', length(m), 't', m)), "
            f"p -> p.t IS NOT NULL) ELSE array() END")


def _spans(pairs: str) -> str:
    """SQL: array of (s, e, t), code points, from the column of ``_matches``."""
    empty = "cast(array() AS array<struct<s:int,e:int,t:string>>)"
    block = (f"aggregate(slice({pairs}, b * {_BLOCK} + 1, {_BLOCK}), named_struct('at', 0, 'out', {empty}), "
             "(acc, p) -> named_struct('at', acc.at + p.gap + p.len, 'out', array_append(acc.out, "
             "named_struct('s', acc.at + p.gap, 'e', acc.at + p.gap + p.len, 't', p.t))))")
    blocks = f"transform(sequence(0, (size({pairs}) - 1) div {_BLOCK}), b -> {block})"
    return (f"CASE WHEN size({pairs}) = 0 THEN {empty} ELSE flatten(aggregate({blocks}, "
            f"named_struct('at', 0, 'out', cast(array() AS array<array<struct<s:int,e:int,t:string>>>)), "
            "(acc, k) -> named_struct('at', acc.at + k.at, 'out', array_append(acc.out, "
            "transform(k.out, x -> named_struct('s', x.s + acc.at, 'e', x.e + acc.at, 't', x.t))))).out) END")


def _clogc(count: str) -> str:
    return f"(CASE WHEN {count} > 1 THEN {count} * log2({count}) ELSE 0D END)"


def max_entropy(candidate: str) -> str:
    """SQL: entropy in bits of the best window of a string of ``WINDOW`` characters or more.

    ``cs`` binds the characters once; the accumulator is (S of the window, least S so far).
    """
    count = "size(filter(slice(cs, i, {w}), x -> x = element_at(cs, {at})))".replace("{w}", str(WINDOW))
    leave, enter = "element_at(cs, i)", f"element_at(cs, i + {WINDOW})"
    out, come = count.replace("{at}", "i"), count.replace("{at}", f"i + {WINDOW}")
    step = (f"CASE WHEN {leave} = {enter} THEN 0D ELSE aggregate(array(named_struct('o', {out}, 'n', {come})), 0D, "
            f"(z, c) -> {_clogc('(c.o - 1)')} - {_clogc('c.o')} + {_clogc('(c.n + 1)')} - {_clogc('c.n')}) END")
    first = (f"aggregate(sequence(1, {WINDOW}), 0D, (z, i) -> z + log2(size(filter(slice(cs, 1, {WINDOW}), "
             "x -> x = element_at(cs, i)))))")
    slide = (f"aggregate(CASE WHEN size(cs) > {WINDOW} THEN sequence(1, size(cs) - {WINDOW}) ELSE cast(array() AS array<int>) END, "
             "named_struct('s', s0, 'best', s0), "
             f"(acc, i) -> aggregate(array(acc.s + {step}), acc, (z, s) -> named_struct('s', s, 'best', least(acc.best, s)))).best")
    return (f"element_at(transform(array(split({candidate}, '')), cs -> "
            f"{math.log2(WINDOW)!r}D - element_at(transform(array({first}), s0 -> {slide}), 1) / {WINDOW}), 1)")


def _is_secret(t: str, classes: tuple[str, ...]) -> str:
    """SQL: the entropy scan's verdict on a candidate string; only ``classes`` can be secrets."""
    lower, upper = f"rlike({t}, '[a-z]')", f"rlike({t}, '[A-Z]')"
    is_class = {
        "hex": f"(rlike({t}, '^[0-9a-f]+$') AND rlike({t}, '[a-f]'))",
        "base64": f"({lower} AND {upper})",
        "hex_upper": f"(rlike({t}, '^[0-9A-F]+$') AND rlike({t}, '[A-F]'))",
        "upper": f"(NOT {lower} AND rlike({t}, '[A-Z0-9]{{{WINDOW},}}') AND rlike({t}, '[A-Z][0-9]+[A-Z]'))",
        "lower": f"(NOT {upper} AND rlike({t}, '[a-z0-9]{{{WINDOW},}}') AND rlike({t}, '[a-z][0-9]+[a-z]'))",
    }
    limit = " ".join(f"WHEN {is_class[c]} THEN {THRESHOLDS[c]}D" for c in CLASSES if c in classes)
    known = " OR ".join(is_class[c] for c in classes)
    return (f"(rlike({t}, '[0-9]') AND ({known}) AND NOT rlike({t}, {_sql(ALLOWED)}) "
            f"AND round({max_entropy(t)}, 9) >= CASE {limit} END)")


def _uncovered(x: str) -> str:
    """SQL: array of the stretches (s, e, t) of candidate ``x`` that no span of ``_base`` covers."""
    left = "cast(array() AS array<struct<s:int,e:int,t:string>>)"
    piece = "named_struct('s', {s}, 'e', {e}, 't', substring({x}.t, {s} - {x}.s + 1, {e} - {s}))"
    gap, tail = piece.format(x=x, s="acc.at", e="b.s"), piece.format(x=x, s="acc.at", e=f"{x}.e")
    return (f"aggregate(array_sort(filter(_base, b -> b.s < {x}.e AND {x}.s < b.e)), named_struct('at', {x}.s, 'out', {left}), "
            f"(acc, b) -> named_struct('at', greatest(acc.at, b.e), 'out', "
            f"CASE WHEN b.s > acc.at THEN array_append(acc.out, {gap}) ELSE acc.out END), "
            f"acc -> CASE WHEN acc.at < {x}.e THEN array_append(acc.out, {tail}) ELSE acc.out END)")


def find_secrets(docs: DataFrame, classes: tuple[str, ...] = MIXED_CLASSES, remainders: bool = False) -> DataFrame:
    """``docs`` plus ``_spans``: array of (s, kind, e) by start, then kind (0 to 3).

    The entropy scan judges candidates of ``classes``, and with ``remainders`` also those that
    base spans cover in part; the query and the pipeline ask for all.

    Works per row without a shuffle. One-row generators keep each step computed once.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns]

    def step(df: DataFrame, names: list[str], **columns: str) -> DataFrame:
        made = F.struct(*[F.expr(e).alias(n) for n, e in columns.items()])
        return df.select(*keep, *names, F.inline(F.array(made)))

    text = "coalesce(text, '')"
    df = step(docs, [], _a=_matches(text, ASSIGN), _k=_matches(text, ACCESS), _h=_matches(text, r"[0-9a-f]{32,}"),
              _c=_matches(text, CANDIDATE))
    df = step(df, [], _a=_spans("_a"), _k=_spans("_k"), _h=_spans("_h"), _c=_spans("_c"))
    kind = "transform(filter({c}, x -> {ok}), x -> named_struct('s', x.s, 'kind', {k}, 'e', x.e))"
    df = step(df, ["_c"], _base="concat(" + ", ".join((
        kind.format(c="_a", k=0, ok=f"length(regexp_extract(x.t, {_sql(ASSIGN)}, 2)) >= 8"),
        kind.format(c="_k", k=1, ok="length(x.t) >= 16"),
        kind.format(c="_h", k=2, ok="length(x.t) >= 32"))) + ")")
    new = "NOT exists(_base, b -> b.s < x.e AND x.s < b.e)"
    more = kind.format(c="_c", k=3, ok=f"rlike(x.t, '[0-9]') AND {new} AND {_is_secret('x.t', classes)}")
    if remainders:
        partly = "filter(_c, x -> rlike(x.t, '[0-9]') AND exists(_base, b -> b.s < x.e AND x.s < b.e))"
        df = step(df, ["_c", "_base"], _p=f"transform({partly}, x -> named_struct('x', x, 'left', {_uncovered('x')}))")
        goes_on = "exists(p.left, r -> r.s > p.x.s AND rlike(r.t, '^[A-Za-z0-9]') OR r.e < p.x.e AND rlike(r.t, '[A-Za-z0-9]$'))"
        judged = (f"flatten(transform(filter(_p, p -> size(p.left) > 0), p -> CASE WHEN {goes_on} AND {_is_secret('p.x.t', classes)} "
                  f"THEN array(p.x) ELSE filter(p.left, r -> length(r.t) >= {WINDOW} AND {_is_secret('r.t', classes)}) END))")
        more = f"{more}, {kind.format(c=judged, k=3, ok='true')}"
    return df.select(*keep, F.expr(f"array_sort(concat(_base, {more}))").alias("_spans"))


def _listed(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"concat_ws(',', transform({spans}, x -> concat(element_at(array({names}), x.kind + 1), "
                  "':', cast(x.s AS string), ':', cast(x.e AS string))))")


@other_columns_aside("text", "n_chars")
def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; overlapping spans count as one.

    ``n_chars``, where it exists, follows the new text; texts without secrets stay as they are.
    """
    hide = ("aggregate(_spans, named_struct('at', 0, 'out', cast(array() AS array<string>)), (acc, x) -> "
            "CASE WHEN x.s >= acc.at THEN named_struct('at', x.e, 'out', array_append(acc.out, "
            "concat(substring(text, acc.at + 1, x.s - acc.at), '[SECRET]'))) "
            "ELSE named_struct('at', greatest(acc.at, x.e), 'out', acc.out) END, "
            "acc -> concat(array_join(acc.out, ''), substring(text, acc.at + 1)))")
    found = find_secrets(docs, CLASSES, remainders=True)
    hidden = found.withColumn("_text", F.expr(f"CASE WHEN size(_spans) > 0 THEN {hide} ELSE text END"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias("text"))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(F.when(F.size("_spans") > 0, F.length("_text").cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return hidden.select(*columns)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and entropy spans of all documents."""
    found = find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"), CLASSES, remainders=True)
    count = {n: F.expr(f"cast(size(filter(_spans, x -> x.kind = {k})) AS bigint)").alias(n)
             for k, n in enumerate(("n_assign", "n_access", "n_hex", "n_entropy"))}
    base = F.sha2(_listed("filter(_spans, x -> x.kind < 3)"), 256).alias("base_sha256")
    return found.select("doc_id", count["n_assign"], count["n_access"], count["n_hex"], base,
                        _listed("_spans").alias("spans"), count["n_entropy"])
