"""Texts cut off by field limits or in transfer.

Method: per source and text column, the histograms of lengths in characters and in bytes are tested for spikes; a length
at which many more texts end than around it is a field limit. Texts of a limit's length without terminal punctuation are
cut. A limit need not be its source's greatest length: some were lifted, or hold for a part of a source, so that longer
texts stand beside the cut ones. Spikes are therefore sought at every length; ``at_max`` tells which are the greatest.

Cuts in transfer lie at no particular length and are told apart in ``cause``. Such a text ends in mid-word or
mid-sentence, while a page may end without a full stop as printed: with a signature, an address or a row of a table.
How pages end, and which marks break words, is learned from the corpus itself (``Endings``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

TAIL = 12  # characters of an ending
FREQUENT = 0.005  # share of the endings of its kind that makes an ending one as printed
BREAK_SHARE, BREAK_LEAST = 0.9, 20  # a mark breaks words if lines ending in it, at least so many, go on in lower case in that share
BROADCAST_LIMITS = 10_000  # a map of so many limits is under 1 MB
CLOSING = r"[\"')\]»’”›]*$"
STOP = r"(?<![.])[.!?]" + CLOSING
ELLIPSIS = r"(…|[.]{2,})" + CLOSING
BROKEN_CHARACTER = r"�$"


@dataclass
class Endings:
    """What the corpus teaches: frequent endings and table rows by kind, and marks that break words."""

    tails: dict[str, list[str]] = field(default_factory=dict)
    shapes: list[str] = field(default_factory=list)
    break_marks: list[str] = field(default_factory=list)


def _kind(end: Column) -> Column:
    return F.when(end.rlike(r"\p{L}$"), "letter").when(end.rlike(r"\d$"), "digit").when(end != "", "mark")


def _tail(end: Column) -> Column:
    """The last characters of a text; of one that ends in a number the last word before it, too."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(end), r"\s+", " "), r"\d+", "#")
    return F.when(flat.endswith("#"), F.regexp_extract(flat, r"([^ ]*\p{L}[^ ]*) #$", 0)).otherwise(F.substring(flat, -TAIL, TAIL))


def _shape(end: Column) -> Column:
    """The last line's last five words: ``.`` for a word of punctuation alone, ``x`` for any other; '' without the former."""
    line = F.regexp_extract(end, r"[^\n\r]*$", 0)
    words = F.slice(F.concat(F.array(*[F.lit("")] * 5), F.split(F.trim(F.regexp_replace(line, r"([\p{P}]{2,})", " $1 ")), r"\s+")), -5, 5)
    shape = F.array_join(F.transform(words, lambda w: F.when(w == "", "").when(w.rlike(r"^[\p{P}\p{S}]+$"), ".").otherwise("x")), "")
    return F.when(shape.contains("."), shape).otherwise("")


def _slim(docs: DataFrame, doc_id: str | None, source: str, text: str) -> DataFrame:
    """What decides, without the text: read once, kept in the shared folder."""
    bare = F.regexp_replace(text, r"\s+$", "")
    end = F.coalesce(F.substring(bare, -4 * TAIL, 4 * TAIL), F.lit(""))
    blank = F.col(text).isNull() | ~F.col(text).rlike(r"[^\s ​﻿]")
    rows = docs.select(
        (F.col(doc_id) if doc_id else F.lit(None).cast("long")).alias("doc_id"), F.col(source).alias("source"), blank.alias("blank"), F.col(text).rlike(r"\s$").alias("spaced"), F.char_length(text).alias("n_chars"), F.octet_length(text).alias("n_bytes"), end.alias("end")
    )
    return rows.select("*", _kind(F.col("end")).alias("kind"), _tail(F.col("end")).alias("tail"), _shape(F.col("end")).alias("shape"))


def _limits(slim: DataFrame, around: int, least: int, excess: float) -> DataFrame:
    units = F.array(*[F.struct(F.lit(u).alias("unit"), F.col(f"n_{u}").alias("len")) for u in ("chars", "bytes")])
    lengths = slim.filter("not blank").select("source", F.explode(units).alias("l")).select("source", "l.unit", "l.len")
    histogram = cut(lengths.groupBy("source", "unit", "len").agg(F.count("*").alias("n")).withColumn("bin", F.floor(F.col("len") / around)))
    binned = histogram.groupBy("source", "unit", "bin").agg(F.sum("n").alias("m"))
    near = binned.select("source", "unit", F.explode(F.array(*[F.struct((F.col("bin") + d).alias("bin"), F.lit(d).alias("side")) for d in (-1, 0, 1)])).alias("t"), "m")
    near = near.groupBy("source", "unit", F.col("t.bin").alias("bin")).agg(F.max(F.when(F.col("t.side") != 0, F.col("m"))).alias("beside"), F.max(F.when(F.col("t.side") == 0, F.col("m"))).alias("own"))
    longest = histogram.groupBy("source", "unit").agg(F.max("len").alias("longest"))
    h, n, g = histogram.alias("h"), near.alias("n"), longest.alias("g")
    joined = h.join(n, on=[F.col("h.source").eqNullSafe(F.col("n.source")), F.col("h.unit") == F.col("n.unit"), F.col("h.bin") == F.col("n.bin")])
    joined = joined.join(g, on=[F.col("h.source").eqNullSafe(F.col("g.source")), F.col("h.unit") == F.col("g.unit")])
    expected = F.greatest(F.coalesce(F.col("n.beside") / around, F.lit(0.0)), (F.col("n.own") - F.col("h.n")) / (around - 1))
    spikes = joined.select("h.source", "h.unit", F.col("h.len").alias("limit"), F.col("h.n").alias("n"), expected.alias("expected"), (F.col("h.len") == F.col("g.longest")).alias("at_max"))
    return spikes.filter((F.col("n") >= least) & (F.col("n") > F.col("expected") + excess * F.sqrt("expected") + 3))


def field_limits(docs: DataFrame, *, source: str = "source", columns: tuple[str, ...] = ("text",), around: int = 8, least: int = 5, excess: float = 6.0) -> DataFrame:
    """Columns ``column``, ``source``, ``unit`` (``chars`` or ``bytes``), ``limit``, ``n``, ``expected``, ``at_max``: lengths that stand out in a source.

    Lengths fall into bins of ``around``; ``expected`` is the greatest mean count of the own and both adjacent bins,
    the length itself left out. A spike has at least ``least`` texts and exceeds it by ``excess`` standard deviations of
    chance plus 3. A limit in one unit is only a broad bump in the other. Blank and null texts have no length here.
    """
    each = [_limits(_slim(docs, None, source, c), around, least, excess).select(F.lit(c).alias("column"), "*") for c in columns]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def break_marks(docs: DataFrame, text: str = "text") -> list[str]:
    """Marks that break words: lines that end in one go on in lower case, and it stands at a line's end as often as elsewhere.

    The second condition sets hyphens apart from commas and brackets, which a page may end in (a misread full stop).
    """
    ends = docs.select(F.explode(F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{N}\s][\r\n]+."), F.lit(0))).alias("e"))
    counts = ends.groupBy(F.substring("e", 1, 1).alias("mark")).agg(F.count("*").alias("n"), F.count_if(F.col("e").rlike(r"\p{Ll}$")).alias("n_on"))
    found = {r.mark: r.n for r in counts.filter((F.col("n") >= BREAK_LEAST) & (F.col("n_on") >= BREAK_SHARE * F.col("n"))).collect()}  # a few characters
    if not found:
        return []
    total = docs.agg(*[F.sum(F.char_length(text) - F.char_length(F.replace(text, F.lit(m)))).alias(str(i)) for i, m in enumerate(found)]).first()
    return sorted(m for i, m in enumerate(found) if 2 * found[m] >= total[i])


def learn_endings(slim: DataFrame) -> Endings:
    """Frequent endings over all texts: at most ``1 / FREQUENT`` of a kind are collected."""
    seen = slim.filter("not blank and kind is not null").filter(~F.col("end").rlike(STOP) | F.col("end").rlike(ELLIPSIS))

    def frequent(rows: DataFrame, what: str) -> list:
        counts = rows.filter(F.col(what) != "").groupBy("kind", what).agg(F.count("*").alias("n"))
        totals = rows.groupBy("kind").agg(F.count("*").alias("total"))
        return counts.join(totals, "kind").filter((F.col("n") >= 3) & (F.col("n") >= FREQUENT * F.col("total"))).select("kind", F.col(what).alias("what")).collect()

    shapes = sorted(r.what for r in frequent(seen.filter("kind = 'digit'"), "shape"))
    tails = frequent(seen.filter(~((F.col("kind") == "digit") & F.col("shape").isin(*shapes))) if shapes else seen, "tail")
    return Endings({k: sorted(r.what for r in tails if r.kind == k) for k in ("letter", "digit", "mark")}, shapes)


def _like(tail: Column, known: list[str]) -> Column:
    """Whether an ending is a known one or differs from one in at most a quarter of its letters (misread)."""
    if not known:
        return F.lit(False)
    return tail.isin(*known) | F.exists(F.array(*map(F.lit, known)), lambda w: F.levenshtein(tail, w) <= F.floor(F.length(w) / 4))


def find_truncated(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", around: int = 8, least: int = 5, excess: float = 6.0) -> DataFrame:
    """Columns ``doc_id``, ``source``, ``is_cut``, ``cause`` (``field_limit``, ``transfer`` or null), one row per row of ``docs``.

    Null, empty and blank texts aren't cut. At a limit a text is cut unless it ends with terminal punctuation or as
    printed; if the limit's texts so outnumber their surroundings that hardly one can end there by itself, punctuation
    is no excuse either. A source of null is a source. A text at a byte limit may be up to 3 bytes shorter, or longer by
    the mark of a broken character. Elsewhere a text is cut in transfer if it ends in a letter or digit other than as
    printed, in a mark that breaks words, or in a broken character. Repeated rows count each.
    """
    slim = cut(_slim(docs, doc_id, source, text))
    limits = cut(_limits(slim, around, least, excess))
    endings = learn_endings(slim)
    endings.break_marks = break_marks(docs, text)
    # per source a few limits at most: each needs several texts of one length; as a map they join once
    per_source = limits.groupBy("source").agg(F.collect_list(F.struct("unit", "limit", "n", "expected")).alias("limits"))
    if limits.count() <= BROADCAST_LIMITS:
        per_source = F.broadcast(per_source)
    r, s = slim.alias("r"), per_source.alias("s")
    met = r.join(s, on=F.col("r.source").eqNullSafe(F.col("s.source")), how="left").select("r.*", F.coalesce("s.limits", F.array().cast("array<struct<unit:string,limit:int,n:bigint,expected:double>>")).alias("limits"))
    end, tail, kind = F.col("end"), F.col("tail"), F.col("kind")
    broken = end.rlike(BROKEN_CHARACTER)
    at = F.filter("limits", lambda x: ((x["unit"] == "chars") & (x["limit"] == F.col("n_chars"))) | ((x["unit"] == "bytes") & (x["limit"] == F.col("n_bytes"))))
    near = F.exists("limits", lambda x: (x["unit"] == "bytes") & (F.col("n_bytes") - x["limit"]).between(-3, 3) & broken)
    mid_word = F.right(end, F.lit(1)).isin(*endings.break_marks) if endings.break_marks else F.lit(False)
    in_table = F.col("shape").isin(*endings.shapes) if endings.shapes else F.lit(False)
    as_printed = ((kind == "letter") & _like(tail, endings.tails["letter"])) | ((kind == "digit") & (in_table | _like(tail, endings.tails["digit"]))) | ((kind == "mark") & _like(tail, endings.tails["mark"]))
    stopped = end.rlike(STOP) & ~end.rlike(ELLIPSIS)
    # a share of cuts falls behind a full stop; it counts where chance alone would leave under a quarter of a text there
    crowded = F.exists(at, lambda x: (x["n"] >= 20) & (x["expected"] < 0.02 * x["n"]))
    limit_cut = (F.size(at) > 0) & F.when(stopped | as_printed, crowded & ~as_printed & stopped).otherwise(True) | near
    transfer_cut = ~as_printed & (kind.isin("letter", "digit") | mid_word | broken)
    cause = F.when(F.col("blank"), None).when(limit_cut, "field_limit").when(transfer_cut & ~F.col("spaced"), "transfer")
    return met.select("doc_id", "source", cause.alias("cause")).select("doc_id", "source", F.col("cause").isNotNull().alias("is_cut"), "cause")


def truncation_report(found: DataFrame) -> DataFrame:
    """Per source: texts, cut texts by cause, and their share."""
    count = lambda cause: F.count_if(F.col("cause") == cause)
    return found.groupBy("source").agg(F.count("*").alias("n_documents"), F.count_if("is_cut").alias("n_cut"), count("field_limit").alias("n_field_limit"), count("transfer").alias("n_transfer"), (F.count_if("is_cut") / F.count("*")).alias("cut_share"))
