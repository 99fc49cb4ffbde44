"""Secret scan with DataFrame functions only: key patterns and sliding-window entropy."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.registry import query, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LENGTH = 12
# A run shorter than the least length fails as a whole, so the length may
# stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Candidates of the entropy scan: unbroken runs of key characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
# Least bits per character of a window, by character class of the candidate.
THRESHOLDS = (("^[0-9A-F]+$|^[0-9a-f]+$", 3.0), ("", 3.7))
# Strings that are no secrets: letters only (words, paths, joined words),
# numbers and dates, UUIDs, placeholders.
ALLOW = (r"^[A-Za-z+/_-]+$", r"^[0-9+/_-]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         r"(?i)example|placeholder|changeme|dummy|xxxxx|00000|12345678")
# Places in code points, and in bytes of the UTF-8 text.
SPAN = "struct<start:int,rank:int,end:int,kind:string,first:int,last:int>"
HITS = "array<struct<start:int,rank:int,end:int,text:string,key:int,first:int,last:int>>"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _running(values: Column, join) -> Column:
    """Running totals of an array under ``join`` (a sum, a maximum): in round
    k each place takes in the one 2^k before it, so n values take n log n
    steps and no array grows element by element."""
    def rounds(v):
        n = F.ceil(F.log2(F.greatest(F.size(v), F.lit(1)))).cast("int")

        def once(a, k):
            back = F.call_function("shiftleft", F.lit(1), k)
            return F.transform(a, lambda x, i: F.when(i >= back, join(F.get(a, i - back), x)).otherwise(x))
        return F.aggregate(F.sequence(F.lit(0), n), v, once)
    return _let(values, rounds)


def _sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b)


def _found(text: Column, pattern: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost matches that do not overlap: what ``split``
    leaves between the matches gives their places."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    named = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    parts = F.zip_with(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), named,
                       lambda x, key: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                               F.octet_length(x["gap"]).alias("gap_bytes"),
                                               F.octet_length(x["hit"]).alias("hit_bytes"),
                                               x["hit"].alias("text"), F.length(key).alias("key")))
    parts = F.filter(parts, lambda x: x["hit"].isNotNull())

    def placed(p, ends, lasts):
        return F.transform(p, lambda x, i: F.struct(
            (F.get(ends, i) - x["hit"]).alias("start"), F.lit(rank).alias("rank"), F.get(ends, i).alias("end"),
            x["text"].alias("text"), x["key"].alias("key"), (F.get(lasts, i) - x["hit_bytes"]).alias("first"),
            F.get(lasts, i).alias("last")))

    spans = _let(parts, lambda p: _let(_sums(F.transform(p, lambda x: x["gap"] + x["hit"])), lambda ends: _let(
        _sums(F.transform(p, lambda x: x["gap_bytes"] + x["hit_bytes"])), lambda lasts: placed(p, ends, lasts))))
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: s["key"] >= least)).otherwise(F.array().cast(HITS))


def _plain(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind"),
                                                 s["first"].alias("first"), s["last"].alias("last")))


def _dense(text: Column, window: int, least: Column) -> Column:
    """(first, last) of the part of ``text`` whose windows reach ``least``
    bits per character, null where none does.

    The window slides by one character at a time: one leaves, one enters,
    and the sum of n log2 n over its character counts changes in those two.
    """
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = F.flatten(F.transform(codes, lambda c, i: F.concat(
        F.when(i >= window, F.array(F.struct(F.get(codes, i - window).alias("code"), F.lit(-1).alias("by"),
                                             i.alias("at"))))
        .otherwise(F.array().cast("array<struct<code:int,by:int,at:int>>")),
        F.array(F.struct(c.alias("code"), F.lit(1).alias("by"), i.alias("at"))))))
    nlog = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])
    none = F.lit(None).cast("int")
    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"),
                     none.alias("first"), none.alias("last"))

    def step(acc, e):
        n = F.get(acc["counts"], e["code"])
        total = acc["sum"] + F.get(nlog, n + e["by"]) - F.get(nlog, n)
        dense = ((e["by"] == 1) & (e["at"] >= window - 1)
                 & (F.lit(math.log2(window)) - total / window >= least))
        return F.struct(
            F.transform(acc["counts"], lambda c, j: F.when(j == e["code"], c + e["by"]).otherwise(c)).alias("counts"),
            total.alias("sum"),
            F.when(dense, F.coalesce(acc["first"], e["at"] - (window - 1))).otherwise(acc["first"]).alias("first"),
            F.when(dense, e["at"] + 1).otherwise(acc["last"]).alias("last"))

    return F.aggregate(steps, start, step, lambda acc: F.struct(acc["first"].alias("first"),
                                                                acc["last"].alias("last")))


def base_spans(text: Column) -> Column:
    """Spans of the three key patterns, by start, then kind."""
    return F.array_sort(F.concat(
        _plain(_found(text, ASSIGN, 0, group=2, least=ASSIGN_LENGTH), "assign"),
        _plain(_found(text, ACCESS, 1), "access"),
        _plain(_found(text, HEX, 2), "hex")))


def _piece(text: Column, first: Column, size: Column) -> Column:
    """Bytes of a text as text: only the piece itself is read."""
    return F.substring(text.cast("binary"), first + 1, size).cast("string")


def _outside(runs: Column, base: Column, least: int) -> Column:
    """The parts of the runs, ``least`` characters or more, that no base span
    covers, as (start, first, text). A sweep over the sorted ends of runs and
    spans counts how many of each are open."""
    def ends(spans, of_base, of_run):
        return F.flatten(F.transform(spans, lambda s: F.array(
            F.struct(s["start"].alias("at"), F.lit(of_base).alias("base"), F.lit(of_run).alias("run"),
                     F.lit(of_run).alias("begun")),
            F.struct(s["end"].alias("at"), F.lit(-of_base).alias("base"), F.lit(-of_run).alias("run"),
                     F.lit(0).alias("begun")))))

    def added(a, b):
        return F.struct(b["at"].alias("at"), *[(a[c] + b[c]).alias(c) for c in ("base", "run", "begun")])

    def parts(e):
        return F.filter(F.transform(e, lambda x, i: F.struct(
            F.get(runs, x["begun"] - 1).alias("run"), x["at"].alias("start"),
            F.when((x["base"] == 0) & (x["run"] == 1), F.get(e, i + 1)["at"] - x["at"]).otherwise(0).alias("size"))),
            lambda x: x["size"] >= least)

    def named(x):
        at = x["start"] - x["run"]["start"]   # runs are ASCII
        return F.struct(x["start"].alias("start"), (x["run"]["first"] + at).alias("first"),
                        _piece(x["run"]["text"], at, x["size"]).alias("text"))

    swept = F.transform(_let(_running(F.array_sort(F.concat(ends(base, 1, 0), ends(runs, 0, 1))), added), parts), named)
    whole = F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["first"].alias("first"), s["text"].alias("text")))
    return F.when(F.size(base) == 0, whole).otherwise(swept)


def entropy_spans(text: Column, base: Column, window: int = WINDOW, thresholds=THRESHOLDS,
                  allow=ALLOW) -> Column:
    """Spans of dense character runs, and of what base spans leave of a run."""
    runs = _let(_found(text, CANDIDATE, 3), lambda found: _outside(found, base, window))
    runs = F.filter(runs, lambda s: ~F.greatest(F.lit(False), F.lit(False), *[s["text"].rlike(p) for p in allow]))
    *classes, (_, rest) = thresholds

    def least(s):
        out = F.lit(rest)
        for pattern, bits in reversed(classes):
            out = F.when(s["text"].rlike(pattern), F.lit(bits)).otherwise(out)
        return out

    found = F.transform(runs, lambda s: F.struct(s["start"].alias("at"), s["first"].alias("byte"),
                                                 _dense(s["text"], window, least(s)).alias("part")))
    found = F.filter(found, lambda x: x["part"]["first"].isNotNull())
    return F.transform(found, lambda x: F.struct(
        (x["at"] + x["part"]["first"]).alias("start"), F.lit(3).alias("rank"),
        (x["at"] + x["part"]["last"]).alias("end"), F.lit("entropy").alias("kind"),
        (x["byte"] + x["part"]["first"]).alias("first"), (x["byte"] + x["part"]["last"]).alias("last")))


def with_spans(docs: DataFrame, text: str = "text", base: str = "_base_spans",
               spans: str = "_spans") -> DataFrame:
    """``docs`` with its base spans and all spans (arrays of ``SPAN``)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn(base, base_spans(whole))
    return out.withColumn(spans, F.array_sort(F.concat(base, entropy_spans(whole, F.col(base)))))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Secret spans of every document, as kind:start:end in code points.

    ``assign``, ``access`` and ``hex`` are the key patterns; ``entropy`` are
    further runs of at least ``WINDOW`` key characters in which some window
    is as dense as random text of its character class, unless the allow-list
    names the run. Where base spans cover a part of a run, each rest of it is
    a run of its own.

    A text of any length is scanned whole; its matches are placed by running
    totals, in time n log n of their number. Matches of different kinds may
    overlap and each count. A null or empty text has no spans (counts 0, hash of the empty string).
    A null doc_id is carried, repeated rows give a row each, other columns
    are not read, an empty table gives no rows.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(kind):
        return F.size(F.filter("_base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return with_spans(picked).select(
        "doc_id", *[count(k) for k in KINDS[:3]],
        F.sha2(_joined("_base_spans").cast("binary"), 256).alias("base_sha256"),
        _joined("_spans").alias("spans"))


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``find_secrets`` replaced by ``mark`` (spans
    that overlap, by one mark); texts without spans, null ones too, stay as
    they are, and so do all other columns."""
    base, spans = (f"{name}_{uuid.uuid4().hex}" for name in ("base", "spans"))
    marked = with_spans(docs, text, base, spans)

    def pieces(s, ends):
        """What stands before each span that begins a mark, and the mark."""
        before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))
        return F.transform(s, lambda x, i: F.when((i == 0) | (x["first"] >= before(i)), F.concat(
            _piece(F.col(text), before(i), x["first"] - before(i)), F.lit(mark))).otherwise(F.lit("")))

    def cleaned(ends):
        end = F.element_at(ends, -1)
        return F.concat(F.array_join(pieces(F.col(spans), ends), ""), _piece(F.col(text), end, F.octet_length(text) - end))

    clean = _let(_running(F.transform(spans, lambda x: x["last"]), F.greatest), cleaned)
    return marked.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(F.col(text))).drop(base, spans)


@query("op6_entropy_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
